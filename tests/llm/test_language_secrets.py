"""Language identification by held-out accuracy; secret scans against plain regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from showroom.llm import language_id as li
from showroom.llm import secrets as se

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = li.train(docs.where(~held), key=F.col("doc_id"))
    out = li.predict(docs.where(held), model)
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98
    assert out.where("score < 0 OR score > 1").count() == 0


def test_word_scores_equal_a_plain_sum(make):
    docs = make([("aab ab", "x"), ("bba b", "y"), ("é b", "y"), (None, "x"), ("ab", None)], "text string, lang string")
    model = li.train(docs)
    assert model.languages == ["x", "y"]
    def grams(word):
        w = f" {word} "
        return [w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    counts = {"x": {}, "y": {}}
    for text, lang in [("aab ab", "x"), ("bba b", "y"), ("é b", "y")]:
        for w in text.split():
            for g in grams(w):
                counts[lang][g] = counts[lang].get(g, 0) + 1
    got = model.word_scores(pa.array([b"ab", "éb".encode()]))
    for row, word in zip(got, ["ab", "éb"]):
        for k, lang in enumerate("xy"):
            total = sum(counts[lang].values()) + li.SMOOTHING * 2**li.BITS
            assert np.isclose(row[k], sum(np.log((counts[lang].get(g, 0) + li.SMOOTHING) / total) for g in grams(word)))
    assert np.allclose(np.exp(model.prior), [2.5 / 5, 2.5 / 5])


def test_odd_rows_of_languages(make):
    rows = [(1, "the cat " * 5, "en", 1), (2, "le chat é", "fr", 1), (3, None, "en", 1), (4, " 12 ?! ", "fr", 1), (5, "", None, 1), (6, "le chat " * 200_000, "fr", 1), (2, "le chat é", "fr", 1)]
    docs = make(rows, "doc_id bigint, text string, lang string, n bigint")
    model = li.train(docs, key=F.col("doc_id"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.predict(docs, model).collect()}
    assert got[1][0] == "en" and got[2][0] == got[6][0] == "fr"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    nothing = li.train(docs.where("lang IS NULL"))
    assert [r.lang_pred for r in li.predict(docs, nothing).collect()] == ["und"] * 7
    assert li.predict(docs.limit(0), model).count() == 0


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(spans)


def test_patterns_equal_plain_ones():
    pick = random.Random(5)
    parts = ["PassWord", "passwd", "secret", "tokEn", "api_key", "APIKEY", '"', "'", " ", ": ", "=", "abcdef012345", "AKIA", "ABCDEFGH12345678", "é", "\n", "-", "zz", "ſecret", "token=short"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(14)))
        assert se.base_spans(text) == plain(text), text
    assert se.listed(se.base_spans('é token: "0123456789abcdef"')) == "assign:2:26,hex:10:26"


def test_models_find_random_strings(spark, make):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    ratio = se.train(docs, key=F.col("doc_id"))
    pick = random.Random(1)
    strings = ["".join(pick.choices("abcdefABCDEF0123456789xyzXYZ", k=32)) for _ in range(50)]
    found = [more for _, more in se.spans_of([f"the {s} and" for s in strings], ratio)]
    assert sum(map(bool, found)) >= 45
    short = ["".join(pick.choices("bcdfghjkqvwxzBCDFGHJKQVWXZ0123456789", k=18)) for _ in range(50)]
    assert sum(bool(more) for _, more in se.spans_of([f"the {s} and" for s in short], ratio)) >= 40
    # Inside a path and behind a name the stretch is the secret, give or take a character.
    inside = [(f"see var/lib/onthtion/{s}/thnderstanding", 21) for s in strings] + [(f"NATION_ACCESS_THE={s} end", 18) for s in strings]
    hits = [any(min(b, at + 32) - max(a, at) >= 28 and b - a <= 40 for a, k, b in more if k == 3) for (_, at), (_, more) in zip(inside, se.spans_of([t for t, _ in inside], ratio), strict=True)]
    assert sum(hits) >= 90
    plain_words = ["einstlichenkeitgeachung", "the_quick_brown_fox_jumps", "onthtionwhonattionnd", "=" * 60, "get_user_by_name_or_email"]
    assert [more for _, more in se.spans_of(plain_words[:3], ratio)] == [[], [], []]
    clean = se.scan(docs, ratio)
    assert clean.where("secrets.n_markov > 0").count() <= 2


def plain_spans(text, ratio, threshold):
    """The same stretches by trying all of a run."""
    base = plain(text)
    free = [not any(a <= i < b for a, _, b in base) for i in range(len(text))]
    alphabet = set(se.ALPHABET) | set(se.ALPHABET.upper())
    value = lambda i: ratio[se.ALPHABET.index(text[i].lower()) * len(se.ALPHABET) + se.ALPHABET.index(text[i + 1].lower())]
    out = []

    def search(a, b):
        if b - a < se.LEAST:
            return
        best = max(((sum(value(i) for i in range(x, y - 1)), -x, -y) for x in range(a, b) for y in range(x + 2, b + 1)), default=(0, 0, 0))
        if best[0] > threshold + 1e-9:
            x, y = -best[1], -best[2]
            if y - x >= se.LEAST:
                out.append((x, 3, y))
            search(a, x)
            search(y, b)

    whole = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/]+={0,2}", text) if len(m[0].rstrip("=")) >= se.LEAST]
    for start, end in whole:
        i = start
        while i < end:
            j = i
            while j < end and free[j] and text[j] in alphabet:
                j += 1
            search(i, j)
            i = max(j, i + 1)
    return sorted(base + out)


def test_stretches_equal_plain_ones():
    pick = random.Random(8)
    ratio = np.random.default_rng(8).integers(-4, 4, len(se.ALPHABET) ** 2) / 1.0
    texts = ["".join(pick.choices("abcDE01+/ é", k=pick.randrange(60))) + pick.choice(["", "token=abcdefghijkl", "deadbeef00112233"]) for _ in range(300)]
    for text, (base, found) in zip(texts, se.spans_of(texts, ratio, 6.0), strict=True):
        assert base == plain(text) and found == plain_spans(text, ratio, 6.0), text


def test_many_languages(make):
    names = [f"l{i:03}" for i in range(600)]
    rows = [(i, f"{n}x {n}y {n}z " * 3, n) for i, n in enumerate(names)]
    docs = make(rows, "doc_id bigint, text string, lang string")
    model = li.train(docs, key=F.col("doc_id"))
    assert model.bits == li.BITS - 1 and model.weights.shape == (1 << model.bits, 600)
    got = [(r.lang, r.lang_pred) for r in li.predict(docs, model).collect()]
    assert sum(a == b for a, b in got) > 590


def test_names_that_clash(make):
    docs = make([(1, "token=abcdefghijkl", "en", 7, 8)], "doc_id bigint, text string, lang string, Score int, secrets int")
    found = li.predict(docs, li.train(docs, key=F.col("doc_id")))
    assert found.columns == [*docs.columns, "lang_pred", "score_"] and found.first()["Score"] == 7
    again = li.predict(found, li.train(docs, key=F.col("doc_id")))
    assert again.columns == [*found.columns, "lang_pred_", "score__"]
    found = se.scan(docs, se.train(docs, key=F.col("doc_id")))
    assert found.columns == [*docs.columns, "secrets_"] and found.first()["secrets"] == 8 and found.first()["secrets_"]["n_assign"] == 1


def test_odd_rows_of_secrets(make):
    rows = [(1, None, "k"), (2, "", "k"), (3, "x " * 500_000 + "AKIA" + "A" * 16, "k"), (4, "token=abcdefghijkl", "k"), (4, "token=abcdefghijkl", "k")]
    docs = make(rows, "doc_id bigint, text string, spans string")
    ratio = se.train(docs.limit(0))
    assert not ratio.any()
    got = [(r.doc_id, r.secrets.n_assign, r.secrets.n_access, r.secrets.base, r.secrets.spans) for r in se.scan(docs, ratio).orderBy("doc_id").collect()]
    assert got == [(1, 0, 0, "", ""), (2, 0, 0, "", ""), (3, 0, 1, "access:1000000:1000020", "access:1000000:1000020"), *[(4, 1, 0, "assign:0:18", "assign:0:18")] * 2]
    assert se.scan(docs.limit(0), ratio).count() == 0
