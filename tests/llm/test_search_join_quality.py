"""Top-k search, similarity join and quality classifier against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from showroom.llm import jaccard_join as jj
from showroom.llm import quality, topk_search
from showroom.llm.components import components
from showroom.llm.whole import LEAST, MOST
from showroom.llm.words import SPACES, separator_table, words_of

DATA = "/root/testdata/sf0.01"


# --- top-k search -----------------------------------------------------------------------------

def plain_top(rows, is_query, k):
    fine = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for me, q in {(i, tuple(v)) for i, v in fine if is_query(i)}:
        found = sorted((-min(max(sum(a * b for a, b in zip(q, v)), LEAST), MOST), i) for i, v in fine if i != me and len(v) == len(q))[:k]
        out |= {(me, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_search_equals_brute_force(make, seed):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.2 * pick.normal(size=8)) * pick.lognormal(0, 1.5 * seed)) for i in range(400)]
    rows = [(i, v.tolist()) for i, v in rows]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2010, [float("nan")] * 8), (2020, [float("inf")] * 8), (2030, [0.0] * 8), (2040, [1.0, 2.0]), (2050, [0.5, 0.5]), (2060, []), (None, [1.0] * 8), (7, rows[7][1]), (2070, [-x for x in rows[3][1]])]
    table = make([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    got = topk_search.top_k(table, F.col("vec_id") % 10 == 0, k=5, chunk_rows=50, block_rows=7)
    assert {tuple(r) for r in got.collect()} == plain_top(rows, lambda i: i % 10 == 0, 5)


def test_large_numbers_and_no_rows(make):
    """Scores are exact up to 64 bits; those beyond count as the nearest number of 64 bits."""
    rows = [(i, [float(2**18 + i), 3.0 * i]) for i in range(20)]
    rows += [(20 + i, [float(2**k) * (1 + i % 3), -3.0 * i]) for i, k in enumerate([10, 20, 21, 20, 21, 900] * 4)]
    table = make(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in topk_search.top_k(table, F.col("vec_id") % 3 == 0, k=7, chunk_rows=9, block_rows=4).collect()}
    assert got == plain_top(rows, lambda i: i % 3 == 0, 7)
    assert {s for _, _, _, s in got} & {MOST} and any(2**53 < s < MOST for _, _, _, s in got)
    assert topk_search.top_k(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk_search.top_k(table, F.lit(False)).count() == 0


def test_pruning_never_loses_a_row():
    pick = np.random.default_rng(9)
    for _ in range(200):
        v = np.floor(1024 * pick.normal(size=(60, 4)) * pick.lognormal(0, 1, size=(60, 1))).astype(np.int64)
        q = np.floor(1024 * pick.normal(size=(1, 4))).astype(np.int64)
        scores = v @ q[0]
        floor = float(np.sort(scores)[-pick.integers(1, 30)])
        place, score = topk_search.search(q, v, np.array([floor]), np.array([-1]), np.arange(60), 60)[0]
        assert sorted(place.tolist()) == np.flatnonzero(scores >= floor).tolist() and (scores[place] == score).all()


# --- similarity join --------------------------------------------------------------------------

def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    def root(k):
        while group[k] != k:
            k = group[k]
        return k
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                group[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((str(k), len(sets[i]), str(None if k is None else least[root(i)])) for i, (k, _) in enumerate(rows)))


def near_copies(seed, n):
    """Groups of near copies around the threshold, with shared passages and chains of edits."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choices("abcdefghij", k=4))
    common = [" ".join(word() for _ in range(8)) for _ in range(3)]
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(pick.choice([3, 5, 12, 40, 90]))]
        chain = list(base)
        for _ in range(pick.choice([1, 1, 3, 12])):
            text = list(chain if pick.random() < 0.5 else base)
            for _ in range(pick.randrange(4)):
                text[pick.randrange(len(text))] = word()
            if pick.random() < 0.5:
                text += pick.choice(common).split()
            chain = text[: len(chain)]
            rows.append((len(rows) * 3 % 1009, pick.choice([" ", "\n", "\t "]).join(text).upper() if pick.random() < 0.1 else " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_all_pairs(make, seed, monkeypatch):
    if seed == 2:  # every n-gram of a few documents counts as frequent
        monkeypatch.setattr(jj, "SAMPLE_ROWS", 100)
    rows = near_copies(seed, 260) + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "a b c d"), (2006, "a b c d e"), (None, "one"), (2003, "one"), (2010, "w " * 100_000)]
    docs = make([(*r, 1) for r in rows], "doc_id bigint, text string, n_shingles int")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jj.similar(docs, fragments=1 + 3 * seed).collect())
    assert got == plain_components(rows)


def test_one_hot_group(make):
    """Near copies of one text, a third of which lie just beyond the threshold of the base."""
    pick = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(5_000, " ".join(base))]
    for i in range(300):
        text = list(base)
        for at in pick.sample(range(60), 1 + i % 4):
            text[at] = f"x{pick.randrange(50)}"
        rows.append((i, " ".join(text)))
    docs = make(rows, "doc_id bigint, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jj.similar(docs).collect())
    assert got == plain_components(rows)
    assert jj.similar(docs.limit(0)).count() == 0


def test_ngrams_are_whole_and_distinct():
    texts = ["a b c d e f a b c d e", "a b c", "c b a", "", None, "A B C D E"]
    hashes, bounds = jj.ngrams(words_of(pa.array(texts), separator_table(SPACES), lower=True))
    sets = [set(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts] == np.diff(bounds).tolist()
    assert sets[5] < sets[0] and not sets[1] & sets[2]


def test_components(make):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(pick.randrange(200, 400), pick.randrange(200, 400)) for _ in range(150)] + [(7, 7), (None, 3)]
    group = {}
    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x
    for a, b in links[:-2]:
        if a != b:
            x, y = sorted((root(a), root(b)))
            group[y] = x
    got = {(r.node, r.component) for r in components(make(links, "a bigint, b bigint")).collect()}
    assert got == {(x, root(x)) for x in list(group) if any(a != b and x in (a, b) for a, b in links[:-2])}
    assert components(make([], "a bigint, b bigint")).count() == 0


# --- quality ----------------------------------------------------------------------------------

def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    judged = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1").withColumnRenamed("quality", "y"), "doc_id")
    right, n = judged.agg(F.sum(((F.col("y") == 1) == F.col("quality.kept")).cast("int")), F.count("*")).first()
    assert right / n > 0.97


def test_rates_shrink_toward_their_parents(make):
    rows, labels, key = [], [], 0
    for host, path, n, good in [("a", "x", 400, 360), ("a", "y", 400, 40), ("b", "x", 400, 380), ("b", "y", 2, 0), ("c", "x", 300, 30), (None, None, 3, 3)]:
        for i in range(n):
            rows.append((key, host, path))
            labels.append((key, int(i < good)))
            key += 1
    docs = make(rows + [(key, "d", "x")], "doc_id bigint, source string, lang string")
    table = quality.posteriors(docs, make(labels + [(key + 5, 1), (None, 1), (key, None)], "doc_id bigint, quality int"), F.col("source"), F.col("lang"))
    rate = {(r.level, r.host, r.path): r.rate for r in table.collect()}
    all_ = (sum(y for _, y in labels) + 0.5) / (len(labels) + 1)
    assert rate[0, None, None] == pytest.approx(all_) and len(rate) == 1 + 4 + 6
    assert 0.85 < rate[2, "a", "x"] < 0.9 and 0.1 < rate[2, "a", "y"] < 0.15
    assert 0.2 < rate[2, "b", "y"] < rate[1, "b", None]  # two bad documents say less than the many of the host
    assert 0.1 < rate[1, "c", None] < all_


def test_site_evidence_moves_a_document(make):
    text = "plain words of an ordinary document"
    rows = [(i, text, "good" if i % 2 else "bad", "en") for i in range(200)] + [(900, text, "good", "en"), (901, text, "bad", "en"), (902, text, None, None), (903, None, "new", "en"), (904, "", "new", "en"), (905, "x " * 200_000, "new", "en"), (900, text, "good", "en")]
    docs = make([(*r, 1) for r in rows], "doc_id bigint, text string, source string, lang string, quality int")
    judged = quality.judge(docs, make([(i, i % 2) for i in range(200)], "doc_id bigint, quality int"), result="found")
    got = {r.doc_id: r.found for r in judged.collect()}
    assert judged.count() == len(rows) and got[900].kept and not got[901].kept
    assert got[900].document == pytest.approx(got[901].document)
    kept = quality.good(docs, make([(i, i % 2) for i in range(200)], "doc_id bigint, quality int"))
    assert kept.schema.simpleString() == docs.schema.simpleString()


def plain_strength(groups):
    """Of (n, good, rate of the parent): by moments, within the bounds."""
    excess = sum(n * (g / n - p) ** 2 for n, g, p in groups) - sum(p * (1 - p) for _, _, p in groups)
    room = sum(p * (1 - p) * (n - 1) for n, _, p in groups)
    rho = excess / room if room > 0 else 0
    low, high = quality.STRENGTH
    return min(max(1 / rho - 1, low), high) if rho > 0 else high


def test_scores_equal_plain_ones(make):
    """Rates of hosts and paths, and the combined score, from their formulas; the document's share from its features."""
    pick = random.Random(6)
    rows, labels = [], {}
    for i in range(400):
        good = pick.random() < {"a": 0.9, "b": 0.4, None: 0.6}[host := pick.choice(["a", "b", None])]
        text = " ".join(pick.choices(["alpha", "beta", "gamma", "delta"] if good else ["!!", "AAA", "9", "alpha"], k=pick.randrange(1, 40)))
        rows.append((i, text, host, pick.choice(["x", "y", None])))
        if i % 2:
            labels[i] = int(good)
    docs = make(rows, "doc_id bigint, text string, source string, lang string")
    table = make(list(labels.items()), "doc_id bigint, quality int")
    model = quality.train(docs, table)
    all_ = (sum(labels.values()) + 0.5) / (len(labels) + 1)

    def counted(key):
        out = {}
        for i, _, host, path in rows:
            if i in labels:
                n, g = out.get(key(host, path), (0, 0))
                out[key(host, path)] = (n + 1, g + labels[i])
        return out

    hosts, paths = counted(lambda h, p: h), counted(lambda h, p: (h, p))
    m = plain_strength([(n, g, all_) for n, g in hosts.values()])
    of_host = {h: (g + m * all_) / (n + m) for h, (n, g) in hosts.items()}
    m = plain_strength([(n, g, of_host[h]) for (h, _), (n, g) in paths.items()])
    of_path = {(h, p): (g + m * of_host[h]) / (n + m) for (h, p), (n, g) in paths.items()}
    for r in quality.judge(docs, table).collect():
        odds = float(model.log_odds(quality.features(pa.array([r.text])))[0])
        host, path = of_host.get(r.source, all_), of_path.get((r.source, r.lang), of_host.get(r.source, all_))
        score = 1 / (1 + np.exp(-(np.log(path / (1 - path)) + odds - model.base)))
        assert (r.quality.document, r.quality.host, r.quality.path, r.quality.score) == pytest.approx((1 / (1 + np.exp(-odds)), host, path, score))
        assert r.quality.kept == (score >= quality.KEEP)


def test_repeated_labelled_rows_are_bounded(make):
    docs = make([(i % 3, f"some text {i % 50} here", "s", "en") for i in range(600)], "doc_id bigint, text string, source string, lang string")
    labels = make([(0, 1), (1, 0), (2, 1)], "doc_id bigint, quality int")
    assert quality.judge(docs, labels, rows=3).count() == 600


def test_without_labels_all_stay(make):
    docs = make([(1, "a", "s", "en"), (2, None, None, None)], "doc_id bigint, text string, source string, lang string")
    none = make([], "doc_id bigint, quality int")
    assert quality.good(docs, none).count() == 2 and quality.good(docs.limit(0), none).count() == 0


def test_one_row_of_each_group_of_links_with_repeated_ids(make):
    """Rows of one id whose texts don't link are different documents: only near copies and repeated rows go."""
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    near = lambda i: text(i) + " end"
    rows, want = [], []
    for i in range(8):
        # A near copy of a smaller id next to a text of its own; two such texts; a repeated row; two near copies of one id.
        rows += [(100 * i + 1, text(i)), (100 * i + 5, near(i)), (100 * i + 5, text(20 + i)), (100 * i + 7, text(40 + i)), (100 * i + 7, text(60 + i))]
        rows += [(100 * i + 8, text(80 + i)), (100 * i + 8, text(80 + i)), (100 * i + 9, text(100 + i)), (100 * i + 9, near(100 + i))]
        want += [(100 * i + 1, text(i)), (100 * i + 5, text(20 + i)), (100 * i + 7, text(40 + i)), (100 * i + 7, text(60 + i)), (100 * i + 8, text(80 + i))]
    rows += [(3, None), (3, ""), (3, " "), (4, ""), (None, "n"), (None, "n")]
    docs = make([(k, t, 1) for k, t in rows], "doc_id bigint, text string, mark int")
    out = jj.first_of_each(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    ninth = [(k, t) for k, t in got if k is not None and k % 100 == 9]
    assert sorted(k for k, _ in ninth) == [100 * i + 9 for i in range(8)]
    rest = [(k, t) for k, t in got if (k, t) not in ninth and k not in (3, 4, None)]
    assert sorted(rest) == sorted(want)
    assert sorted(str(k) for k, _ in got if k in (3, 4, None)) == ["3", "4", "None", "None"]
