"""The pipeline against brute force, stage by stage on its own input."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import brute
from test_mixing import plain

from showroom.llm import quality
from showroom.llm import token_files as tf

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], DATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_keep_the_columns(stages):
    assert all(s.schema.simpleString() == stages[0].schema.simpleString() for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]


def test_good_documents_stay(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert kept == {r.doc_id for r in quality.judge(stages[0], spark.read.parquet(f"{DATA}/labels.parquet")).where("quality.kept").collect()}
    right = [(k in kept) == bool(q) for k, q in labels.items()]
    assert sum(right) / len(right) > 0.97


def test_one_of_each_group(stages):
    rows = {r.doc_id: shingles(r.text) for r in stages[1].collect()}
    group = {k: k for k in rows}
    def root(k):
        while group[k] != k:
            k = group[k]
        return k
    ids = sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(rows[a] & rows[b])
            if common and 100 * common >= 80 * (len(rows[a]) + len(rows[b]) - common):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(k for k in ids if root(k) == k)


def test_passages_are_gone(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    before = brute([(r.doc_id, r.text) for r in stages[2].collect()], items)
    after = {r.doc_id: r for r in stages[3].collect()}
    assert set(after) == {k for k, (n, hit, _) in before.items() if hit <= 0.5 * n}
    words = brute([(k, r.text) for k, r in after.items()], [])
    given = {r.doc_id: r for r in stages[2].collect()}
    for k, r in after.items():
        assert words[k][0] == before[k][0] - before[k][1] and r.n_chars == len(r.text)
        if not before[k][1]:
            assert r == given[k]


def test_mix(stages):
    want = {k: t for k, _, _, _, t in plain([(r.doc_id, r.text, r.source) for r in stages[3].collect()])}
    got = defaultdict(int)
    for r in stages[4].collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    assert dict(got) == {k: v for k, v in want.items() if v}


def test_token_ids(stages):
    ids = {}
    rows = stages[4].collect()
    for r, x in zip(rows, tf._tokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode_batch([r.text for r in rows], add_special_tokens=False)):
        ids.setdefault(r.doc_id, []).append(np.array([*x.ids, 2], "<u4"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in stages[5].collect())
    assert [r[1] for r in got] == sorted(r.doc_id for r in rows)
    assert [r[0] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    want = Counter((k, len(x), zlib.crc32(x.tobytes())) for k, xs in ids.items() for x in xs)
    assert Counter(r[1:] for r in got) == want


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_pass_all_stages(spark, make):
    rows = [
        (None, None, None, None, None), (None, "a text without id", "en", "s", 17), (1, "", "en", None, 0), (2, None, "fr", "s", None),
        (3, "many words of one text " * 40_000, "en", "s", 1), (4, "some plain words in a row", "en", "s", 25), (4, "some plain words in a row", "en", "s", 25),
        (5, "some plain words in a row", None, "t", 25)]
    docs = make(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = docs
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, out, DATA)
        if name == "n-gram Jaccard join":
            assert Counter(r.doc_id for r in out.collect()) == {None: 2, 1: 1, 2: 1, 3: 1, 4: 1}
    assert out.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DATA)
    assert empty.count() == 0
    assert corpus_pipeline.STAGES[0][1](spark, docs, DATA).count() >= 1
