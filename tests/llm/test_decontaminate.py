"""Decontamination against a plain search for windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from showroom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, length=10):
    windows = {}
    for key, text in items:
        ws = words(text)
        n = min(length, len(ws))
        for p in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[p : p + n]), set()).add("" if key is None else str(key))
    sizes = {len(w) for w in windows}
    out = {}
    for key, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in sizes:
            for p in range(len(ws) - n + 1):
                if (names := windows.get(tuple(ws[p : p + n]))) is not None:
                    hit |= set(range(p, p + n))
                    found |= names
        out[key] = (len(ws), len(hit), sorted(found))
    return out


def cases(seed):
    pick = random.Random(seed)
    vocabulary = ["a", "b", "Cé", "d1", "ñ"]
    some = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    items = [(i, some(pick.choice([2, 5, 9, 10, 11, 25]))) for i in range(12)] + [(3, "a b\tCÉ"), (50, None), (51, "?!"), (None, "b b b b d1 d1"), (4, "a b\tCÉ")]
    docs = []
    for i in range(80):
        inner = pick.choice([t for _, t in items if t])
        docs.append((i, f"{some(pick.randrange(6))}. {inner.upper() if i % 5 == 0 else inner} {some(pick.randrange(30))}"))
    return docs + [(100, None), (101, ""), (102, "... \n"), (103, "a " * 100_000)], items


@pytest.mark.parametrize("block_words", [100_000, 30])
def test_marks_equal_a_plain_search(make, block_words):
    docs, items = cases(block_words)
    marked = dc.mark(
        make([(k, t, 5) for k, t in docs], "doc_id bigint, text string, contaminated int"), make(items, "item_id bigint, text string"),
        length=4 if block_words == 30 else 10, block_words=block_words)
    got = {r.doc_id: (r.contamination.n_words, r.contamination.n_hit, list(r.contamination["items"])) for r in marked.collect()}
    assert got == brute(docs, items, 4 if block_words == 30 else 10)


def test_spans_are_cut_and_covered_documents_go(make):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [
        (1, f"Start, {passage}; end é!", "x", 1, 7), (2, passage, "x", 1, 7), (3, "nothing here", None, 12, 7), (4, None, "x", 0, 7),
        (3, "nothing here", None, 12, 7), (5, " ".join(f"w{i}" for i in range(9)) + " end of it", "x", 1, 7)]
    docs = make(rows, "doc_id bigint, text string, lang string, n_chars bigint, contamination int")
    docs = docs.withColumn("text", F.when(docs.doc_id == 1, F.concat("text", F.lit(" " + "more " * 20))).otherwise(F.col("text")))
    out = dc.decontaminate(docs, make([(9, passage)], "item_id bigint, text string"))
    assert out.schema.simpleString() == docs.schema.simpleString()
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 3, 3, 4, 5]
    assert got[0].text == "Start, ; end é! " + "more " * 20 and got[0].n_chars == len(got[0].text)
    assert got[1].n_chars == 12 and got[4].text == rows[5][1] and got[4].n_chars == 1


def test_coverage_limit(make):
    item = make([(1, "a b c d e f")], "item_id bigint, text string")
    docs = make([(1, "x a b c y"), (2, "a b x c d")], "doc_id bigint, text string")
    hit = lambda c: {r.doc_id: r.contamination.n_hit for r in dc.mark(docs, item, coverage=c).collect()}
    assert hit(0.5) == {1: 3, 2: 0} and hit(1.0) == {1: 0, 2: 0}
    assert dc.mark(docs, item, coverage=0.5).first().contamination.longest == 3
    assert dc.mark(docs, item).first().contamination.longest == 0  # shorter than any window: not followed


def test_empty_tables(make):
    docs, items = make([], "doc_id bigint, text string"), make([], "item_id bigint, text string")
    some = make([(1, "a")], "doc_id bigint, text string")
    assert dc.mark(docs, make([(1, "a")], "item_id bigint, text string")).count() == 0
    assert dc.mark(some, items).first().contamination.n_hit == 0
