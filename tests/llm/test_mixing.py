"""Mixing against a plain loop over sources and documents."""

import hashlib
import re
from collections import defaultdict

import pytest

from showroom.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """The excess is shared again until no target is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left, free = {}, float(sum(sizes.values())), list(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]
            free.remove(s)


def plain(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    groups = defaultdict(list)
    for key, text, source in rows:
        digest = hashlib.md5(f"0\x1f{'' if key is None else key}".encode()).hexdigest()
        groups[source].append((int(digest[:15], 16), key, size(text)))
    goals = plain_targets({s: sum(x[2] for x in g) for s, g in groups.items()})
    out = []
    for s, g in groups.items():
        total, before = sum(x[2] for x in g), 0
        epochs = int(goals[s]) // total if total else 0
        rest = int(goals[s]) - epochs * total
        for _, key, n in sorted(g):
            out.append((key, n, total, round(goals[s], 6), epochs * n + max(0, min(n, rest - before))))
            before += n
    return sorted(out)


SKEWED = [(i, "w é\x85x " * (i % 7), "hot") for i in range(200)] + [(1000 + i, "a\n\tb c", f"s{i % 4}") for i in range(40)] + [
    (2000, None, "z"), (2001, " \n", "z"), (2002, "x", None), (2003, "long " * 50_000, "big"), (2004, "y", "tiny")]


@pytest.mark.parametrize("slice_rows", [10_000, 10])
@pytest.mark.parametrize("rows", [SKEWED, [(1, "a b", "x")], [(1, None, "x")], [(i, "a " * i, "xyz"[i % 3]) for i in range(30)]])
def test_mix_equals_a_plain_loop(make, rows, slice_rows):
    docs = make([(*r, 1) for r in rows], "doc_id bigint, text string, source string, target int")
    got = sorted(
        (r.doc_id, r["mix"]["size"], r["mix"].source_size, round(r["mix"].target, 6), r["mix"].taken)
        for r in mixing.mix(docs, slice_rows=slice_rows).collect())
    assert got == plain(rows)


def test_excess_cascades():
    assert plain_targets({"a": 1, "b": 1, "c": 100})["c"] == 96.0


def test_targets_with_several_limits(make):
    for sizes in ({"a": 100, "b": 1, "c": 2, "d": 30, "e": 7, "f": 5}, {"a": 10, "b": 10, "c": 10, "d": 0, None: 3}, {"a": 1000, "b": 200, "c": 300, "d": 2, None: 500}):
        rows = make([(s, 1, n) for s, n in sizes.items()], "source string, n bigint, source_size bigint")
        got = {r.source: r.target for r in mixing.targets(rows).collect()}
        assert got == pytest.approx(plain_targets(sizes)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mixed_corpus_holds_what_is_taken(make):
    docs = make([(*r, 9, "k") for r in SKEWED], "doc_id bigint, text string, source string, n_chars bigint, mix string")
    plan = {r.doc_id: r["mix"].taken for r in mixing.mix(docs.drop("mix"), slice_rows=10).collect()}
    out = mixing.mixed(docs, slice_rows=10)
    assert out.schema.simpleString() == docs.schema.simpleString()
    words, seen = defaultdict(int), {k: t for k, t, _ in SKEWED}
    for r in out.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert seen[r.doc_id].startswith(r.text) and r.n_chars == (9 if r.text == seen[r.doc_id] else len(r.text))
    assert words == {k: v for k, v in plan.items() if v}


def test_repeated_rows_share_alike_and_nothing_stays_nothing(make):
    rows = [(1, "a b c d", "x")] * 5 + [(2, "a b c d", "y")]
    docs = make(rows, "doc_id bigint, text string, source string")
    got = sorted((r.source, r["mix"].taken) for r in mixing.mix(docs).collect())
    assert len(set(got[:5])) == 1 and got[5] == ("y", 12) and got[0] == ("x", 2)
    assert mixing.mixed(make([], "doc_id bigint, text string, source string")).count() == 0
