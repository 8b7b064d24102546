"""Nodes of the conversation trie against a brute-force trie."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from showroom.llm import conversation_trie as ct


def plain(sequences):
    """Rows of all nodes; ``sequences``: id to turns (name, characters)."""
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (p[-1][-1] if p else 0)
    ends = {p: ",".join(map(str, sorted(c for c in m if len(sequences[c]) == len(p)))) for p, m in members.items()}
    return {
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, m in members.items()}


def random_sequences(seed, rows):
    pick = random.Random(seed)
    said = {"a": 3, "b": 5, "c": 0}
    return {i - 20: tuple((w := pick.choice("abc"), said[w]) for _ in range(pick.choice([0, 1, 2, 3, 3, 4, 8]))) for i in range(rows)}


@pytest.mark.parametrize("seed", range(40))
def test_nodes_of_one_slice(seed):
    rows = random_sequences(seed, [1, 2, 5, 60][seed % 4])
    keys = {c: b"".join(hashlib.md5(w.encode()).digest() for w, _ in s) for c, s in rows.items()}
    order = sorted(rows, key=lambda c: (keys[c], c))
    n = ct.nodes_of([keys[c] for c in order], np.array([x for c in order for _, x in rows[c]], np.int64), np.array(order))
    n["parent_conv_id"] = n["parent_conv_id"].to_pylist()
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    got = list(zip(*[n[c] for c in columns], strict=True))
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_extents_without_a_stack():
    pick = np.random.default_rng(3)
    values = pick.integers(0, 5, 77)
    table = ct.RangeMinimum(values)
    for at in range(77):
        for least in range(6):
            left, right = at, at
            while left > 0 and values[left] >= least:
                left -= 1
            while right + 1 < 77 and values[right + 1] >= least:
                right += 1
            assert table.left(np.array([at]), np.array([least]))[0] == left and table.right(np.array([at]), np.array([least]))[0] == right
    first = pick.integers(0, 77, 200)
    last = np.minimum(76, first + pick.integers(0, 40, 200))
    assert table.minimum(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]


def conversations(sequences):
    return [(c, i, w, "x" * n) for c, s in sequences.items() for i, (w, n) in enumerate(s)]


@pytest.mark.parametrize("seed", [1, 2])
def test_many_slices(make, seed):
    rows = {c: s for c, s in random_sequences(seed, 300).items() if s}
    rows |= {1000 + i: (("a", 3), ("b", 5)) for i in range(200)}  # equal ones fill several slices
    said = [(i, c, w, t, i) for c, i, w, t in conversations(rows)]
    random.Random(seed).shuffle(said)
    found = ct.trie(ct.sequences(make(said, "turn int, conv_id bigint, role string, text string, path int")), slice_turns=40).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == plain(rows)


def test_odd_rows(make):
    said = [
        (1, None, None, None), (1, 5, "user", "wörter"), (1, 5, "user", "wörter"), (2, 1, "user", ""), (2, 2, None, "x" * 300_000), (3, -4, "user", None),
        (3, 7, "", "x" * 300_000), (None, 1, "user", "lost"), (4, 1, "use", "r"), (5, 1, "us", "er")]
    found = {tuple(r) for r in ct.trie(ct.sequences(make(said, "conv_id int, turn int, role string, text string"))).collect()}
    long, user = ("", "x", 300_000), ("user", "", 0)
    assert found == plain({
        1: (("", "", 0), ("user", "wörter", 6), ("user", "wörter", 6)), 2: (user, long), 3: (user, long), 4: (("use", "r", 1),), 5: (("us", "er", 2),)})


def test_empty_and_turnless(spark, make):
    none = make([], "conv_id bigint, turn bigint, role string, text string")
    assert ct.trie(ct.sequences(none)).count() == 0
    turnless = spark.sql("SELECT id AS conv_id, filter(array(named_struct('digest', '', 'chars', 0)), x -> false) AS turns FROM range(3)")
    assert [tuple(r) for r in ct.trie(turnless).collect()] == [(0, 0, None, 3, 0, 1, 0, hashlib.sha256(b"0,1,2").hexdigest())]
