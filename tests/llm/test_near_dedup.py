"""Near duplicates against all pairs; pivots against all pairs of a bucket; signatures against the plain algorithm."""

import random

import numpy as np
import pytest

from showroom.llm import near_dedup as nd
from showroom.llm import pivots
from showroom.llm.hashing import mix
from showroom.llm.pivots import connected, forest

SCHEMA = "doc_id bigint, text string"


def shingles(text, n=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def grouped(sets, percent, may_link=lambda x, y: True):
    """The smallest key reachable over links, by key."""
    above = {k: k for k in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    keys = sorted(sets)
    for i, x in enumerate(keys):
        for y in keys[:i]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]) and may_link(x, y):
                a, b = top(x), top(y)
                above[max(a, b)] = min(a, b)
    return {k: top(k) for k in keys}


def varied(pick, words, edits):
    words = list(words)
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return words


def texts(seed):
    pick = random.Random(seed)
    out = []
    for _ in range(12):
        base = [f"w{pick.randrange(3000)}" for _ in range(pick.choice([8, 40, 120]))]
        out += [" ".join(varied(pick, base, pick.choice([0, 0, 1, 2, 4]))) for _ in range(pick.choice([1, 3, 10]))]
    template = [f"t{i}" for i in range(100)]
    out += [" ".join(varied(pick, template, pick.choice([1, 2, 3, 5, 8]))) for _ in range(60)]
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [0])
def test_equal_to_all_pairs(make, seed):
    rows = dict(enumerate(texts(seed)))
    table = make([(i, t, 1, "x", 0) for i, t in rows.items()], SCHEMA + ", sig int, mark string, band0 int").repartition(5)
    found = nd.near_duplicates(table).collect()
    want = grouped({i: shingles(t) for i, t in rows.items()}, 85)
    assert len(found) == len(rows) and {r["doc_id"]: r["component_id"] for r in found} == want
    assert all(r["n_shingles"] == len(shingles(rows[r["doc_id"]])) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert len(set(want.values())) < len(want) - 20


def test_odd_rows(make):
    long = "lorem ipsum " * 3 + " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One Two"), (5, "one\ttwo"), (6, "one"), (7, long), (8, long + " end"), (7, long), (7, "another text stands here"),
            (9, "another text stands here"), (None, long), (None, "alone it has no id"), (10, "alone it has no id"), (11, "ÄÖ ÜX yz ab"), (12, "äö üx yz ab")]
    found = sorted(nd.near_duplicates(make(rows, SCHEMA).repartition(4)).collect(), key=lambda r: (r["doc_id"] or 0, r["n_shingles"]))
    assert [(r["doc_id"], r["component_id"]) for r in found] == [
        (None, None), (None, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (7, 7), (7, 7), (8, 7), (9, 7), (10, 10), (11, 11), (12, 12)]
    assert nd.near_duplicates(make([], SCHEMA)).count() == 0
    assert [tuple(r) for r in nd.near_duplicates(make([(1, None)], SCHEMA)).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("seed", range(2))
def test_pivots_leave_no_pair_of_a_bucket_out(spark, make, seed, monkeypatch):
    """Members of one bucket that are far from each other, near in pairs, and in groups; every pair of a cluster of buckets is found."""
    monkeypatch.setattr(pivots, "SMALL", 4)  # several rounds
    pick = random.Random(seed)
    core = set(pick.sample(range(10**6), 60))
    sets, buckets = {}, []
    for group in range(25):
        own = (core - set(pick.sample(sorted(core), 12))) | set(pick.sample(range(10**6), 14))
        for _ in range(pick.choice([1, 1, 2, 4])):
            cls = len(sets) + 100
            sets[cls] = (own - set(pick.sample(sorted(own), 3))) | {pick.randrange(10**6) for _ in range(pick.choice([0, 2, 4]))}
            buckets += [(1, cls)] if group % 5 else [(2, cls), (3 + cls % 2, cls)]
    of = {c: {k for k, x in buckets if x == c} for c in sets}
    parts = [(c, len(s), p, sorted(x for x in s if x % 4 == p)) for c, s in sets.items() for p in range(4)]
    found = connected(make(buckets, "key bigint, cls bigint"), make(parts, "cls bigint, n bigint, piece int, part array<bigint>"), 80)
    hangs = grouped({c: frozenset(of[c]) for c in sets}, 0)
    want = grouped(sets, 80, lambda x, y: hangs[x] == hangs[y])
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {c: got.get(c, c) for c in sets} == want and len(set(want.values())) < len(sets)


def test_far_copies_of_one_origin_are_not_paired(make, monkeypatch):
    """Half of the copies link with the origin, the others with none, and all share what they lack: the tables of pairs stay as small as the group, not its square."""
    pick, rows = random.Random(3), {}
    core = list(range(100))
    sets = {c: set(core) - set(pick.sample(core, k)) | set(range(1000 * c, 1000 * c + k)) for c in range(1, 301) for k in [4 if c % 2 else 12]} | {0: set(core)}

    def counted(df, name, write=pivots.written):
        out = write(df, name)
        if {"a", "b"} <= set(df.columns) and not {"only", "item"} & set(df.columns):
            rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(pivots, "written", counted)
    parts = [(c, len(s), p, sorted(x for x in s if x % 4 == p)) for c, s in sets.items() for p in range(4)]
    found = connected(make([(1, c) for c in sets] + [(2, 0), (2, 1), (3, 0), (3, 2)], "key bigint, cls bigint"), make(parts, "cls bigint, n bigint, piece int, part array<bigint>"), 85)
    assert found.count() == 151
    assert rows and max(rows.values()) <= 2 * len(sets), rows


def test_texts_are_read_by_mark(make):
    docs = make([(i, i * 2**54 - 2**63 + i, f"text {i}") for i in range(1000)], "doc_id bigint, mark bigint, text string")
    needed = docs.where("doc_id % 7 = 3").select("mark")
    found = nd.of_marks(docs, needed.union(needed.limit(5)))
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(3, 1000, 7))


def test_forest_joins_the_same(make):
    pick = random.Random(1)
    links = [(pick.randrange(200), pick.randrange(200)) for _ in range(600)]
    kept = [tuple(r) for r in forest(make(links, "a bigint, b bigint").repartition(3)).collect()]

    def least(pairs):
        return grouped({i: frozenset() for i in range(200)} | {}, 0) if not pairs else grouped(
            {i: frozenset([i, -1]) for i in range(200)}, 0, lambda x, y: (x, y) in pairs or (y, x) in pairs)

    assert len(kept) < len(links) and set(kept) <= set(links) and least(set(kept)) == least(set(links))


def plain_minhash(values, slots):
    """The algorithm for one set, shingle after shingle, with the same draws and without the early stop."""
    out = [float("inf")] * slots
    for x in values:
        order = list(range(slots))
        for step in range(slots):
            drawn = int(mix(np.array([x], np.uint64), step)[0])
            other = step + ((drawn & 0xFFFFFFFF) * (slots - step) >> 32)
            order[step], order[other] = order[other], order[step]
            out[order[step]] = min(out[order[step]], step + (drawn >> 32) / 2**32)
    return out


def test_signatures(monkeypatch):
    pick = np.random.default_rng(2)
    sizes = [0, 1, 2, 7, 30, 200, 0, 5]
    hashes = pick.integers(0, 2**63, sum(sizes)).astype(np.uint64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    want = [plain_minhash(hashes[a:b].tolist(), 20) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert nd.super_minhash(hashes, bounds, 20).tolist() == want
    monkeypatch.setattr(nd, "BLOCK", 16)  # a set in several blocks
    assert nd.super_minhash(hashes, bounds, 20).tolist() == want


def test_equal_slots_estimate_similarity():
    pick = np.random.default_rng(4)
    found = []
    for _ in range(60):
        both, one, other = (pick.integers(0, 2**63, n).astype(np.uint64) for n in (150, 25, 25))
        x, y = (nd.super_minhash(np.concatenate([both, own]), np.array([0, 175]), 125)[0] for own in (one, other))
        found.append((x == y).mean())
    assert abs(np.mean(found) - 0.75) < 0.02
