"""Hard negatives against a search of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from showroom.llm import hard_negatives as hn
from showroom.llm.whole import LEAST, MOST

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, is_anchor, scale=256, percent=80, positives=5, negatives=5):
    """Rows of all anchors; a score beyond 64 bits is the nearest number of 64 bits."""
    fine = [
        (i, [int(np.floor(scale * x)) if abs(x) < 1e300 else int(scale * x) for x in v], y) for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for me, q, label in {(i, tuple(v), y) for i, v, y in fine if is_anchor(i)}:
        near, far = [], []
        for i, v, y in fine:
            if i != me and len(v) == len(q):
                score = min(max(sum(a * b for a, b in zip(q, v, strict=True)), LEAST), MOST)
                (near if y == label else far).append((-score, i))
        for s, p in sorted(near)[:positives]:
            fit = [(t, i) for t, i in sorted(far) if percent * -s <= 100 * -t <= 100 * -s]
            out += [(me, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(fit[:negatives])]
    return sorted(out)


def found(rows):
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("seed", [0, 1])
def test_equal_to_all_rows(make, seed):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(4, 20))
    rows = [(i, (centres[i % 4] + (0.3 + seed) * pick.normal(size=20)).tolist(), int(pick.integers(0, 3))) for i in range(500)]
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(60)]  # ties
    rows += [(2000, None, 1), (2010, [1.0, None] + [0.0] * 18, 1), (2020, [float("nan")] * 20, 1), (2030, [float("inf")] * 20, 1), (2040, rows[5][1], None),
             (2050, [0.0] * 20, 1), (2060, [1.0, 2.0], 0), (2070, [0.5, 1.5], 1), (2080, [0.5, 1.0], 0), (2090, [], 0), (2100, [], 0), (2110, [], 1),
             (None, [1.0] * 20, 1), (7, rows[7][1], rows[7][2]), (10, rows[10][1], rows[10][2])]
    table = make([(*r, 1, "x") for r in rows], SCHEMA + ", chunk int, q string")
    want = plain(rows, lambda i: i % 10 == 0)
    assert found(hn.mine(table, F.col("vec_id") % 10 == 0, chunk_rows=60, block_rows=9)) == want and len(want) > 300


def test_hot_label_and_few_rows(make):
    pick = np.random.default_rng(5)
    rows = [(i, np.abs(pick.normal(size=6)).tolist(), 0 if i % 40 else i % 3) for i in range(400)]
    got = hn.mine(make(rows, SCHEMA), F.col("vec_id") % 20 == 0, chunk_rows=50, positives=3, negatives=2, percent=95)
    assert found(got) == plain(rows, lambda i: i % 20 == 0, positives=3, negatives=2, percent=95)
    few = [(0, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2)]
    assert found(hn.mine(make(few, SCHEMA), F.col("vec_id") == 0)) == [(0, 1, 1, 2, 256 * 256, 256 * 256)]


def test_text_labels(make):
    rows = [(0, [1.0], "a"), (1, [1.0], "a"), (2, [1.0], "b"), (3, [0.5], None), (4, [0.9], "c")]
    table = make(rows, "vec_id bigint, embedding array<float>, label string")
    assert {r["negative_id"] for r in hn.mine(table, F.col("vec_id") == 0).collect()} == {2, 4}


def test_large_numbers(make):
    rows = [(i, [float(2**k) * (1 + i % 5), 3.0 * i, -float(2**k)], i % 2) for i, k in enumerate([10, 30, 40, 60, 200, 1000] * 6)]
    table = make(rows, SCHEMA)
    assert found(hn.mine(table, F.col("vec_id") % 3 == 0, scale=1, chunk_rows=9)) == plain(rows, lambda i: i % 3 == 0, scale=1)


def test_no_rows(make):
    assert hn.mine(make([], SCHEMA), F.col("vec_id") == 0).count() == 0
    assert hn.mine(make([(1, [1.0], 1)], SCHEMA), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_scan_never_loses_a_row(seed):
    pick = np.random.default_rng(seed)
    columns = np.floor(256 * pick.normal(size=(30, 80)) * pick.lognormal(0, 1, size=(30, 1)))
    q = np.floor(256 * pick.normal(size=30))
    scores = (q @ columns).astype(np.int64)
    ends = np.sort(pick.choice(scores, (3, 2)), axis=1)
    candidates = np.flatnonzero(pick.random(80) < 0.8)
    place, found, floors = hn.scan(q, columns, candidates, ends[:, 0], ends[:, 1], 4)
    assert (scores[place] == found).all()
    for (low, high), floor in zip(ends, floors, strict=True):
        want = sorted((-scores[c], c) for c in candidates if low <= scores[c] <= high)[:4]
        inside = (found >= floor) & (found <= high)
        assert sorted((-s, p) for s, p in zip(found[inside], place[inside], strict=True))[:4] == want
