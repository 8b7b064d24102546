"""The trie of all conversation prefixes, from sorted sequences and their common prefixes.

A conversation is its sequence of turns (role, text), each as a digest of 16 bytes. The joined digests are one sort key: equal
prefixes stand together, and shorter sequences before their continuations. A range sort deals the sequences to slices.

A slice knows the number of turns that each sequence shares with the one before it (LCP). A sparse table holds the minimum
of every run of 2^k of them. Every row proposes the prefixes that the row before it lacks; each candidate searches its left and right
extent on its own, by halving steps over the table, and so gets the interval of its members. There is no stack and no order among candidates.
What a node reports are differences of running sums over its interval.

Only the nodes on the path along a border of two slices lie in several slices ("open", at most the length of that path each). They report
sums of their part, which are added by path. A node's parent is found in its slice; where that is open, by (slice, path), so
that the children of a very common prefix stay spread over their slices.

Defined cases: rows without conversation id take no part; turns go by turn number, null first, then role and digest; null role or text are
empty; repeated rows are turns each; conversations of equal turns are members of the same nodes; a conversation without turns is a member of
the root; without conversations there is no node; other columns are not read. Texts are compared by MD5, and only their digests and lengths move.
The turns of one conversation, as about 40 bytes each, have to fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.shared import exact, written

#: Turns of a slice, about.
SLICE_TURNS = 50_000
DIGEST = 16
EMPTY = hashlib.sha256(b"").hexdigest()

_NODES = (
    "slice bigint, open boolean, path binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends string, parent_conv_id bigint, parent_path binary")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turns): one per conversation, its turns in order as structs of ``digest`` (hex) and ``chars``."""
    said = conversations.select(
        exact(conv_id).cast("bigint").alias("conv_id"), exact(turn).cast("bigint").alias("turn"),
        F.coalesce(exact(role).cast("string"), F.lit("")).alias("role"), F.coalesce(exact(text).cast("string"), F.lit("")).alias("text"))
    entry = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), "role",
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest"), F.length("text").alias("chars"))
    turns = said.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return turns.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


class RangeMinimum:
    """Sparse table over ``values``: minima of all runs of 2^k."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place that is reached from ``at`` over values of ``least`` or more."""
        place, n = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            on = np.flatnonzero(place + (1 << k) < n)
            on = on[self.levels[k][place[on] + 1] >= least[on]]
            place[on] += 1 << k
        return place

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from which ``at`` is reached over values of ``least`` or more."""
        place = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            on = np.flatnonzero(place >= 1 << k)
            on = on[self.levels[k][place[on] - (1 << k) + 1] >= least[on]]
            place[on] -= 1 << k
        return place

    def minimum(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the values from ``first`` to ``last``."""
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for level in np.unique(k):
            on = k == level
            values = self.levels[level]
            out[on] = np.minimum(values[first[on]], values[last[on] - (1 << int(level)) + 1])
        return out


def _shared(one: bytes, other: bytes) -> int:
    """Turns at the beginning of both keys."""
    size = min(len(one), len(other)) // DIGEST
    same = (np.frombuffer(one, "<u8", 2 * size).reshape(-1, 2) == np.frombuffer(other, "<u8", 2 * size).reshape(-1, 2)).all(axis=1)
    return int(np.argmin(same)) if not same.all() else size


def _neighbours(digests: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Turns that each row but the first shares with the one before it."""
    length = np.diff(starts)
    size = np.minimum(length[1:], length[:-1])
    first = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(size)), size)
    turn = np.arange(first[-1]) - first[row]
    differ = np.flatnonzero((digests[starts[row] + turn] != digests[starts[row + 1] + turn]).any(axis=1))
    at = np.searchsorted(differ, first[:-1])
    differ = np.concatenate([differ, [first[-1]]])
    return np.minimum(differ[at], first[1:]) - first[:-1]


def _paths(key: bytes, depth: int) -> list[bytes]:
    """A digest of each of the first prefixes of a key, from the root to ``depth``."""
    running, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(running.copy().digest())
        running.update(key[d * DIGEST : (d + 1) * DIGEST])
    return out


def nodes_of(keys: list[bytes], chars: np.ndarray, ids: np.ndarray, before: bytes | None = None, after: bytes | None = None) -> dict[str, object]:
    """Columns of the nodes of one sorted slice; ``before`` and ``after`` are the keys around it.

    ``chars`` are the lengths of all turns, row after row.
    """
    m = len(keys)
    starts = np.concatenate([[0], np.cumsum([len(k) // DIGEST for k in keys])]).astype(np.int64)
    length = np.diff(starts)
    digests = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    lcp = np.concatenate([[-1 if before is None else _shared(before, keys[0])], _neighbours(digests, starts)]).astype(np.int64)
    beyond = -1 if after is None else _shared(keys[-1], after)
    follow = np.concatenate([lcp[1:], [beyond]])
    table = RangeMinimum(lcp)

    # Candidates: of each row the prefixes that the row before lacks; of the first row all.
    known = lcp.copy()
    known[0] = -1
    base = np.concatenate([[0], np.cumsum(length - known)])
    row = np.repeat(np.arange(m), length - known)
    depth = np.arange(base[-1]) - base[row] + known[row] + 1
    first, last = table.left(row, depth), table.right(row, depth)
    own = (row > 0) | (depth > lcp[0])  # begins in this slice
    is_open = ~own | ((last == m - 1) & (depth <= beyond))

    parent = np.arange(base[-1]) - 1
    up = np.flatnonzero((depth == known[row] + 1) & (depth > 0))
    above = table.left(row[up], depth[up] - 1)
    parent[up] = base[above] + depth[up] - 1 - known[above] - 1
    children = np.bincount(parent[own & (depth > 0)], minlength=base[-1])

    upto = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])  # characters before a turn

    def characters(rows: np.ndarray, turns: np.ndarray) -> np.ndarray:
        return upto[starts[rows] + turns] - upto[starts[rows]]

    repeated = np.concatenate([[0], np.cumsum(characters(np.arange(m), np.maximum(lcp, 0)))])
    begin = first + own  # the first member saves nothing
    saved = repeated[last + 1] - repeated[begin] - (last + 1 - begin) * characters(row, np.maximum(depth - 1, 0))
    leaves = np.concatenate([[0], np.cumsum(follow < length)])

    equal = np.concatenate([[False], (lcp[1:] == length[1:]) & (length[1:] == length[:-1])])
    group = np.flatnonzero(~equal)
    ends: list[str | None] = [None] * len(depth)
    names = list(map(str, ids.tolist()))
    for a, b in zip(group.tolist(), [*group[1:].tolist(), m], strict=True):
        ends[base[a + 1] - 1] = ",".join(names[a:b])

    left, right = _paths(keys[0], int(lcp[0])), _paths(keys[-1], beyond)
    path: list[bytes | None] = [None] * len(depth)
    for i in np.flatnonzero(is_open).tolist():
        path[i] = right[depth[i]] if own[i] else left[depth[i]]
    ids_min = RangeMinimum(ids).minimum(first, last)
    parents_open = (depth > 0) & is_open[parent]
    for i in np.flatnonzero(~is_open).tolist():
        ends[i] = hashlib.sha256(ends[i].encode()).hexdigest() if ends[i] is not None else EMPTY
    return {
        "open": is_open, "path": path, "depth": depth, "conv_id": ids_min, "n_convs": last - first + 1, "n_children": children,
        "n_leaves": leaves[last + 1] - leaves[first], "saved_tokens": saved, "ends": ends,
        "parent_conv_id": pa.array(ids_min[parent], pa.int64(), mask=(depth == 0) | parents_open),
        "parent_path": [path[p] if o else None for p, o in zip(parent.tolist(), parents_open.tolist(), strict=True)]}


def _slice(rows: pa.Table, border: pa.Table) -> pa.Table:
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("key", "ascending"), ("conv_id", "ascending")]))
    around = border.to_pylist()[0]
    found = nodes_of(
        rows["key"].to_pylist(), pc.list_flatten(rows["chars"]).to_numpy(), rows["conv_id"].to_numpy(), around["before"], around["after"])
    number = pa.array(np.full(len(found["depth"]), around["slice"]), pa.int64())
    return pa.table({"slice": number} | {k: pa.array(v, pa.binary()) if k.endswith("path") else pa.array(v) for k, v in found.items()})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of lists of ids, sorted by path and slice, to one hash per path; a list is read as it comes."""
    path, running, parts = None, None, 0
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["path"] != path:
                if parts:
                    done.append((path, running.hexdigest()))
                path, running, parts = row["path"], hashlib.sha256(), 0
            running.update((("," if parts else "") + row["ends"]).encode())
            parts += 1
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["path", "ends_sha256"])
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([running.hexdigest()])], names=["path", "ends_sha256"])


def trie(sequences: DataFrame, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """Nodes of the trie of all prefixes of ``sequences`` (rows (conv_id, turns) of unique ids, as of the function of that name).

    A node is a distinct sequence of the first ``depth`` turns. ``conv_id`` is its smallest member, ``n_convs`` counts the members; ``n_children``
    the distinct next turns; ``n_leaves`` nodes without children in its subtree (itself, if it has none); ``saved_tokens`` adds, over
    its subtree, the characters of each last turn times its members but one; ``ends_sha256`` hashes the ids of members without
    further turns. Ids are ascending, comma-joined; ``parent_conv_id`` is null for the root.
    """
    spark = sequences.sparkSession
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key")
    rows = written(sequences.select("conv_id", key, F.transform("turns", lambda t: t["chars"]).alias("chars")), "trie-sequences")
    turns = rows.agg(F.sum(F.size("chars") + 1).alias("n")).first()["n"] or 0
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // slice_turns))
    dealt = rows.repartitionByRange(slices, "key", "conv_id").withColumn("slice", F.spark_partition_id().cast("bigint"))
    dealt = written(dealt, "trie-slices")
    # A row per slice.
    order = Window.orderBy("slice")
    borders = dealt.groupBy("slice").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    borders = borders.select("slice", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    nodes = written(dealt.groupBy("slice").cogroup(borders.groupBy("slice")).applyInArrow(_slice, _NODES), "trie-nodes")

    parts = nodes.where("open")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    whole = parts.groupBy("path").agg(F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_path").alias("parent_path"), *sums)
    ends = parts.where("ends IS NOT NULL").select("path", "slice", "ends").repartition("path").sortWithinPartitions("path", "slice")
    ends = ends.mapInArrow(_hashed, "path binary, ends_sha256 string")
    whole = whole.join(ends, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    whole = written(whole, "trie-open")
    named = whole.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    whole = whole.join(named, "parent_path", "left")

    closed = nodes.where("NOT open").withColumn("ends_sha256", F.col("ends"))
    here = parts.select("slice", F.col("path").alias("parent_path")).join(named, "parent_path")
    below = closed.where("parent_path IS NOT NULL").drop("parent_conv_id").join(here, ["slice", "parent_path"])
    return closed.where("parent_path IS NULL").select(*RESULT).unionByName(below.select(*RESULT)).unionByName(whole.select(*RESULT))
