"""Boosted trees for several labels in the same passes over the rows.

The trees are those of Spark ML's GBTClassifier: at most 32 parts of each column, splits by the least weighted variance, a first tree on the labels
(-1 and 1), then trees on the gradients of the log loss with a step of 0.1. The result is a GBTClassificationModel. What differs is how rows are
passed over, and that the borders between the parts come from all rows, where the classifier takes them from some 10,000.

A row becomes the numbers of its parts once. Columns that have few parts together share one number, so a histogram of it has theirs in it, and rows
lie in blocks ordered by class, one block row for each fit. A pass brings all fits one level further: a task adds up its blocks, the sums of a node
are added by key, and the driver gets one histogram a node and picks its split. Only the smaller child of a split is counted; the other one is what
remains of its parent. The margins of a tree are added in the pass that starts the next one.

Bounded: a block, the histograms of a level (32 parts a column, a node and a fit), the points of a column (``POINTS``). Weights go by class.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

PARTS = 32
STEP = 0.1
#: Rows of a block, and rows of all fits together that are worth a task.
BLOCK, OF_TASK = 131_072, 500_000
#: The driver adds up the sums of so many tasks; those of more are added by key first.
TO_DRIVER = 16
#: Most values of a number that stands for several columns.
CELLS = 2048
#: A column with more values than this is known by so many points of equal weight when its borders are chosen.
POINTS = 4096
#: A gain below this share of the variance is rounding.
ROUNDING = 1e-12

_POINTS = "f int, x int, w int, points binary, weights binary"
_BORDERS = "f int, x int, w int, borders array<double>"
_BLOCKS = "head int, ends binary, codes binary, margins binary"


# --- borders of the parts ---------------------------------------------------------------


def merged_points(values: np.ndarray, weights: np.ndarray, most: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values that have weight, in order, with their weights; of more than ``most``, the greatest of each of so many stretches of equal weight."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    return _fewer(*_distinct(values, weights), most)


def _distinct(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered values, each once, with their weights added up, of one kind or (in columns) of several."""
    if not len(values):
        return values, weights
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.add.reduceat(weights, first, axis=0)


def _fewer(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    values, weights = values[weights > 0], weights[weights > 0]
    if len(values) > most:
        place = np.minimum(((np.cumsum(weights) - weights / 2) / weights.sum() * most).astype(np.int64), most - 1)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        values, weights = values[np.append(first[1:], len(values)) - 1], np.add.reduceat(weights, first)
    return values, weights


def borders_of(values: np.ndarray, weights: np.ndarray, parts: int = PARTS) -> list[float]:
    """Borders halfway between neighbours: between all values if they are few, else at equal steps of weight, as Spark ML places them."""
    if len(values) <= parts:
        return ((values[1:] + values[:-1]) / 2).tolist()
    stride = weights.sum() / parts
    out, now, goal = [], weights[0], stride
    for i in range(1, len(values)):
        before, now = now, now + weights[i]
        if abs(before - goal) < abs(now - goal):
            out.append(float((values[i - 1] + values[i]) / 2))
            goal += stride
    return out


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.empty((0, 0))


def borders(df: DataFrame, pairs: Sequence[tuple[int, int]]) -> dict[tuple[int, int, int], list[float]]:
    """``df`` has rows (f, x, w): a number of the kind of row, an array of values, an array of weights. For each kind and each (place in x, place in w)
    the borders of the weighted values; rows without weight don't count."""
    pairs = list(pairs)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        held: list[tuple] = []

        def settle() -> None:
            f, x, w = (np.concatenate(parts) for parts in zip(*held, strict=True))
            held.clear()
            for kind in np.unique(f):
                of = f == kind
                some, heavy = x[of], w[of]
                for i in sorted({i for i, _ in pairs}):
                    order = np.argsort(some[:, i], kind="stable")
                    values, weights = _distinct(some[order, i], heavy[order])
                    for j in (j for at, j in pairs if at == i):
                        old = known.get((int(kind), i, j), (np.empty(0), np.empty(0)))
                        own = weights[:, j] > 0
                        known[int(kind), i, j] = merged_points(np.concatenate((old[0], values[own])), np.concatenate((old[1], weights[own, j])))

        size = 0
        for batch in batches:
            n = batch.num_rows
            if n:
                held.append((batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), n), _matrix(batch.column(2), n)))
                size += n
            if size >= BLOCK:
                settle()
                size = 0
        if held:
            settle()
        if known:
            keys = list(zip(*known, strict=True))
            yield pa.record_batch(
                [*[pa.array(k, pa.int32()) for k in keys], *[pa.array([np.asarray(v[i], float).tobytes() for v in known.values()], pa.binary()) for i in (0, 1)]],
                names=["f", "x", "w", "points", "weights"])

    def chosen(table: pa.Table) -> pa.Table:
        values, weights = (np.concatenate([np.frombuffer(b) for b in table.column(c).to_pylist()]) for c in ("points", "weights"))
        found = borders_of(*merged_points(values, weights)) if len(values) else []
        keys = [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("f", "x", "w")]
        return pa.table([*keys, pa.array([found], pa.list_(pa.float64()))], names=["f", "x", "w", "borders"])

    found = df.select("f", "x", "w").mapInArrow(points, _POINTS).groupBy("f", "x", "w").applyInArrow(chosen, _BORDERS)
    return {(r["f"], r["x"], r["w"]): list(r["borders"]) for r in found.collect()}


# --- blocks -----------------------------------------------------------------------------


@dataclass
class Head:
    """A two-class fit: places in x of its columns with their borders, place in k of its class, the class that is positive, weights by class."""

    columns: list[int]
    borders: list[list[float]]
    group: int
    positive: int
    weights: list[float]

    def bundles(self) -> list[list[int]]:
        """Columns that share a number: those with most parts first, each into the first bundle that has room."""
        out: list[list[int]] = []
        room: list[int] = []
        for c in sorted(range(len(self.columns)), key=lambda c: -len(self.borders[c])):
            parts = len(self.borders[c]) + 1
            at = next((i for i, free in enumerate(room) if free >= parts), None)
            if at is None:
                out.append([])
                room.append(CELLS)
                at = len(out) - 1
            out[at].append(c)
            room[at] //= parts
        return out

    def layout(self) -> list[tuple[int, list[tuple[int, int, int]]]]:
        """Per bundle its number of cells and (column, parts, step between its parts)."""
        out = []
        for bundle in self.bundles():
            step, members = 1, []
            for c in bundle:
                members.append((c, len(self.borders[c]) + 1, step))
                step *= len(self.borders[c]) + 1
            out.append((step, members))
        return out


def _pack(heads: list[Head]):
    layouts = [h.layout() for h in heads]
    shared: dict[int, list[int]] = {}
    for i, head in enumerate(heads):
        twins = [first for first in shared if (heads[first].group, heads[first].columns, heads[first].borders) == (head.group, head.columns, head.borders)]
        shared.setdefault(twins[0] if twins else i, []).append(i)

    def blocks(x: np.ndarray, k: np.ndarray) -> Iterator[pa.RecordBatch]:
        x = np.ascontiguousarray(x.T)
        for first, same in shared.items():
            head = heads[first]
            of = k[:, head.group]
            places = [np.flatnonzero(of == c) for c in range(len(head.weights))]
            order = np.concatenate(places)
            codes = np.empty((len(layouts[first]), len(order)), np.uint16)
            for b, (_, members) in enumerate(layouts[first]):
                cell = np.zeros(x.shape[1], np.int64)
                for c, _, step in members:
                    cell += step * np.searchsorted(head.borders[c], x[head.columns[c]], side="left")
                codes[b] = cell[order]
            ends = np.cumsum([len(p) for p in places]).astype(np.int64).tobytes()
            packed, margins = codes.tobytes(), np.zeros(len(order)).tobytes()
            for i in same:
                yield pa.record_batch(
                    [pa.array([i], pa.int32()), *[pa.array([part], pa.binary()) for part in (ends, packed, margins)]], names=["head", "ends", "codes", "margins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            n = batch.num_rows
            if n:
                held.append((_matrix(batch.column(0), n), _matrix(batch.column(1), n)))
                size += n
            if size >= BLOCK:
                yield from blocks(*(np.concatenate(parts) for parts in zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield from blocks(*(np.concatenate(parts) for parts in zip(*held, strict=True)))

    return run


# --- trees ------------------------------------------------------------------------------


@dataclass
class Node:
    """``sums``: rows, weight, weighted sum and, where a pass has counted it, sum of squares of the targets."""

    sums: tuple[float, float, float, float]
    split: tuple[int, int] | None = None
    gain: float = 0.0
    left: int | None = None
    right: int | None = None

    @property
    def value(self) -> float:
        return self.sums[2] / self.sums[1] if self.sums[1] else 0.0

    @property
    def variance(self) -> float:
        return max(0.0, self.sums[3] / self.sums[1] - self.value**2) if self.sums[1] else 0.0


def _targets(head: Head, ends: np.ndarray, margins: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Targets of the next tree, and weights. The first tree has the labels."""
    sizes = np.diff(ends, prepend=0)
    sign = np.repeat(np.where(np.arange(len(sizes)) == head.positive, 1.0, -1.0), sizes)
    weight = np.repeat(np.asarray(head.weights, float), sizes)
    return (sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins))), weight


def _goes_left(layout: list, split: tuple[int, int]) -> tuple[int, np.ndarray]:
    """Bundle of the split's column, and for each cell whether it goes left."""
    for b, (cells, members) in enumerate(layout):
        for c, parts, step in members:
            if c == split[0]:
                return b, np.arange(cells) // step % parts <= split[1]
    raise ValueError(f"no column {split[0]}")


def _places(codes: np.ndarray, tree: list[Node], sides: dict, needed: set[int]) -> dict[int, np.ndarray]:
    """Rows of the needed nodes of a tree; None stands for all rows."""
    on_the_way = set(needed)
    for i in reversed(range(len(tree))):  # a parent comes before its children
        if tree[i].split is not None and (tree[i].left in on_the_way or tree[i].right in on_the_way):
            on_the_way.add(i)
    found: dict[int, np.ndarray | None] = {0: None}
    out = {}
    for i, node in enumerate(tree):
        if i not in found or i not in on_the_way:
            continue
        rows = found.pop(i)
        if i in needed:
            out[i] = rows
        if node.split is not None:
            b, left = sides[i]
            goes = left[codes[b] if rows is None else codes[b][rows]]
            for child, side in ((node.left, True), (node.right, False)):
                if child in on_the_way:
                    mask = goes if side else ~goes
                    found[child] = np.flatnonzero(mask) if rows is None else rows[mask]
    return out


def _read(block: tuple, layouts: list) -> tuple:
    head, *parts = block
    ends, codes, margins = (np.frombuffer(part, kind) for part, kind in zip(parts, (np.int64, np.uint16, np.float64), strict=True))
    return head, ends, codes.reshape(len(layouts[head]), -1), margins


def _sides(layouts: list, trees: list[list[Node]]) -> list[dict]:
    return [{i: _goes_left(layout, n.split) for i, n in enumerate(tree) if n.split is not None} for layout, tree in zip(layouts, trees, strict=True)]


def _counted(heads: list[Head], trees: list[list[Node]], wanted: list[list[int]], first: bool):
    """Sums of the wanted nodes: squares, then by column and part rows, weights and weighted targets."""
    layouts = [h.layout() for h in heads]

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        sides = _sides(layouts, trees)
        squares: dict[tuple, float] = {}
        cells: dict[tuple, list] = {}
        for block in blocks:
            h, ends, codes, margins = _read(block, layouts)
            if not wanted[h]:
                continue
            head = heads[h]
            target, weight = _targets(head, ends, margins, first)
            heavy = weight * target
            for node, rows in _places(codes, trees[h], sides[h], set(wanted[h])).items():
                if rows is not None and not len(rows):
                    continue
                key = (h, node)
                of = heavy if rows is None else heavy[rows]
                squares[key] = squares.get(key, 0.0) + float(np.dot(of, target if rows is None else target[rows]))
                cuts = [0, *(ends if rows is None else np.searchsorted(rows, ends))]
                sums = cells.setdefault(key, [np.zeros((2 + 1, size)) for size, _ in layouts[h]])
                for b, (size, _) in enumerate(layouts[h]):
                    code = (codes[b] if rows is None else codes[b][rows]).astype(np.int64)
                    sums[b][2] += np.bincount(code, of, size)
                    for c, w in enumerate(head.weights):
                        if cuts[c + 1] > cuts[c]:
                            n = np.bincount(code[cuts[c]:cuts[c + 1]], minlength=size)
                            sums[b][0] += n
                            sums[b][1] += w * n
        for (h, node), sums in cells.items():
            out = np.zeros((3, len(heads[h].columns), PARTS))
            for (_, members), of in zip(layouts[h], sums, strict=True):
                shape = [parts for _, parts, _ in reversed(members)]
                for at, (c, parts, _) in enumerate(members):
                    own = len(shape) - 1 - at
                    out[:, c, :parts] = of.reshape(3, *shape).sum(axis=tuple(1 + a for a in range(len(shape)) if a != own))
            yield (h, node), np.concatenate(([squares[h, node]], out.ravel()))

    return run


def _moved(heads: list[Head], trees: list[list[Node]], step: float):
    """Blocks with the values of the trees added to the margins."""
    layouts = [h.layout() for h in heads]

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        sides = _sides(layouts, trees)
        leaves = [{i for i, n in enumerate(tree) if n.split is None} for tree in trees]
        for block in blocks:
            h, _, codes, margins = _read(block, layouts)
            new = margins.copy()
            for leaf, rows in _places(codes, trees[h], sides[h], leaves[h]).items():
                new[slice(None) if rows is None else rows] += step * trees[h][leaf].value
            yield *block[:3], new.tobytes()

    return run


def best_split(sums: np.ndarray, head: Head) -> tuple[float, int, int, tuple, tuple] | None:
    """Gain, column, last part on the left, and (rows, weight, sum) of both sides; the first one of the greatest gain."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, 0, :].sum(axis=1)
    right = whole[:, None, None] - left
    last = np.array([len(b) for b in head.borders])
    fine = (np.arange(PARTS - 1)[None, :] < last[:, None]) & (left[0] > 0.5) & (right[0] > 0.5)
    if not fine.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = (left[2] ** 2 / left[1] + right[2] ** 2 / right[1] - whole[2] ** 2 / whole[1]) / whole[1]
    gains = np.where(fine, gains, -np.inf)
    column, part = np.unravel_index(int(np.argmax(gains)), gains.shape)
    sides = [tuple(float(s[q, column, part]) for q in range(3)) for s in (left, right)]
    return float(gains[column, part]), int(column), int(part), *sides


def _pruned(tree: list[Node]) -> list[Node]:
    """Siblings of one value become a leaf, from below."""
    for node in reversed(tree):
        if node.split is not None and all(tree[c].split is None for c in (node.left, node.right)) and tree[node.left].value == tree[node.right].value:
            node.split, node.left, node.right, node.gain = None, None, None, 0.0
    return tree


def boost(rows: DataFrame, heads: Sequence[Head], count: int, iterations: int = 20, depth: int = 5) -> list[list[list[Node]]]:
    """Trees of every head. ``rows`` has x, an array of numbers, and k, an array of classes by their place, -1 for rows outside of a fit; they are
    ``count`` in all, and few rows stay in few tasks."""
    heads = list(heads)
    rows = rows.select("x", "k").coalesce(max(1, -(-count * len(heads) // OF_TASK)))
    now = rows.mapInArrow(_pack(heads), _BLOCKS).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[list[list[Node]]] = [[] for _ in heads]
    for m in range(iterations):
        old = now
        if m:
            now = now.mapPartitions(_moved(heads, [trees[-1] for trees in grown], 1.0 if m == 1 else STEP)).persist(StorageLevel.MEMORY_AND_DISK)
        for tree, trees in zip(_grow(now, heads, depth, first=m == 0), grown, strict=True):
            trees.append(tree)
        if m:
            old.unpersist()
    now.unpersist()
    return [[_pruned(tree) for tree in trees] for trees in grown]


def _grow(blocks: RDD, heads: list[Head], depth: int, first: bool) -> list[list[Node]]:
    """One tree of each head, level by level."""
    trees: list[list[Node]] = [[Node((0.0, 0.0, 0.0, 0.0))] for _ in heads]
    wanted = [[0] for _ in heads]
    open_nodes = [[(0, None, None)] for _ in heads]  # node, its parent's sums and its sibling where these give its own
    for level in range(depth):
        if not any(wanted):
            break
        counted = blocks.mapPartitions(_counted(heads, trees, wanted, first))
        if blocks.getNumPartitions() > TO_DRIVER:
            counted = counted.reduceByKey(operator.add, min(TO_DRIVER, sum(map(len, wanted))))
        sums: dict[tuple[int, int], np.ndarray] = {}
        for key, part in counted.collect():
            sums[key] = sums[key] + part if key in sums else part
        for h, head in enumerate(heads):
            tree, nodes, wanted[h], open_nodes[h] = trees[h], open_nodes[h], [], []
            for node, parent, sibling in nodes:
                if parent is not None:
                    sums[h, node] = parent - sums[h, sibling]
                if (h, node) not in sums:
                    continue
                squares, cells = sums[h, node][0], sums[h, node][1:].reshape(3, len(head.columns), PARTS)
                tree[node].sums = (*(float(x) for x in cells[:, 0, :].sum(axis=1)), float(squares))
                found = best_split(cells, head) if tree[node].variance > ROUNDING else None
                if found is None or found[0] <= ROUNDING * tree[node].variance:
                    continue
                gain, column, part, *sides = found
                tree[node].split, tree[node].gain, tree[node].left, tree[node].right = (column, part), gain, len(tree), len(tree) + 1
                tree += [Node((*side, side[2] ** 2 / side[1])) for side in sides]  # squares as without variance, until a pass counts them
                small, large = sorted((tree[node].left, tree[node].right), key=lambda c: tree[c].sums[0])
                if level + 1 < depth:
                    wanted[h].append(small)
                    open_nodes[h] += [(small, None, None), (large, sums[h, node], small)]
    return trees
