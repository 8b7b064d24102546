"""Hard negatives by a vertical scan of columnar chunks (BOND).

Rows are dealt by a hash of their id to chunks of about ``CHUNK_ROWS``, each stored by columns with the least and the most of every
dimension. Anchors go in blocks of about ``BLOCK_ROWS`` to every chunk; a pair of block and chunk is one row, so a task holds one of
them at a time, and no label, however common, is a key.

An anchor asks for windows of scores, the first ``k`` rows of each. It reads a chunk's dimensions in the descending order of its own magnitudes. After
every few of them, the sum so far with the least and the most that the other dimensions can add bounds each row's score; rows that no
window can use any more leave the candidates. A window's floor rises to the k-th best lower bound of the rows that surely lie in it.
Rows that remain to the end have exact scores.

The scan runs twice: with one open window over rows of the anchor's label, which gives its positives, and then with a window below each
positive over rows of other labels. Each run looks at one chunk first, whose results raise the floors for all others.

Defined cases: rows without id or label, and vectors that are null or hold null or non-finite components, take no part; vectors are
compared with those of their own dimension only; rows with the anchor's own id are neither its positives nor its negatives; an anchor
that repeats answers once; other repeated rows are rows each (a positive may be listed twice); ties go to the smaller id; scores are exact, see ``whole`` beyond 64 bits;
labels that are no integers are compared by a 64-bit hash; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.shared import exact, written
from showroom.llm.whole import LEAST, MOST, matrix, products, small, whole_numbers

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this share of the positive's, in percent.
PERCENT = 80
CHUNK_ROWS = 4_096
BLOCK_ROWS = 128
#: Dimensions that are read between two looks at the bounds.
STEP = 8

_CHUNK = "dim int, chunk bigint, n bigint, ids binary, labels binary, kind string, columns binary"
_FOUND = "q bigint, anchor_id bigint, place int, vec_id bigint, score bigint"
_NAMES = ["q", "anchor_id", "place", "vec_id", "score"]


def scan(
    q: np.ndarray, columns: np.ndarray, candidates: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, bounds: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the candidates that may be among the first ``k`` of a window, their exact scores, and the windows' floors.

    ``columns`` has a row per dimension; ``bounds`` are their least and most values.
    """
    least, most = bounds if bounds is not None else (columns.min(axis=1, initial=np.inf), columns.max(axis=1, initial=-np.inf))
    largest = float(max(np.abs(least).max(initial=0), np.abs(most).max(initial=0)))
    if not len(candidates) or not len(lows):
        return candidates[:0], np.zeros(0, np.int64), lows
    if not small(q, largest):
        return candidates, products(q, columns[:, candidates].T), lows
    # As doubles: scores are below 2^53 here, and the ends of an open window beyond them.
    floors, tops = lows.astype(np.float64), highs.astype(np.float64)
    order = np.argsort(-np.abs(q), kind="stable")
    one, other = (q * least)[order], (q * most)[order]
    above = np.concatenate([np.cumsum(np.maximum(one, other)[::-1])[::-1], [0.0]])
    below = np.concatenate([np.cumsum(np.minimum(one, other)[::-1])[::-1], [0.0]])
    score, whole = np.zeros(len(candidates)), len(candidates) == columns.shape[1]
    for done in range(0, len(q) + STEP, STEP):
        rest = min(done, len(q))
        low, high = score + below[rest], score + above[rest]
        alive = np.zeros(len(candidates), dtype=bool)
        for w in range(len(floors)):
            sure = (low >= floors[w]) & (high <= tops[w])
            if np.count_nonzero(sure) >= k:
                inside = low[sure]
                floors[w] = max(floors[w], np.partition(inside, len(inside) - k)[len(inside) - k])
            alive |= (high >= floors[w]) & (low <= tops[w])
        if not alive.all():
            candidates, score, whole = candidates[alive], score[alive], False
        if rest == len(q) or not len(candidates):
            break
        here = order[done : done + STEP]
        score = score + q[here] @ (columns[here] if whole else columns[here[:, None], candidates])
    return candidates, score.astype(np.int64), np.maximum(lows, np.where(np.isfinite(floors), floors, 0).clip(-(2.0**53), 2.0**53).astype(np.int64))


def first_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))][:k]
    return np.lexsort((ids, -scores))


def _pack(rows: pa.Table) -> pa.Table:
    values = matrix(rows["v"], rows.num_rows)
    kind = "<i4" if np.abs(values).max(initial=0) < 2**31 else "<f8"
    return pa.table({
        "dim": rows["dim"][:1], "chunk": rows["chunk"][:1], "n": pa.array([rows.num_rows]), "ids": pa.array([rows["vec_id"].to_numpy().tobytes()], pa.binary()),
        "labels": pa.array([rows["label"].to_numpy().tobytes()], pa.binary()), "kind": pa.array([kind]),
        "columns": pa.array([np.ascontiguousarray(values.T).astype(kind).tobytes()], pa.binary())})


def _search(same: bool, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a chunk and a block of anchors."""
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("dim", "ids", "labels", "kind", "columns")}
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                columns = np.frombuffer(row["columns"], row["kind"]).reshape(row["dim"], len(ids)).astype(np.float64)
                bounds = columns.min(axis=1, initial=np.inf), columns.max(axis=1, initial=-np.inf)
                out: list[list[np.ndarray]] = [[] for _ in _NAMES]
                for anchor in batch["anchors"][i].as_py():
                    fit = np.flatnonzero(((labels == anchor["label"]) == same) & (ids != anchor["anchor_id"]))
                    windows = anchor["windows"]
                    lows, highs = (np.array([w[c] for w in windows], np.int64) for c in ("low", "high"))
                    place, score, lows = scan(np.array(anchor["v"], np.float64), columns, fit, lows, highs, k, bounds)
                    for w, low, high in zip(windows, lows, highs, strict=True):
                        inside = np.flatnonzero((score >= low) & (score <= high))
                        best = inside[first_of(ids[place[inside]], score[inside], k)]
                        for column, values in zip(out, (anchor["q"], anchor["anchor_id"], w["place"], ids[place[best]], score[best]), strict=True):
                            column.append(np.broadcast_to(np.asarray(values, np.int64), len(best)))
                found = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "place" else pa.int64()) for c, n in zip(found, _NAMES, strict=True)], names=_NAMES)

    return run


def _pairs(anchors: DataFrame, chunks: DataFrame, sizes: DataFrame, first: bool, same: bool, k: int) -> DataFrame:
    """What the anchors find in the first chunk of their dimension, or in all others."""
    entry = F.struct("q", "anchor_id", "label", "v", "windows")
    blocks = anchors.join(sizes, "dim").groupBy("dim", F.pmod("q", "blocks").alias("block")).agg(
        F.max("chunks").alias("chunks"), F.collect_list(entry).alias("anchors"))
    numbers = F.array(F.lit(0).cast("bigint")) if first else F.expr("filter(sequence(0L, chunks - 1), c -> c > 0)")
    sent = blocks.select("dim", "anchors", F.explode(numbers).alias("chunk")).repartition("dim", "chunk")
    return sent.join(chunks, ["dim", "chunk"]).select("dim", "ids", "labels", "kind", "columns", "anchors").mapInArrow(_search(same, k), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _first_in_windows(anchors: DataFrame, chunks: DataFrame, sizes: DataFrame, same: bool, k: int) -> DataFrame:
    """Rows (q, anchor_id, place, vec_id, score, rank): the first ``k`` of every window of ``anchors``."""
    seeds = written(_pairs(anchors, chunks, sizes, True, same, k), "negatives-seeds")
    known = seeds.groupBy("q", "place").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    known = known.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("place", "floor"))).alias("floors"))
    raised = anchors.join(known, "q", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
        w["place"].alias("place"), F.greatest(w["low"], F.coalesce(F.col("floors")[w["place"]], w["low"])).alias("low"), w["high"].alias("high"))))
    return _ranked(seeds.union(_pairs(raised.drop("floors"), chunks, sizes, False, same, k)), k)


def mine(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT, chunk_rows: int = CHUNK_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor its first ``positives`` rows of the same label, and for each of them the first ``negatives`` rows of other labels
    with ``percent * positive_score <= 100 * negative_score <= 100 * positive_score``.
    """
    of = exact(label)
    whole_label = vectors.select(of).schema[0].dataType.typeName() in ("byte", "short", "integer", "long")
    rows = vectors.select(
        exact(vec_id).cast("bigint").alias("vec_id"), F.when(of.isNotNull(), of.cast("bigint") if whole_label else F.xxhash64(of)).alias("label"),
        whole_numbers(exact(vector), scale).alias("v"), is_anchor.alias("is_anchor"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    rows = written(rows.withColumn("q", F.when(F.col("is_anchor"), F.xxhash64("vec_id", "label", "v"))), "negatives-rows")
    # A row per dimension.
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / chunk_rows).alias("chunks"), F.greatest(F.ceil(F.count("q") / block_rows), F.lit(1)).alias("blocks"))
    sizes = written(sizes, "negatives-sizes")
    placed = rows.join(sizes, "dim").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks")).select("dim", "chunk", "vec_id", "label", "v")
    chunks = written(placed.groupBy("dim", "chunk").applyInArrow(_pack, _CHUNK), "negatives-chunks")

    whole = F.array(F.struct(F.lit(0).alias("place"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")))
    anchors = rows.where("is_anchor").select("q", F.col("vec_id").alias("anchor_id"), "label", "dim", "v").distinct()
    anchors = written(anchors, "negatives-anchors")
    near = _first_in_windows(anchors.withColumn("windows", whole), chunks, sizes, True, positives)
    near = written(near.select("q", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # ceil(percent * p / 100) without overflow; below zero no score is in both bounds.
    low = F.expr(f"positive_score - positive_score div 100 * {100 - percent} - (positive_score % 100) * {100 - percent} div 100")
    windows = near.where("positive_score >= 0").groupBy("q").agg(
        F.collect_list(F.struct("place", low.alias("low"), F.col("positive_score").alias("high"))).alias("windows"))
    far = _first_in_windows(anchors.join(windows, "q"), chunks, sizes, False, negatives)
    return far.join(near, ["q", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
