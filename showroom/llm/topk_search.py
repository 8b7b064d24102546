"""Exact top-k search by inner product over vectors grouped by length.

Vectors fall into buckets by their length (powers of ``RATIO``), and a bucket of many rows into chunks of about ``CHUNK_ROWS``
by a hash of the id. Queries go in blocks of about ``BLOCK_ROWS``. The chunk of the longest vectors is searched first; the
k-th score found there is a floor for each query. A bucket whose longest vector cannot reach the floor is left out by
the join, and its vectors go only to blocks of queries that need it. In the others a query needs a cosine of ``floor / (|q| * longest)``:

* below ``COSINE`` the bucket is pruned by length, vector by vector;
* from there on by coordinates: on its strongest ``FOCUS`` coordinates the query bounds what a vector of that cosine can have.

What remains is verified with whole inner products. Each chunk gives at most k rows per query, from which an aggregate window picks.

Numbers are exact: components are whole numbers, products are formed in floating point only while all of them are below
2 ** 53, and bounds are widened by more than their rounding errors. A score beyond 64 bits counts as the nearest number of 64 bits (see ``whole``).

Defined cases: vectors that are null or hold null or non-finite components take no part; a vector is compared with those of
its own dimension only; rows with the query's own id are not its candidates; repeated rows are candidates each, and a query
that repeats answers once; rows without id take no part; ties go to the smaller id; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.shared import exact, written
from showroom.llm.whole import matrix, products, whole_numbers

K = 10
SCALE = 1024
RATIO = 1.1
CHUNK_ROWS = 4_096
BLOCK_ROWS = 1_024
COSINE = 0.3
FOCUS = 6
#: Bounds are widened by this share of 1.
MARGIN = 1e-9
_FOUND = "q bigint, query_id bigint, vec_id bigint, score bigint"


def lengths(rows: np.ndarray) -> np.ndarray:
    """Of the rows of a matrix, also where squares are beyond a double."""
    largest = np.abs(rows).max(axis=1, initial=0.0)
    parts = rows / np.where(largest > 0, largest, 1)[:, None]
    return np.minimum(largest * np.sqrt((parts**2).sum(axis=1)), np.finfo(np.float64).max)


def search(queries: np.ndarray, vectors: np.ndarray, floors: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and scores of its k best rows that reach its floor; ties to the smaller id.

    ``own`` are the ids of the queries, ``ids`` those of the rows.
    """
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    length = lengths(vectors)
    longest = length.max(initial=0.0)
    unit = vectors / np.where(length > 0, length, 1)[:, None]
    columns = np.ascontiguousarray(unit.T)
    out = []
    for q, size, floor, me in zip(queries, lengths(queries).tolist(), floors, own, strict=True):
        here = ids != me
        if np.isfinite(floor):
            # The least cosine with which a vector of the largest length reaches the floor.
            need = (floor / (size * longest) if size * longest > 0 else (0.0 if floor <= 0 else 2.0)) - MARGIN
            if need > 1:
                out.append((order[:0], np.zeros(0, np.int64)))
                continue
            if floor > 0:
                here &= length * size * (1 + MARGIN) >= floor
            if need >= COSINE:
                direction, rest = q / size, np.sqrt(max(0.0, 1 - need**2))
                for f in np.argsort(-np.abs(direction))[:FOCUS]:
                    x = direction[f]
                    reach = rest * np.sqrt(max(0.0, 1 - x**2)) + MARGIN
                    # A cosine of at least ``need`` leaves the coordinate within an angle of the query's own.
                    low = x * need - reach if -x < need else -1.0
                    high = x * need + reach if x < need else 1.0
                    here &= (columns[f] >= low) & (columns[f] <= high)
        place = np.flatnonzero(here)
        score = products(q, vectors[place])
        if np.isfinite(floor):
            good = score >= floor
            place, score = place[good], score[good]
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            above = score > least
            tied = np.flatnonzero(score == least)[: k - int(above.sum())]  # rows are in the order of their ids
            chosen = np.concatenate([np.flatnonzero(above), tied])
            place, score = place[chosen], score[chosen]
        out.append((order[place], score))
    return out


def _run(k: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Queries and candidates of one block and chunk."""
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        ids, own = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
        floors = left["floor"].to_numpy().astype(np.float64)
        found = search(matrix(left["v"], left.num_rows), matrix(right["v"], right.num_rows), floors, own, ids, k)
        n = [len(p) for p, _ in found]
        place = np.concatenate([p for p, _ in found])
        return pa.table({
            "q": np.repeat(left["q"].to_numpy(), n), "query_id": np.repeat(own, n), "vec_id": ids[place].astype(np.int64),
            "score": np.concatenate([s for _, s in found]).astype(np.int64)})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Both sides have (dim, bucket, chunk, block)."""
    keys = ["dim", "bucket", "chunk", "block"]
    return queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInArrow(_run(k), _FOUND)


def top_k(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE,
    chunk_rows: int = CHUNK_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best rows of every row for which ``is_query`` holds."""
    rows = vectors.select(exact(vec_id).cast("bigint").alias("vec_id"), whole_numbers(exact(vector), scale).alias("v"), is_query.alias("is_query"))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    largest = F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    norm = F.when(F.col("largest") > 0, F.least(F.col("largest") * F.sqrt(squares), F.lit(sys.float_info.max))).otherwise(F.lit(0.0))
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.log(F.lit(RATIO)))).otherwise(F.lit(-(1 << 20)))
    rows = rows.withColumn("largest", largest).withColumn("norm", norm).withColumn("bucket", bucket.cast("bigint")).drop("largest")
    rows = written(rows, "search-vectors")
    # A row per bucket of lengths: the powers of ``RATIO`` between the shortest and the longest.
    buckets = rows.groupBy("dim", "bucket").agg(F.max("norm").alias("longest"), F.ceil(F.count("*") / chunk_rows).alias("chunks"))
    buckets = written(buckets, "search-buckets")
    chunk = F.pmod(F.xxhash64("vec_id"), F.col("chunks"))
    placed = rows.join(buckets, ["dim", "bucket"]).withColumn("chunk", chunk).select("dim", "bucket", "chunk", "vec_id", "v")

    queries = rows.where("is_query").select("dim", F.xxhash64("vec_id", "v").alias("q"), F.col("vec_id").alias("query_id"), "v", "norm").distinct()
    blocks = written(queries.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).alias("blocks")), "search-blocks")
    queries = written(queries.join(blocks, "dim").withColumn("block", F.pmod(F.col("q"), F.col("blocks"))).drop("blocks"), "search-queries")

    first = buckets.groupBy("dim").agg(F.max("bucket").alias("bucket"))
    seeds = queries.join(first, "dim").withColumn("chunk", F.lit(0).cast("bigint")).withColumn("floor", F.lit(float("-inf")))
    begin = placed.where("chunk = 0").join(first, ["dim", "bucket"], "left_semi").join(blocks, "dim")
    begin = begin.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("blocks")
    seeded = written(_searched(seeds, begin, k), "search-seeds")
    floors = seeded.groupBy("q", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = floors.select("q", "query_id", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("floor"))
    ready = queries.join(floors, ["q", "query_id"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))

    # One row per chunk; those of the first search are done.
    chunks = buckets.join(first.select("dim", F.col("bucket").alias("top")), "dim").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))).where("NOT (bucket = top AND chunk = 0)")
    sent = ready.join(chunks.select("dim", "bucket", "chunk", "longest"), "dim").where(
        F.col("norm") * F.col("longest") * (1 + MARGIN) >= F.col("floor"))
    sent = sent.select("dim", "bucket", "chunk", "block", "q", "query_id", "v", "floor")
    needed = written(sent.select("dim", "bucket", "chunk", "block").distinct(), "search-needed")
    rest = _searched(sent, placed.join(needed, ["dim", "bucket", "chunk"]), k)
    return _best(seeded.union(rest), k).select("query_id", "rank", "vec_id", "score")
