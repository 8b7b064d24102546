"""Small helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.session import ensure_shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the storage that driver and executors share."""
    return f"{ensure_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, its size known to the planner."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, lengthened by ``_`` until it clashes with no column (Spark compares without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def exact(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``: the same ones whatever the partitioning.

    The hash has 63 bits, so the number stays about ``rows`` at every size of ``df``.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 1) < (rows << 63) // total)


def join_heavy(left: DataFrame, right: DataFrame, key: str, rows: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` (unique keys) where some keys have very many rows.

    ``right`` counts the rows of its key on the left in ``rows``. Keys with a thousandth of all of them are a thousand at most; their rows are
    broadcast, so they stay where they are. The others meet by key. With ``how`` "left" rows without partner stay, null keys included.
    """
    right = written(right, "join-keys")
    total = right.agg(F.sum(rows).alias("n")).first()["n"] or 0
    heavy = F.broadcast(right.where(F.col(rows) * 1000 >= total))
    found = left.join(heavy, key)
    others = left.join(heavy.select(key), key, "left_anti")
    if how == "inner":
        return found.unionByName(others.join(right, key))
    met = others.where(F.col(key).isNotNull()).join(right, key, "left")
    return found.unionByName(met).unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def with_fields(batch: pa.RecordBatch, fields: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    names = [*batch.schema.names, *[n for n, _ in fields]]
    return pa.RecordBatch.from_arrays([*batch.columns, *[a for _, a in fields]], names=names)
