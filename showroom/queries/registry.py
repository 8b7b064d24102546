"""Registry of named queries: a Spark function and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounded doubles and whole numbers as bigint, so that engines can be compared."""

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(c, digits).alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(c.cast("timestamp")).alias(f.name)
        return c

    return df.select(*[cell(f) for f in df.schema])


def lead_id() -> Column:
    return F.col(vocab.LEAD_ID).alias("id")
