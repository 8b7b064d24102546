"""Exact order statistics that never put a whole group into one task.

The rows are range-partitioned on the full sort key, which includes a unique column, so a hot
value is cut like any other stretch of rows. Slice totals give every slice its starting offset;
inside a slice a window adds the rest. Rows are written to the shared folder before they are
ranged, so that sampling does not repeat the plan behind them, and once more after it, because
slice numbers must not change between the passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom.functions.cells import named
from showroom.session import cut_lineage

SLICE = "__slice"
BUCKETS = 1024


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: dict[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Append, per row, the sums over all earlier rows of its ``by`` group (row excluded).

    ``order`` must be unique within a group. A group may span many slices.
    """
    by = list(by)
    inputs = {f"__in_{name}": value for name, value in sums.items()}
    rows = cut_lineage(df.withColumns(inputs))
    return _sliced_totals(rows, order, list(sums), by).drop(*inputs)


def _sliced_totals(rows: DataFrame, order: Sequence[Column], names: list[str], by: list[str]) -> DataFrame:
    ranged = rows.repartitionByRange(*[named(c).asc() for c in by], *order)
    ranged = cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))

    keys = [*by, SLICE]
    slices = ranged.groupBy(*keys).agg(*[F.sum(f"__in_{n}").alias(f"__slice_{n}") for n in names])
    # One row per (group, slice): at most the number of slices plus the number of groups.
    earlier = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"__slice_{n}").over(earlier), F.lit(0)).alias(f"__from_{n}") for n in names],
    )
    same = [named(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = {
        n: F.coalesce(F.sum(f"__in_{n}").over(before), F.lit(0)) + F.col(f"__from_{n}") for n in names
    }
    helper = [f"__k{i}" for i in range(len(keys))] + [f"__from_{n}" for n in names]
    return ranged.join(offsets, same).withColumns(inside).drop(*helper, SLICE)


def global_rank(
    df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Exact 1-based position of every row in its group."""
    ranked = running_totals(df, order, {name: F.lit(1).cast("bigint")}, by)
    return ranked.withColumn(name, F.col(name) + 1)


def unpivot_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value) for the non-null numbers of the listed columns."""
    cells = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column"), named(c).cast("double").alias("value")) for c in columns
        ])
    )
    cell = df.select(cells.alias("cell"))
    return cell.select("cell.column", "cell.value").where("value IS NOT NULL")


def unpivot_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value) for the listed columns as text, nulls kept."""
    cells = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value")) for c in columns
        ])
    )
    return df.select(cells.alias("cell")).select("cell.column", "cell.value")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Rows (column, p, quantile): exact quantiles with linear interpolation.

    Values are counted by ``BUCKETS`` buckets of their signed logarithm, which keep the order of the values. Running sums
    over the buckets of a column find those that hold a wanted position, and only the values in these are ordered. Equal
    values are merged first, so a hot value is one row. The result has one row per column and probability.
    """
    columns, ps = list(columns), [float(p) for p in probabilities]
    value = {c: named(c).cast("double") for c in columns}
    scale = {c: F.when(_finite(value[c]), F.signum(value[c]) * F.log1p(F.abs(value[c]))) for c in columns}
    row = df.agg(*[
        x for i, c in enumerate(columns)
        for x in (F.count(value[c]).alias(f"n{i}"), F.min(scale[c]).alias(f"a{i}"), F.max(scale[c]).alias(f"b{i}"))]).first()
    totals = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    used = [c for c in columns if totals[c]]
    bucket = {c: _bucket(value[c], scale[c], row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}
    spark = df.sparkSession
    if not used:
        return spark.createDataFrame([], "column string, p double, quantile double")

    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), bucket[c].alias("bucket")) for c in used]))
    counts = df.select(cells.alias("x")).select("x.*").where("bucket IS NOT NULL").groupBy("column", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    wanted = spark.createDataFrame([(c, p, p * (totals[c] - 1)) for c in used for p in ps], "of string, p double, position double")
    covers = lambda f: (f("position") >= F.col("before")) & (f("position") < F.col("before") + F.col("n"))
    holding = counts.join(F.broadcast(wanted), (F.col("column") == F.col("of")) & (covers(F.floor) | covers(F.ceil))).collect()
    marks = [(f"{r['column']}/{r['bucket']}", r["column"], r["p"], r["position"], r["before"]) for r in holding]

    held = {c: sorted({r["bucket"] for r in holding if r["column"] == c}) for c in used}
    inside = F.array(*[
        F.when(bucket[c].isin(held[c]), F.struct(F.concat(F.lit(f"{c}/"), bucket[c].cast("string")).alias("g"), value[c].alias("value")))
        for c in used])
    merged = df.select(F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("x")).select("x.g", "x.value")
    found = _at_positions(merged.groupBy("g", "value").agg(F.count("*").alias("n")), marks)
    return spark.createDataFrame([(c, p, q) for (c, p), q in found.items()], "column string, p double, quantile double")


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def _bucket(value: Column, scale: Column, low: float | None, high: float | None) -> Column:
    """Number of the bucket, in the order of the values: -inf first, inf and NaN last; NULL stays."""
    if low is None or low == high:
        place = F.lit(0)
    else:
        place = F.least(F.floor((scale - low) / (high - low) * BUCKETS), F.lit(BUCKETS - 1))
    return F.when(_finite(value), place).when(value == float("-inf"), -1).when(value.isNotNull(), BUCKETS).cast("int")


def _at_positions(counts: DataFrame, marks: list[tuple]) -> dict:
    """(column, p) -> interpolated value, from merged values (g, value, n). A mark is
    (g, column, p, position, values below the group)."""
    placed = running_totals(counts, [F.col("value").asc()], {"before": F.col("n")}, ["g"])
    schema = "mg string, column string, p double, position double, skipped bigint"
    wanted = counts.sparkSession.createDataFrame(marks, schema)
    at = lambda f: f(F.col("position")) - F.col("skipped")
    covers = lambda f: (at(f) >= F.col("before")) & (at(f) < F.col("before") + F.col("n"))
    hit = placed.join(F.broadcast(wanted), (F.col("g") == F.col("mg")) & (covers(F.floor) | covers(F.ceil)))
    rows = hit.groupBy("column", "p", "position").agg(
        F.max(F.when(covers(F.floor), F.col("value"))).alias("v0"), F.max(F.when(covers(F.ceil), F.col("value"))).alias("v1")
    ).where("v0 IS NOT NULL AND v1 IS NOT NULL").collect()
    part = lambda r: r["position"] - math.floor(r["position"])
    return {(r["column"], r["p"]): r["v0"] + (r["v1"] - r["v0"]) * part(r) for r in rows}


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value, n) with nulls counted as a value."""
    return unpivot_texts(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
