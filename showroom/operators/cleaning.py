"""Cleaning chain with its log."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab as v
from showroom.functions.cells import named
from showroom.operators.contract import column_facts
from showroom.operators.ordering import exact_quantiles
from showroom.operators.profiling import distinct_counts, duplicate_summary, text_columns, wide_aggregate
from showroom.session import hand_over

MIN_VALUES_FOR_SKEW = 10
CHECKED_NUMBERS = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)


@dataclass
class CleaningLog:
    rows_before: int = 0
    columns_before: int = 0
    rows_after: int = 0
    columns_after: int = 0
    dropped_rows: int = 0
    dropped_columns: list[dict] = field(default_factory=list)
    outliers: dict[str, int] = field(default_factory=dict)
    skewed_columns: list[dict] = field(default_factory=list)
    high_cardinality_columns: list[dict] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)


def checked_numbers(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, CHECKED_NUMBERS)]


def high_missing_columns(facts: dict[str, dict], limit: float = 0.5) -> list[str]:
    return [c for c, f in facts.items() if c not in v.CLEANING_PROTECTED and f["null_share"] > limit]


def constant_columns(facts: dict[str, dict]) -> list[str]:
    """Null counts as a value here: {x, null} is not constant."""
    constant = lambda f: f["nulls"] == f["rows"] or (f["nulls"] == 0 and f["single_value"])
    return [c for c, f in facts.items() if c not in v.CLEANING_PROTECTED and constant(f)]


def drop_high_missing(df: DataFrame, limit: float = 0.5) -> DataFrame:
    return df.drop(*high_missing_columns(column_facts(df, df.columns), limit))


def drop_constant(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(column_facts(df, df.columns)))


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def outliers_iqr(df: DataFrame, columns: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """Rows (column, lower, upper, outliers) for columns with at least one value outside k·IQR.

    The quartiles are two numbers per column, so the count is one wide aggregation.
    """
    columns = columns or checked_numbers(df)
    found = {(r["column"], r["p"]): r["quantile"] for r in exact_quantiles(df, columns, [0.25, 0.75]).collect()}
    fences = {}
    for c in columns:
        if (c, 0.25) in found:
            q1, q3 = found[c, 0.25], found[c, 0.75]
            fences[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))

    def stats(c: str) -> dict[str, Column]:
        lower, upper = fences[c]
        return {
            "lower": F.lit(lower), "upper": F.lit(upper), "outliers": F.count_if((named(c) < lower) | (named(c) > upper))}

    return _listed(df, stats, list(fences), "lower double, upper double")


def outliers_zscore(df: DataFrame, columns: list[str] | None = None, threshold: float = 1.5) -> DataFrame:
    """Rows (column, mean, std, outliers); a column without spread is left out."""
    columns = columns or checked_numbers(df)
    row = df.agg(*[F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(named(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    spread = {c: (row[f"m{i}"], row[f"d{i}"]) for i, c in enumerate(columns) if row[f"d{i}"]}

    def stats(c: str) -> dict[str, Column]:
        mean, std = spread[c]
        return {"mean": F.lit(mean), "std": F.lit(std), "outliers": F.count_if(F.abs((named(c) - mean) / std) > threshold)}

    return _listed(df, stats, list(spread), "mean double, std double")


def _listed(df: DataFrame, stats, columns: list[str], extra: str) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], f"column string, {extra}, outliers bigint")
    return wide_aggregate(df, stats, columns).where("outliers > 0")


def skewed_columns(df: DataFrame, columns: list[str] | None = None, limit: float = 1.0) -> DataFrame:
    columns = columns or checked_numbers(df)
    stats = wide_aggregate(df, lambda c: {"n": F.count(named(c)), "skew": F.skewness(named(c))}, columns)
    return stats.where((F.col("n") >= MIN_VALUES_FOR_SKEW) & (F.abs("skew") > limit)).select(
        "column", F.bround("skew", 2).alias("skewness"),
        F.when(F.col("skew") > 0, "log").otherwise("power").alias("suggestion"),
    )


def high_cardinality(df: DataFrame, columns: list[str] | None = None, limit: int = 100) -> DataFrame:
    counts = distinct_counts(df, columns or text_columns(df))
    return counts.where(F.col("distinct_values") > limit).withColumn(
        "suggestion", F.lit("frequency_encoding or target_encoding"))


def clean(
    df: DataFrame,
    high_missing: float = 0.5,
    outlier_method: str = "iqr",
    outlier_threshold: float = 1.5,
    skew_limit: float = 1.0,
    cardinality_limit: int = 100,
    missing: bool = True,
    constant: bool = True,
    duplicates: bool = True,
    outliers: bool = True,
    skew: bool = True,
    cardinality: bool = True,
) -> tuple[DataFrame, CleaningLog]:
    """High missing → constant → duplicates, then outlier, skew and cardinality reports.

    One pass gives the facts for both column rules: dropping a column does not change the facts
    of the others. The log holds one entry per column at most.
    """
    log = CleaningLog(columns_before=len(df.columns))
    facts = column_facts(df, df.columns)
    log.rows_before = next(iter(facts.values()))["rows"] if facts else 0
    drops: list[str] = []
    if missing:
        empty = high_missing_columns(facts, high_missing)
        log.dropped_columns += [{"column": c, "reason": "high_missing"} for c in empty]
        drops += empty
    if constant:
        same = [c for c in constant_columns(facts) if c not in drops]
        log.dropped_columns += [{"column": c, "reason": "constant"} for c in same]
        drops += same
    out = df.drop(*drops)
    if duplicates:
        # The cheap fingerprint pass decides whether the wide shuffle is needed at all.
        log.dropped_rows = duplicate_summary(out).first()["duplicate_rows"]
        if log.dropped_rows:
            out = hand_over(drop_duplicates(out), "distinct")
    log.rows_after = log.rows_before - log.dropped_rows
    log.columns_after = len(out.columns)
    numbers, texts = checked_numbers(out), text_columns(out)
    if outliers and numbers:
        found = (outliers_iqr if outlier_method == "iqr" else outliers_zscore)(out, numbers, outlier_threshold)
        log.outliers = {r["column"]: r["outliers"] for r in found.select("column", "outliers").collect()}
    if skew and numbers:
        log.skewed_columns = [r.asDict() for r in skewed_columns(out, numbers, skew_limit).collect()]
    if cardinality and texts:
        log.high_cardinality_columns = [
            r.asDict() for r in high_cardinality(out, texts, cardinality_limit).collect()]
    return out, log


def clean_log_table(df: DataFrame, log: CleaningLog) -> DataFrame:
    """The log as rows (action, column, detail)."""
    rows = [("dropped_column", d["column"], d["reason"]) for d in log.dropped_columns]
    rows += [("outliers", c, str(n)) for c, n in log.outliers.items()]
    rows += [("skewed", s["column"], f"{s['skewness']}:{s['suggestion']}") for s in log.skewed_columns]
    rows += [("high_cardinality", h["column"], str(h["distinct_values"])) for h in log.high_cardinality_columns]
    rows += [(k, "", str(getattr(log, k))) for k in (
        "rows_before", "rows_after", "columns_before", "columns_after", "dropped_rows")]
    return df.sparkSession.createDataFrame(rows, "action string, column string, detail string")
