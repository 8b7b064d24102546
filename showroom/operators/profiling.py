"""Table profiles: counts, nulls, column summaries, top values, target balance, suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab as v
from showroom.functions.cells import is_number, named, one_row
from showroom.operators.contract import EXPRESSIONS_PER_PASS
from showroom.operators.ordering import unpivot_texts, value_counts
from showroom.session import stored_lookup

HIGH_MISSING, MEDIUM_MISSING = 50.0, 10.0
IMBALANCE_LIMIT = 10.0
CARDINALITY_LIMIT = 100


def category(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, T.StringType):
        return "categorical"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    return "other"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and exact duplicates (rows minus distinct rows).

    Only 8-byte fingerprints are shuffled for the whole table. Rows whose fingerprint occurs once
    are unique for sure; only the others are compared in full.
    """
    every = [named(c) for c in df.columns]
    marked = df.withColumn("__mark", F.xxhash64(*every))
    repeated = stored_lookup(marked.groupBy("__mark").agg(F.count("*").alias("n")).where("n > 1"))
    suspects = marked.join(repeated.select("__mark"), "__mark", "left_semi")
    distinct = suspects.groupBy(*every).agg(F.lit(1).alias("one")).agg(F.count("*").alias("n"))
    # Rows that look repeated, less the distinct ones among them, are the duplicates.
    alike = one_row(repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))["n"]
    return df.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), (alike - one_row(distinct)["n"]).alias("duplicate_rows"))


def wide_aggregate(df: DataFrame, make, names: list[str]) -> DataFrame:
    """One row per column from wide aggregations of bounded width. ``make`` returns the
    statistics of one column as name -> expression."""
    out = None
    for start in range(0, len(names), EXPRESSIONS_PER_PASS):
        batch = names[start : start + EXPRESSIONS_PER_PASS]
        cells = [
            F.struct(F.lit(c).alias("column"), *[e.alias(k) for k, e in make(c).items()]) for c in batch
        ]
        part = df.agg(*[c.alias(f"s{i}") for i, c in enumerate(cells)])
        rows = part.select(F.explode(F.array(*[f"s{i}" for i in range(len(batch))])).alias("s")).select("s.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def missing_by_column(df: DataFrame) -> DataFrame:
    """Nulls and their percentage (2 digits) per column, in one pass."""
    stats = wide_aggregate(
        df, lambda c: {"total": F.count("*"), "filled": F.count(named(c))}, df.columns
    )
    nulls = F.col("total") - F.col("filled")
    share = F.coalesce(F.try_divide(nulls * 100.0, F.col("total")), F.lit(0.0))
    return stats.select(
        "column", "total", nulls.alias("missing_count"), F.round(share, 2).alias("missing_ratio"),
        share.alias("exact_ratio"),
    )


def missing_summary(df: DataFrame) -> DataFrame:
    per_column = missing_by_column(df)
    ratio = F.col("exact_ratio")
    return per_column.agg(
        F.sum("missing_count").alias("total_missing"),
        F.sum("total").alias("total_cells"),
        F.count_if(ratio > HIGH_MISSING).alias("high_missing_columns"),
        F.count_if((ratio > MEDIUM_MISSING) & (ratio <= HIGH_MISSING)).alias("medium_missing_columns"),
    ).withColumn(
        "overall_missing_ratio",
        F.round(F.coalesce(F.try_divide(F.col("total_missing") * 100.0, F.col("total_cells")), F.lit(0.0)), 2),
    )


def column_summary(df: DataFrame) -> DataFrame:
    """Type, category, min, max, mean, approximate distinct count and nulls per column."""

    def stats(c: str) -> dict:
        mean = F.avg(named(c)) if is_number(df, c) else F.lit(None).cast("double")
        return {
            "min": F.min(named(c)).cast("string"),
            "max": F.max(named(c)).cast("string"),
            "mean": mean,
            "approx_distinct": F.approx_count_distinct(named(c)),
            "filled": F.count(named(c)),
            "total": F.count("*"),
        }

    facts = {f.name: (f.dataType.simpleString(), category(f.dataType)) for f in df.schema}
    pick = lambda i: F.create_map(
        *[F.lit(x) for c, t in facts.items() for x in (c, t[i])])[F.col("column")]
    return wide_aggregate(df, stats, df.columns).select(
        "column", pick(0).alias("dtype"), pick(1).alias("category"), "min", "max", "mean",
        "approx_distinct", (F.col("total") - F.col("filled")).alias("missing_count"),
    )


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The k most frequent non-null values per text column; ties by value. The rank limit is
    applied inside every task before the shuffle."""
    counts = value_counts(df, columns or text_columns(df)).where("value IS NOT NULL")
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)


def find_target(columns: list[str]) -> str | None:
    return next((c for c in columns if any(w in c.lower() for w in v.TARGET_WORDS)), None)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(named(target).cast("string").alias("label")).agg(F.count("*").alias("n"))


def target_summary(df: DataFrame, target: str | None = None) -> DataFrame | None:
    """Null count, classes (null is one) and the imbalance ratio; None without a target."""
    target = target or find_target(df.columns)
    if target is None:
        return None
    counts = target_distribution(df, target)
    ratio = F.max("n") / F.min("n")
    return counts.agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("label").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("*").alias("classes"),
        F.round(ratio, 2).alias("imbalance_ratio"),
        (ratio > IMBALANCE_LIMIT).alias("is_imbalanced"),
    ).withColumn("target", F.lit(target))


def distinct_counts(df: DataFrame, columns: list[str], count_null: bool = True) -> DataFrame:
    """Exact distinct values per column; null may count as a value."""
    values = unpivot_texts(df, columns).distinct()
    values = values if count_null else values.where("value IS NOT NULL")
    return values.groupBy("column").agg(F.count("*").alias("distinct_values"))


def _kind_rows(df: DataFrame, section: str, key, **values) -> DataFrame:
    items = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(c).cast("string").alias("value"))
        for name, c in values.items()
    ])
    return df.select(F.lit(section).alias("section"), key.alias("item"), F.explode(items).alias("m")).select(
        "section", "item", "m.metric", "m.value"
    )


def full_profile(df: DataFrame, target: str | None = None) -> DataFrame:
    """All profiles in one long table (section, item, metric, value)."""
    nothing = F.lit("")
    parts = [
        _kind_rows(duplicate_summary(df), "basic", nothing, rows="rows", columns="columns",
                   duplicate_rows="duplicate_rows"),
        _kind_rows(missing_by_column(df), "missing", F.col("column"), missing_count="missing_count",
                   missing_ratio="missing_ratio"),
        _kind_rows(column_summary(df), "columns", F.col("column"), dtype="dtype", category="category",
                   min="min", max="max", mean="mean", approx_distinct="approx_distinct"),
    ]
    if text_columns(df):
        parts.append(_kind_rows(top_values(df), "top_values",
                                F.concat_ws("=", "column", "value"), count="n"))
    found = target_summary(df, target)
    if found is not None:
        parts.append(_kind_rows(found, "target", F.col("target"), null_count="null_count",
                                classes="classes", imbalance_ratio="imbalance_ratio"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cleaning_suggestions(df: DataFrame, target: str | None = None) -> DataFrame:
    """Rows (rule, n): one per rule that fires."""
    missing = missing_summary(df)
    rows = [
        missing.select(F.lit("high_missing").alias("rule"), F.col("high_missing_columns").alias("n")),
        missing.select(F.lit("medium_missing").alias("rule"), F.col("medium_missing_columns").alias("n")),
        duplicate_summary(df).select(F.lit("duplicates").alias("rule"), F.col("duplicate_rows").alias("n")),
        constant_columns(df).agg(F.count("*").alias("n")).select(F.lit("constant").alias("rule"), "n"),
    ]
    found = target_summary(df, target)
    if found is not None:
        rows.append(found.select(F.lit("imbalance").alias("rule"), F.col("is_imbalanced").cast("bigint").alias("n")))
    texts = text_columns(df)
    if texts:
        many = distinct_counts(df, texts, count_null=False).where(F.col("distinct_values") > CARDINALITY_LIMIT)
        rows.append(many.agg(F.count("*").alias("n")).select(F.lit("high_cardinality").alias("rule"), "n"))
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.where("n > 0")


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with at most one distinct non-null value, exactly."""
    stats = wide_aggregate(
        df,
        lambda c: {"filled": F.count(named(c)), "same": F.min(named(c)) == F.max(named(c))},
        df.columns,
    )
    return stats.where((F.col("filled") == 0) | F.col("same")).select("column")


def quality_report(df: DataFrame) -> DataFrame:
    """Rows (kind, column, value): totals, columns with nulls, constant columns."""
    basic = duplicate_summary(df)
    totals = basic.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("kind"), F.lit("").alias("column"), F.col(c).cast("double").alias("value"))
        for c in ("rows", "columns", "duplicate_rows")
    ])).alias("r")).select("r.*")
    nulls = missing_by_column(df).where("missing_count > 0").select(
        F.explode(F.array(
            F.struct(F.lit("missing_count").alias("kind"), F.col("column"),
                     F.col("missing_count").cast("double").alias("value")),
            F.struct(F.lit("missing_percent").alias("kind"), F.col("column"),
                     F.col("exact_ratio").alias("value")),
        )).alias("r")).select("r.*")
    constant = constant_columns(df).select(
        F.lit("constant").alias("kind"), "column", F.lit(1.0).alias("value"))
    return totals.unionByName(nulls).unionByName(constant)


def basic_stats(df: DataFrame) -> DataFrame:
    """Nulls of every column and the value counts of label-like columns: (kind, column, item, value)."""
    nulls = missing_by_column(df).select(
        F.lit("missing").alias("kind"), "column", F.lit("").alias("item"),
        F.col("missing_count").alias("value"),
    )
    labels = [c for c in df.columns if any(m in c for m in v.LABEL_MARKERS)]
    if not labels:
        return nulls
    counts = value_counts(df, labels).where("value IS NOT NULL")
    return nulls.unionByName(
        counts.select(F.lit("label").alias("kind"), "column", F.col("value").alias("item"),
                      F.col("n").alias("value")))


def label_distribution(df: DataFrame, label: str, order: tuple[str, ...] = ("H", "A", "B", "O", "N")) -> DataFrame:
    """Count, share and business position of every class."""
    counts = df.groupBy(named(label).alias("label")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    position = F.lit(len(order) + 1)
    for i, name in reversed(list(enumerate(order, 1))):
        position = F.when(F.col("label") == name, i).otherwise(position)
    return counts.select("label", "n", (F.col("n") / total).alias("share"), position.alias("position"))


def explore(df: DataFrame, target: str, limit: int = 15) -> DataFrame:
    """Numeric columns by absolute correlation with the target, with mean and deviation."""
    names = [c for c in numeric_columns(df) if c != target]
    y = named(target).cast("double")
    stats = wide_aggregate(
        df,
        lambda c: {
            "correlation": F.corr(named(c).cast("double"), y), "mean": F.avg(named(c)),
            "std": F.stddev(named(c)), "min": F.min(named(c)).cast("double"),
            "max": F.max(named(c)).cast("double"), "filled": F.count(named(c)),
        },
        names,
    )
    size = F.abs("correlation")
    return stats.where(size.isNotNull() & ~F.isnan(size)).orderBy(size.desc(), "column").limit(limit)


def conversion_rates(df: DataFrame, labels: list[str]) -> DataFrame:
    return wide_aggregate(df, lambda c: {"rate": F.avg(named(c).cast("double"))}, labels)


def mostly_missing(df: DataFrame, percent: float = 10.0) -> DataFrame:
    return missing_by_column(df).where(F.col("exact_ratio") > percent).select(
        "column", "missing_count", "missing_ratio")
