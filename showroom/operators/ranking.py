"""Ranking metrics: top-k, decile lift, quantile bins, class ranking.

Ties are ordered by id. Order: score descending, id ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import add_all, named, one_row
from showroom.operators.ordering import exact_quantiles, global_rank, running_totals

K_VALUES = (100, 500, 1000)


def _best_first(score: str, row_id: str) -> list[Column]:
    return [named(score).desc(), named(row_id).asc()]


def resolve_score(probabilities: dict[str, str], target_class: str | None, positive: str = "1") -> str:
    """Probability column to rank by: the named class, or the positive class of a binary model."""
    if target_class is not None:
        if target_class not in probabilities:
            raise ValueError(f"unknown class {target_class}; classes: {sorted(probabilities)}")
        return probabilities[target_class]
    if len(probabilities) > 2:
        raise ValueError("a multiclass ranking needs target_class")
    return probabilities.get(positive, list(probabilities.values())[-1])


def top_rows(df: DataFrame, score: str, row_id: str, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """The k best rows with their rank. Every task keeps at most k rows, so only those move."""
    columns = dict.fromkeys([row_id, score, *keep])
    best = df.select(*[named(c) for c in columns]).orderBy(*_best_first(score, row_id)).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*_best_first(score, row_id))))


def top_list(
    df: DataFrame, score: str, row_id: str = v.LEAD_ID, label: str | None = None, k: int = 1000
) -> DataFrame:
    """Top list: rank, id, predicted_proba and, if known, actual_label."""
    best = top_rows(df, score, row_id, k, [label] if label else [])
    extra = [named(label).alias("actual_label")] if label else []
    return best.select("rank", named(row_id), named(score).alias("predicted_proba"), *extra)


def hit_count(top: DataFrame, target_class: str | None = None) -> DataFrame:
    """Hits of a top list: by class, or the sum of numeric labels (NULL if any is not a number)."""
    label = F.col("actual_label")
    if target_class is not None:
        return top.agg(F.count_if(label.cast("string") == target_class).alias("hits"))
    value = label.cast("string").try_cast("double")
    return top.agg(
        F.when(F.count("*") == F.count(value), F.coalesce(F.sum(value), F.lit(0.0)).cast("bigint")).alias("hits"))


def top_k_metrics(df: DataFrame, label: str, score: str, row_id: str, ks: Sequence[int] = K_VALUES) -> DataFrame:
    """Hits, precision, recall and lift for each k; a k above the row count is left out."""
    best = top_rows(df, score, row_id, max(ks), [label])
    hits = best.agg(*[
        F.coalesce(F.sum(F.when(F.col("rank") <= k, named(label).cast("bigint"))), F.lit(0)).alias(f"h{k}")
        for k in ks
    ])
    totals = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(named(label).cast("bigint")), F.lit(0)).alias("positives"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("k"), F.col(f"h{k}").alias("hit_count")) for k in ks]))
    out = hits.withColumn("t", one_row(totals)).select("t.n", "t.positives", rows.alias("r"))
    out = out.select("n", "positives", "r.*").where("k <= n")
    expected = F.col("positives") / F.col("n")
    rate = F.col("hit_count") / F.col("k")
    return out.select(
        "k", "hit_count", rate.alias("hit_rate"), rate.alias("precision"),
        F.coalesce(F.try_divide(F.col("hit_count"), F.col("positives")), F.lit(0.0)).alias("recall"),
        expected.alias("expected_rate"),
        F.coalesce(F.try_divide(rate, expected), F.lit(0.0)).alias("lift"),
    )


def decile_lift(df: DataFrame, label: str, score: str, row_id: str) -> DataFrame:
    """Ten groups of n div 10 rows by rank, the last takes the remainder."""
    narrow = df.select(named(row_id).alias("id"), named(score).alias("s"), named(label).cast("bigint").alias("y"))
    ranked = global_rank(narrow, [F.col("s").desc(), F.col("id").asc()], name="rank")
    totals = ranked.agg(F.count("*").alias("n"), F.sum("y").alias("positives"))
    size = F.floor(F.col("n") / 10)
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col("rank") - 1, size)), F.lit(9).cast("bigint")), F.lit(9).cast("bigint"))
    groups = (
        ranked.withColumn("t", one_row(totals)).select("*", "t.n", "t.positives")
        .groupBy((place + 1).alias("decile"), "n", "positives")
        .agg(F.count("*").alias("count"), F.sum("y").alias("hit_count"))
    )
    # At most ten rows from here on.
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    rate, base = F.col("hit_count") / F.col("count"), F.col("positives") / F.col("n")
    return groups.select(
        "decile", "count", "hit_count", rate.alias("hit_rate"),
        (F.sum("hit_count").over(upto) / F.sum("count").over(upto)).alias("cumulative_hit_rate"),
        F.coalesce(F.try_divide(rate, base), F.lit(0.0)).alias("lift"),
    )


def compare_rankings(
    df: DataFrame, label: str, model: str, baseline: str, row_id: str, ks: Sequence[int] = K_VALUES
) -> DataFrame:
    """Hits of two rankings at k and how many rows they share."""
    k_max = max(ks)
    one = top_rows(df, model, row_id, k_max, [label]).select(named(row_id).alias("id"), named(label).cast("bigint").alias("y"), F.col("rank").alias("m"))
    two = top_rows(df, baseline, row_id, k_max, [label]).select(named(row_id).alias("id"), named(label).cast("bigint").alias("y"), F.col("rank").alias("b"))
    both = one.join(two.withColumnRenamed("y", "y2"), "id", "full").withColumn("y", F.coalesce("y", "y2"))
    at = lambda col, k: F.coalesce(F.col(col) <= k, F.lit(False))
    cells = [
        F.struct(
            F.lit(k).cast("bigint").alias("k"),
            F.coalesce(F.sum(F.when(at("m", k), F.col("y"))), F.lit(0)).alias("model_hits"),
            F.coalesce(F.sum(F.when(at("b", k), F.col("y"))), F.lit(0)).alias("baseline_hits"),
            F.count_if(at("m", k) & at("b", k)).alias("overlap_count"),
        )
        for k in ks
    ]
    rows = both.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
    rows = rows.select(F.explode(F.array(*[f"c{i}" for i in range(len(ks))])).alias("r")).select("r.*")
    size = df.agg(F.count("*").alias("n"))
    rows = rows.where(F.col("k") <= one_row(size)["n"])
    gain = F.try_divide(F.col("model_hits") - F.col("baseline_hits"), F.col("baseline_hits"))
    return rows.withColumn("improvement", F.coalesce(gain, F.lit(0.0)))


def quantile_bins(df: DataFrame, label: str, probability: str, score: str, bins: int = 10) -> DataFrame:
    """Rows per quantile bin of the score: edges are exact quantiles, equal edges merge, bins are
    closed on the right and the lowest edge belongs to the first bin."""
    shares = [i / bins for i in range(bins + 1)]
    # At most bins + 1 numbers.
    edges = sorted({r["quantile"] for r in exact_quantiles(df, [score], shares).collect()})
    value = named(score).cast("double")
    below = add_all([(value > e).cast("int") for e in edges] or [F.lit(1)])
    placed = df.where(value.isNotNull()).withColumn("bin", F.greatest(below, F.lit(1)))
    return placed.groupBy("bin").agg(
        F.count("*").alias("count"),
        F.avg(named(label).cast("double")).alias("actual_rate"),
        F.avg(named(probability).cast("double")).alias("predicted_rate"),
        F.sum(named(label).cast("bigint")).alias("positive_count"),
    )


def bin_summary(binned: DataFrame) -> DataFrame:
    """Totals over the bins and the rates of the highest and lowest bin."""
    return binned.agg(
        F.sum("count").alias("total_samples"),
        F.sum("positive_count").alias("total_positives"),
        (F.sum("positive_count") / F.sum("count")).alias("overall_rate"),
        F.max_by("actual_rate", "bin").alias("high_bin_rate"),
        F.min_by("actual_rate", "bin").alias("low_bin_rate"),
    )


def class_ranking(
    df: DataFrame, label: str, probabilities: dict[str, str], row_id: str, ratios: Sequence[float] = tuple(v.TOP_RATIOS)
) -> DataFrame:
    """Per class and share: hit rate and lift among the best rows of that class's probability."""
    stacked = df.select(
        named(row_id).alias("id"), named(label).cast("string").alias("y"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("class"), named(p).cast("double").alias("s")) for c, p in probabilities.items()
        ])).alias("c"),
    ).select("id", "c.class", "c.s", F.coalesce(F.col("y") == F.col("c.class"), F.lit(False)).cast("bigint").alias("hit"))
    ranked = global_rank(stacked, [F.col("s").desc_nulls_last(), F.col("id").asc()], ["class"], "rank")
    totals = ranked.groupBy("class").agg(F.count("*").alias("n"), F.sum("hit").alias("positives"))
    cut = lambda r: F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("n") * F.lit(float(r))))
    # One row per class.
    counted = ranked.join(F.broadcast(totals), "class").groupBy("class", "n", "positives").agg(*[
        F.sum(F.when(F.col("rank") <= cut(r), F.col("hit")).otherwise(F.lit(0).cast("bigint"))).alias(f"h{i}")
        for i, r in enumerate(ratios)
    ])
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(r)).alias("top_ratio"), cut(r).alias("top_n"), F.col(f"h{i}").alias("hits"))
        for i, r in enumerate(ratios)
    ]))
    out = counted.select("class", "n", "positives", rows.alias("r")).select("class", "n", "positives", "r.*")
    base, rate = F.col("positives") / F.col("n"), F.col("hits") / F.col("top_n")
    return out.select(
        "class", "top_ratio", "top_n", base.alias("baseline_rate"), rate.alias("hit_rate"),
        F.coalesce(F.try_divide(rate, base), F.lit(0.0)).alias("lift"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC-AUC; equal scores count half. Rows are merged by score first, so a score shared by
    very many rows is one row in the ordering."""
    y = named(label).cast("bigint")
    points = df.where(named(score).isNotNull()).groupBy(named(score).alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    placed = running_totals(points, [F.col("s").asc()], {"neg_below": F.col("neg")})
    wins = (F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).cast("double")
    return placed.agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def metric_bundle(df: DataFrame, label: str, score: str, row_id: str, ks: Sequence[int] = K_VALUES) -> dict[str, DataFrame]:
    y = named(label).cast("bigint")
    return {
        "topk_metrics": top_k_metrics(df, label, score, row_id, ks),
        "decile_lift": decile_lift(df, label, score, row_id),
        "summary": df.agg(
            F.count("*").alias("total_samples"), F.sum(y).alias("total_positives"),
            F.avg(named(label).cast("double")).alias("positive_rate")),
    }
