"""Business results by rating: buckets, monotonic layering, KPIs, model comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.actions import lead_actions
from showroom.functions.cells import named, number_or_zero, one_row
from showroom.functions.ratings import hab_rating
from showroom.operators import classes as cl
from showroom.operators.ranking import auc, class_ranking, top_k_metrics
from showroom.session import cut_lineage

ARRIVE_14, DRIVE_14 = "到店标签_14天", "试驾标签_14天"
COMPARED = ["accuracy", "balanced_accuracy", "mcc", "macro_f1", "b_recall"]


def bucket_summary(df: DataFrame, label: str = v.PREDICTED, outcomes: Sequence[str] = tuple(v.OUTCOME_COLUMNS)) -> DataFrame:
    """Count, share and mean outcomes per H/A/B bucket; a bad or missing outcome counts 0."""
    found = [c for c in outcomes if c in df.columns]
    groups = df.groupBy(named(label).alias("bucket")).agg(
        F.count("*").alias("sample_count"), *[F.avg(number_or_zero(df, c)).alias(f"{c}_rate") for c in found])
    # One row per label.
    share = F.col("sample_count") / F.sum("sample_count").over(Window.partitionBy())
    return groups.withColumn("sample_ratio", share).where(F.col("bucket").isin(v.HAB_ORDER))


def _at(bucket: str, metric: str) -> Column:
    return F.max(F.when(F.col("bucket") == bucket, named(metric)))


def _falls(h: Column, a: Column, b: Column) -> Column:
    return (h > a) & (a > b)


def monotonicity(buckets: DataFrame, metrics: Sequence[str] = (f"{DRIVE_14}_rate", f"{ARRIVE_14}_rate")) -> DataFrame:
    """H > A > B on the first usable metric, as one row."""
    usable = [m for m in metrics if m in buckets.columns]
    nothing = {"metric": F.lit(None).cast("string"), "message": F.lit(v.MONOTONIC_MISSING)}
    if not usable:
        return buckets.agg(F.lit(False).alias("passed"), *[c.alias(n) for n, c in nothing.items()])
    metric = usable[0]
    row = buckets.agg(
        F.count_distinct("bucket").alias("found"), *[_at(b, metric).alias(b) for b in v.HAB_ORDER])
    whole = F.col("found") == 3
    passed = F.coalesce(whole & _falls(F.col("H"), F.col("A"), F.col("B")), F.lit(False))
    return row.select(
        passed.alias("passed"), F.when(whole, metric).alias("metric"),
        F.when(~whole, v.MONOTONIC_MISSING).when(passed, v.MONOTONIC_YES).otherwise(v.MONOTONIC_NO).alias("message"))


def business_kpis(df: DataFrame, label: str = v.PREDICTED) -> DataFrame:
    """All KPIs in one aggregation over the rows."""
    bucket = named(label)
    rows = F.count("*").cast("double")
    share = lambda n, d: F.coalesce(F.try_divide(n, d), F.lit(0.0))
    sums: dict[str, Column] = {}
    for short, column in (("arrive", ARRIVE_14), ("drive", DRIVE_14)):
        value = number_or_zero(df, column)
        sums[f"overall_{short}"] = share(F.sum(value), rows)
        for b in v.HAB_ORDER:
            sums[f"{b}_{short}"] = F.coalesce(F.avg(F.when(bucket == b, value)), F.lit(0.0))
        hit = value > 0
        sums[f"ha_{short}"] = share(F.count_if(hit & bucket.isin("H", "A")).cast("double"), F.count_if(hit).cast("double"))
    sums |= {f"n_{b}": F.count_if(bucket == b) for b in v.HAB_ORDER}
    sums["n"] = rows
    row = df.agg(*[c.alias(n) for n, c in sums.items()])
    all_three = (F.col("n_H") > 0) & (F.col("n_A") > 0) & (F.col("n_B") > 0)

    def falls(short: str, column: str) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("boolean")
        return F.when(all_three, _falls(F.col(f"H_{short}"), F.col(f"A_{short}"), F.col(f"B_{short}")))

    arrive, drive = falls("arrive", ARRIVE_14), falls("drive", DRIVE_14)
    yes = lambda c: F.coalesce(c, F.lit(False))
    message = F.when(yes(arrive) & yes(drive), v.LAYERED_BOTH).when(yes(arrive) | yes(drive), v.LAYERED_ONE).otherwise(v.LAYERED_NONE)
    return row.select(
        F.col("overall_arrive").alias("overall_arrive_14d_rate"), F.col("overall_drive").alias("overall_drive_14d_rate"),
        *[F.col(f"{b}_{s}").alias(f"{b.lower()}_{s}_14d_rate") for s in ("arrive", "drive") for b in v.HAB_ORDER],
        share(F.col("H_arrive"), F.col("overall_arrive")).alias("h_arrive_lift"),
        share(F.col("H_drive"), F.col("overall_drive")).alias("h_drive_lift"),
        F.col("ha_arrive").alias("ha_arrive_capture"), F.col("ha_drive").alias("ha_drive_capture"),
        share(F.col("n_B").cast("double"), F.col("n")).alias("b_bucket_share"),
        message.alias("client_layering_message"), arrive.alias("arrive_monotonic"), drive.alias("drive_monotonic"))


def validate_derivation(
    df: DataFrame, p7: str, p14: str, p21: str, actual: dict[int, str], threshold: float = 0.5
) -> DataFrame:
    """Rows and real rates per derived rating, absent ratings with 0, and the layering verdict."""
    rating = hab_rating(named(p7), named(p14), named(p21), threshold)
    rated = df.withColumn("__rating", rating)
    cells = []
    for r in ("H", "A", "B", "N"):
        mine = F.col("__rating") == r
        rates = [
            F.coalesce(F.avg(F.when(mine, named(c).cast("double"))), F.lit(0.0)).alias(f"rate_{n}d") for n, c in actual.items()]
        cells.append(F.struct(F.lit(r).alias("rating"), F.count_if(mine).alias("count"), *rates))
    row = rated.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
    h, a, b = (F.col(f"c{i}.rate_14d") for i in range(3))
    broken = ((h > 0) & (a > 0) & (h < a)) | ((a > 0) & (b > 0) & (a < b))
    return row.select((~broken).alias("is_hierarchical"), F.explode(F.array("c0", "c1", "c2", "c3")).alias("r")).select(
        "r.*", "is_hierarchical")


# --- model comparison -------------------------------------------------------------------


def comparison_row(df: DataFrame, name: str, role: str, actual: str, predicted: str, with_kpis: bool = True) -> DataFrame:
    """One row: class metrics, B recall, layering check and KPIs of a model. The few columns needed
    are written once, because several aggregations read them."""
    needed = [c for c in dict.fromkeys([actual, predicted, *v.OUTCOME_COLUMNS]) if c in df.columns]
    df = cut_lineage(df.select(*[named(c) for c in needed]))
    pairs = cl.pair_counts(df, actual, predicted)
    metrics = cl.score_pairs(pairs).select("accuracy", "balanced_accuracy", "mcc", "macro_f1")
    recall = cl.per_class(pairs).agg(
        F.coalesce(F.max(F.when(F.col("class") == "B", F.col("recall"))), F.lit(0.0)).alias("b_recall"))
    out = metrics.withColumn("b_recall", one_row(recall)["b_recall"])
    if with_kpis:
        out = out.withColumn("__k", one_row(business_kpis(df, predicted))).select("*", "__k.*").drop("__k")
        passed = one_row(monotonicity(bucket_summary(df, predicted)))
        out = out.withColumns({"monotonicity_passed": passed["passed"], "monotonicity_metric": passed["metric"]})
    return out.select(F.lit(name).alias("model_name"), F.lit(role).alias("role"), "*")


def compare_models(rows: Sequence[DataFrame], baseline_role: str = "baseline") -> DataFrame:
    """One row per model with the differences to the baseline."""
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    base = one_row(table.where(F.col("role") == baseline_role).select(*COMPARED).limit(1))
    return table.withColumns({f"delta_vs_baseline_{c}": F.col(c) - base[c] for c in COMPARED})


def recommend(table: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Among the models within the tolerance of the best macro F1: best balanced accuracy, then
    B recall, then H arrival and H drive rate. The table has one row per model."""
    names = ["macro_f1", "balanced_accuracy", "b_recall", "h_arrive_14d_rate", "h_drive_14d_rate"]
    value = lambda c: F.coalesce(named(c).cast("double"), F.lit(0.0)) if c in table.columns else F.lit(0.0)
    best = F.max(value("macro_f1")).over(Window.partitionBy())
    near = table.withColumn("__best", best).where(value("macro_f1") >= F.col("__best") - tolerance)
    return near.orderBy(*[value(c).desc() for c in names[1:]], "model_name").drop("__best").limit(1)


def side_by_side(df: DataFrame, judgements: dict[str, Column], row_id: str = v.LEAD_ID) -> DataFrame:
    """Id, the judgement of every model, and whether all agree. One projection of the same row: nothing is joined by position or id."""
    said = list(judgements.values())
    agree = F.lit(True)
    for other in said[1:]:
        agree = agree & said[0].eqNullSafe(other)
    return df.select(named(row_id), *[c.alias(n) for n, c in judgements.items()], agree.alias("agree"))


def ensemble_evaluation(df: DataFrame, label: str, score: str, row_id: str, ks: Sequence[int]) -> DataFrame:
    """AUC, accuracy at 0.5 and the top-k table of one model of an ensemble."""
    right = (named(score) >= 0.5).cast("int") == named(label).cast("int")
    accuracy = df.agg(F.avg(right.cast("double")).alias("accuracy"))
    return top_k_metrics(df, label, score, row_id, ks).withColumns({
        "accuracy": one_row(accuracy)["accuracy"], "auc": one_row(auc(df, label, score))["auc"]})


def comparator_bundle(
    df: DataFrame, name: str, role: str, actual: str, probabilities: dict[str, str], row_id: str = v.LEAD_ID,
    predicted: str = v.PREDICTED, business: bool = True,
) -> dict[str, DataFrame]:
    """Every evaluation table of one model. ``df`` holds truth, prediction, probabilities and features."""
    bundle = {
        "comparison_row": comparison_row(df, name, role, actual, predicted, business),
        "report": cl.classification_report(df, actual, predicted),
        "confusion": cl.confusion_matrix(df, actual, predicted),
        "class_ranking": class_ranking(df, actual, probabilities, row_id),
        "results": df.select(
            named(row_id), named(actual).alias("真实标签"), named(predicted).alias("预测标签"),
            *[named(p).alias(f"概率_{c}") for c, p in probabilities.items()]),
    }
    if "B" in probabilities:
        bundle["b_threshold"] = cl.threshold_report(df, actual, probabilities["B"], "B")
    if business:
        bundle["buckets"] = bucket_summary(df, predicted)
        bundle["monotonicity"] = monotonicity(bundle["buckets"])
        bundle["kpis"] = business_kpis(df, predicted)
        bundle["lead_actions"] = lead_actions(df, predicted, {c: named(p) for c, p in probabilities.items()}, row_id)
    return bundle
