"""Class metrics from confusion counts, and threshold searches.

A search never repeats the rows per threshold. Each row is placed between the thresholds once and
counted by (class, place); the small count table then answers every threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import named, one_row
from showroom.operators.policy import class_counts, ordered_labels


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows (actual, predicted, n): at most classes squared."""
    return df.groupBy(
        named(actual).cast("string").alias("actual"), named(predicted).cast("string").alias("predicted")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[str] | None = None) -> DataFrame:
    """One row per true class, one column per predicted class, in business order."""
    counts = pair_counts(df, actual, predicted)
    if labels is None:
        labels = ordered_labels(class_counts(counts.select(F.explode(F.array("actual", "predicted")).alias("x")), "x"))
    columns = [
        F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}") for c in labels]
    matrix = counts.groupBy("actual").agg(*columns)
    frame = counts.sparkSession.createDataFrame([(i, c) for i, c in enumerate(labels)], "position int, actual string")
    return frame.join(matrix, "actual", "left").fillna(0).orderBy("position")


def _safe(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def per_class(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs, from pair counts."""
    keys = list(keys)
    sides = pairs.select(*keys, F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted_n"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0).cast("bigint")).alias("tp")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted_n"),
                 F.lit(0).cast("bigint").alias("tp")),
    )).alias("s")).select(*keys, "s.*")
    sums = sides.groupBy(*keys, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted_n", "tp")])
    return sums.where((F.col("support") > 0) | (F.col("predicted_n") > 0)).select(
        *keys, "class", "support", "predicted_n", "tp",
        _safe(F.col("tp"), F.col("predicted_n")).alias("precision"),
        _safe(F.col("tp"), F.col("support")).alias("recall"),
        _safe(2 * F.col("tp"), F.col("support") + F.col("predicted_n")).alias("f1"),
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per class plus accuracy, macro avg and weighted avg."""
    classes = per_class(pair_counts(df, actual, predicted))
    weight = F.col("support") / F.sum("support").over(Window.partitionBy())
    total = F.sum("support")
    summary = classes.withColumn("w", weight).agg(
        total.alias("support"), (F.sum("tp") / total).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[F.sum(F.col(c) * F.col("w")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )
    lines = F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), F.col("support")),
        *[F.struct(F.lit(f"{k} avg").alias("class"), F.col(f"{k}_precision").alias("precision"),
                   F.col(f"{k}_recall").alias("recall"), F.col(f"{k}_f1").alias("f1"), F.col("support"))
          for k in ("macro", "weighted")],
    ))
    totals = summary.select(lines.alias("l")).select("l.*")
    return classes.select("class", "precision", "recall", "f1", "support").unionByName(totals)


def score_pairs(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted F1, multiclass MCC from pair counts."""
    keys = list(keys)
    classes = per_class(pairs, keys)
    d = lambda c: F.col(c).cast("double")
    n, correct = F.sum("support").cast("double"), F.sum("tp").cast("double")
    cross = F.sum(d("support") * d("predicted_n"))
    squares = lambda c: F.sum(d(c) * d(c))
    stats = classes.groupBy(*keys).agg(
        F.sum("support").alias("n"),
        (correct / n).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
        (correct * n - cross).alias("top"),
        (F.sqrt(n * n - squares("predicted_n")) * F.sqrt(n * n - squares("support"))).alias("bottom"),
    )
    return stats.withColumn("mcc", _safe(F.col("top"), F.col("bottom"))).drop("top", "bottom")


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return score_pairs(pair_counts(df, actual, predicted))


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 of the positive class at a threshold, with exact ROC-AUC."""
    from showroom.operators.ranking import auc

    y, hit = named(label).cast("int") == 1, named(score) >= threshold
    counts = df.agg(
        F.count("*").alias("n"), F.count_if(y & hit).alias("tp"), F.count_if(hit).alias("predicted"),
        F.count_if(y).alias("actual"), F.count_if(y == hit).alias("right"))
    precision, recall = _safe(F.col("tp"), F.col("predicted")), _safe(F.col("tp"), F.col("actual"))
    out = counts.select(
        (F.col("right") / F.col("n")).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        _safe(2 * F.col("tp"), F.col("predicted") + F.col("actual")).alias("f1"))
    return out.withColumn("auc", one_row(auc(df, label, score))["auc"])


# --- threshold searches ---------------------------------------------------------------


def _place(score: Column, thresholds: Sequence[float]) -> Column:
    """How many of the ascending thresholds the score reaches."""
    reached = [F.when(score >= float(t), 1).otherwise(0) for t in thresholds]
    total = reached[0]
    for r in reached[1:]:
        total = total + r
    return total


def _literal_rows(names: Sequence[str], rows: Sequence[Sequence]) -> Column:
    return F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row)]) for row in rows]))


def threshold_report(
    df: DataFrame, label: str, score: str, positive: str = "B", thresholds: Sequence[float] = tuple(v.REPORT_THRESHOLDS)
) -> DataFrame:
    """Predicted, actual and true positives with precision, recall and F1 per threshold."""
    thresholds = sorted(thresholds)
    truth = F.coalesce(named(label).cast("string") == positive, F.lit(False))
    counts = df.groupBy(_place(named(score), thresholds).alias("place")).agg(
        F.count("*").alias("n"), F.count_if(truth).alias("positives"))
    grid = _literal_rows(["level", "threshold"], [(i, float(t)) for i, t in enumerate(thresholds, 1)])
    cells = counts.withColumn("g", grid).select("place", "n", "positives", "g.*")
    reached = F.col("place") >= F.col("level")
    out = cells.groupBy("threshold").agg(
        F.coalesce(F.sum(F.when(reached, F.col("n"))), F.lit(0)).alias("predicted_positive"),
        F.sum("positives").alias("actual_positive"),
        F.coalesce(F.sum(F.when(reached, F.col("positives"))), F.lit(0)).alias("true_positive"),
    )
    tp, predicted, actual = F.col("true_positive"), F.col("predicted_positive"), F.col("actual_positive")
    return out.select(
        "threshold", "predicted_positive", "actual_positive", "true_positive",
        _safe(tp, predicted).alias("precision"), _safe(tp, actual).alias("recall"),
        _safe(2 * tp, predicted + actual).alias("f1"))


def hab_policy_grid(
    df: DataFrame, label: str, probabilities: dict[str, str],
    h_thresholds: Sequence[float] = tuple(v.H_THRESHOLDS), b_thresholds: Sequence[float] = tuple(v.B_THRESHOLDS),
    min_b_share: float = 0.03,
) -> DataFrame:
    """Scores of every (H, B) threshold cell, in one pass over the rows."""
    hs, bs = sorted(h_thresholds), sorted(b_thresholds)
    p = {c: F.coalesce(named(col).cast("double"), F.lit(0.0)) for c, col in probabilities.items()}
    counts = df.groupBy(
        named(label).cast("string").alias("actual"), _place(p["H"], hs).alias("h"), _place(p["B"], bs).alias("b")
    ).agg(F.count("*").alias("n"))
    cells = [(i * len(bs) + j, i + 1, j + 1, float(h), float(b)) for i, h in enumerate(hs) for j, b in enumerate(bs)]
    grid = _literal_rows(["cell", "h_level", "b_level", "h_threshold", "b_threshold"], cells)
    keys = ["cell", "h_threshold", "b_threshold"]
    said = F.when(F.col("h") >= F.col("h_level"), "H").when(F.col("b") >= F.col("b_level"), "B").otherwise("A")
    pairs = (
        counts.withColumn("g", grid).select("actual", "h", "b", "n", "g.*").withColumn("predicted", said)
        .groupBy(*keys, "actual", "predicted").agg(F.sum("n").alias("n"))
    )
    extra = pairs.groupBy("cell").agg(
        (F.coalesce(F.sum(F.when(F.col("predicted") == "B", F.col("n"))), F.lit(0)) / F.sum("n")).alias("predicted_b_rate"),
        _safe(F.coalesce(F.sum(F.when((F.col("predicted") == "B") & (F.col("actual") == "B"), F.col("n"))), F.lit(0)),
              F.coalesce(F.sum(F.when(F.col("actual") == "B", F.col("n"))), F.lit(0))).alias("b_recall"))
    scores = score_pairs(pairs, keys).select(*keys, "balanced_accuracy", "macro_f1")
    enough = (F.col("predicted_b_rate") >= min_b_share).cast("int")
    return scores.join(extra, "cell").withColumn("enough_b", enough)


def _best(grid: DataFrame, criteria: Sequence[str], first: str) -> DataFrame:
    """Row that is best by the criteria; the earliest wins a tie."""
    order = F.struct(*[F.col(c) for c in criteria], (-F.col(first)).alias("early"))
    return grid.agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")


def best_hab_policy(grid: DataFrame) -> DataFrame:
    return _best(grid, ["enough_b", "balanced_accuracy", "b_recall", "macro_f1"], "cell")


def optimise_hab_policy(df: DataFrame, label: str, probabilities: dict[str, str], **options) -> dict:
    """Best policy as a dict; plain argmax when a class is missing or there are no rows."""
    if not {"H", "A", "B"} <= set(probabilities):
        return {"strategy": "argmax"}
    row = best_hab_policy(hab_policy_grid(df, label, probabilities, **options)).first()
    if row is None or row["h_threshold"] is None:
        return {"strategy": "argmax"}
    names = ("h_threshold", "b_threshold", "predicted_b_rate", "balanced_accuracy", "b_recall", "macro_f1")
    return {"strategy": "hab_threshold", "fallback_label": "A", **{n: row[n] for n in names},
            "min_predicted_b_rate": options.get("min_b_share", 0.03)}


def h_threshold_grid(
    df: DataFrame, label: str, h: str, a: str, b: str, thresholds: Sequence[float] = tuple(v.STAGE_H_THRESHOLDS)
) -> DataFrame:
    """Balanced accuracy and macro F1 of the two-stage rule per H threshold, in one pass."""
    ts = sorted(thresholds)
    zero = F.lit(0.0)
    pa, pb, ph = (F.coalesce(named(c).cast("double"), zero) for c in (a, b, h))
    counts = df.groupBy(
        named(label).cast("string").alias("actual"), _place(ph, ts).alias("place"),
        F.when(pa >= pb, "A").otherwise("B").alias("rest"),
    ).agg(F.count("*").alias("n"))
    grid = _literal_rows(["cell", "level", "h_threshold"], [(i, i + 1, float(t)) for i, t in enumerate(ts)])
    said = F.when(F.col("place") >= F.col("level"), "H").otherwise(F.col("rest"))
    pairs = (
        counts.withColumn("g", grid).select("actual", "place", "rest", "n", "g.*").withColumn("predicted", said)
        .groupBy("cell", "h_threshold", "actual", "predicted").agg(F.sum("n").alias("n"))
    )
    return score_pairs(pairs, ["cell", "h_threshold"]).select("cell", "h_threshold", "balanced_accuracy", "macro_f1")


def tune_h_threshold(df: DataFrame, label: str, h: str, a: str, b: str, **options) -> dict:
    row = _best(h_threshold_grid(df, label, h, a, b, **options), ["balanced_accuracy", "macro_f1"], "cell").first()
    if row is None or row["h_threshold"] is None:
        return {"strategy": "two_stage_threshold", "h_threshold": 0.5, "metrics": {}}
    return {"strategy": "two_stage_threshold", "h_threshold": row["h_threshold"],
            "metrics": {"balanced_accuracy": row["balanced_accuracy"], "macro_f1": row["macro_f1"]}}
