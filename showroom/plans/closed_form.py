"""A model family with a closed form: naive Bayes over the cells of a row.

A cell is a column with its text, or with the part of its column's range that a number falls into (borders are exact quantiles of the
training rows). One grouped aggregation counts cells by class; smoothed shares of these counts are the whole model. It is a stored table of
(feature, value, logarithms by class), which scoring looks up column by column: a value's row is found by a join whose small side
Spark broadcasts if its bytes allow, and a value that was never seen has the share that smoothing leaves for it.

Missing cells are values of their own. The fit passes over the rows twice, whatever the number of columns and classes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.functions.cells import named
from showroom.operators import contract as ct
from showroom.operators.ordering import exact_quantiles
from showroom.plans.training import FeatureKinds, LeadModel
from showroom.session import hand_over
from showroom.sources.stores import write_sidecar

FAMILY = "NaiveBayes"
SMOOTHING = 1.0
#: Parts of a number's range.
BINS = 10
#: Digits of a sum of logarithms: what sums to the same in another order is the same.
DIGITS = 9


def cell(kinds: FeatureKinds, borders: dict[str, list[float]], column: str) -> Column:
    """The value of a column as text; missing is empty. A number is the count of borders below it."""
    if column in kinds.texts:
        return F.coalesce(named(column).cast("string"), F.lit(""))
    x = named(column).cast("double")
    place = F.lit(0)
    for border in borders[column]:
        place = place + F.when(x > border, 1).otherwise(0)
    return F.when(x.isNull() | F.isnan(x), "").otherwise(place.cast("string"))


@dataclass
class ClosedFormModel(LeadModel):
    """``table`` has rows (feature, value, logs), ``unseen`` the logarithms by feature and class of values not in it."""

    table: DataFrame | None = None
    unseen: list[list[float]] = field(default_factory=list)
    prior: list[float] = field(default_factory=list)
    borders: dict[str, list[float]] = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)

    def probabilities(self, df: DataFrame, prefix: str = "p_") -> DataFrame:
        """The rows with one probability column per class."""
        ct.align_to_features(df, self.features)
        out = df
        totals = [F.lit(p) for p in self.prior]
        for i, column in enumerate(self.features):
            logs = self.table.where(F.col("feature") == i).select(F.col("value").alias(f"__value{i}"), F.col("logs").alias(f"__logs{i}"))
            out = out.join(logs, cell(self.kinds, self.borders, column) == F.col(f"__value{i}"), "left").drop(f"__value{i}")
            totals = [t + F.coalesce(F.get(f"__logs{i}", F.lit(c)), F.lit(self.unseen[i][c])) for c, t in enumerate(totals)]
        out = out.withColumn("__totals", F.array(*[F.round(t, DIGITS) for t in totals]))
        out = out.withColumn("__weights", F.transform("__totals", lambda t: F.exp(t - F.array_max("__totals"))))
        sum_ = F.aggregate("__weights", F.lit(0.0), lambda s, x: s + x)
        out = out.withColumns({f"{prefix}{c}": F.get("__weights", F.lit(i)) / sum_ for i, c in enumerate(self.classes)})
        return out.drop("__totals", "__weights", *[f"__logs{i}" for i in range(len(self.features))])

    def importances(self) -> dict[str, float]:
        """Share of each column in what all columns tell about the class (mutual information); largest first."""
        return dict(sorted(self.shares.items(), key=lambda kv: (-kv[1], kv[0])))

    def save(self, spark: SparkSession, path: str, **extra) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/table")
        write_sidecar(spark, f"{path}/metadata", {
            "label": self.label, "classes": self.classes, "features": self.features, "family": self.family, "heads": 0,
            "problem_type": "binary" if len(self.classes) == 2 else "multiclass", "kinds": [self.kinds.numbers, self.kinds.texts, self.kinds.fills],
            "info": self.info, "spread": None, "unseen": self.unseen, "prior": self.prior, "borders": self.borders, "shares": self.shares, **extra})

    @staticmethod
    def restore(spark: SparkSession, path: str, meta: dict) -> ClosedFormModel:
        return ClosedFormModel(
            meta["label"], meta["classes"], meta["features"], FeatureKinds(*meta["kinds"]), meta["family"], None, [], meta["info"],
            table=spark.read.parquet(f"{path}/table"), unseen=meta["unseen"], prior=meta["prior"], borders=meta["borders"], shares=meta["shares"])


def fit(
    rows: DataFrame, label: str, kinds: FeatureKinds, classes: Sequence[str], counts: dict[str, int], balance: bool = True,
    smoothing: float = SMOOTHING, bins: int = BINS,
) -> ClosedFormModel:
    """``counts``: rows per class of the training rows ``rows``."""
    features, classes = kinds.numbers + kinds.texts, list(classes)
    borders: dict[str, list[float]] = {c: [] for c in kinds.numbers}
    if kinds.numbers:
        marks = [i / bins for i in range(1, bins)]
        for r in exact_quantiles(rows, kinds.numbers, marks).collect():  # ``bins`` rows per column at most
            if r["quantile"] is not None and not math.isnan(r["quantile"]):
                borders[r["column"]].append(float(r["quantile"]))
        borders = {c: sorted(set(b)) for c, b in borders.items()}
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), cell(kinds, borders, c).alias("value")) for i, c in enumerate(features)]))
    of_class = named(label).cast("string")
    counted = rows.select(of_class.alias("class"), cells.alias("cell")).groupBy("cell.feature", "cell.value").agg(
        F.array(*[F.count_if(F.col("class") == c) for c in classes]).alias("n"))
    counted = hand_over(counted, "cells")

    sizes = [counts.get(c, 0) for c in classes]
    total = sum(sizes)
    # What a value tells: sum over classes of n / total * log(n * total / (all of the value * all of the class)).
    whole = F.aggregate("n", F.lit(0).cast("bigint"), lambda s, x: s + x)
    told = F.lit(0.0)
    for i, size in enumerate(sizes):
        x = F.get("n", F.lit(i)).cast("double")
        told = told + F.when(x > 0, x / total * F.log(x * total / (whole * size))).otherwise(0.0)
    facts = {r["feature"]: r for r in counted.groupBy("feature").agg(F.count("*").alias("values"), F.sum(told).alias("told")).collect()}
    values = [facts[i]["values"] if i in facts else 0 for i in range(len(features))]
    room = [[size + smoothing * (v + 1) for size in sizes] for v in values]
    logs = F.array(*[
        F.log((F.get("n", F.lit(c)) + smoothing) / F.get(F.element_at(F.array(*[F.array(*map(F.lit, r)) for r in room]), F.col("feature") + 1), F.lit(c)))
        for c in range(len(classes))])
    table = hand_over(counted.select("feature", "value", logs.alias("logs")), "closed-form")
    unseen = [[math.log(smoothing / x) for x in r] for r in room]
    prior = [math.log(1 / len(classes) if balance else max(size, smoothing) / total) for size in sizes]
    sum_ = sum(max(0.0, facts[i]["told"]) for i in facts) or 1.0
    shares = {c: max(0.0, facts[i]["told"]) / sum_ if i in facts else 0.0 for i, c in enumerate(features)}
    return ClosedFormModel(label, classes, features, kinds, FAMILY, None, [], table=table, unseen=unseen, prior=prior, borders=borders, shares=shares)
