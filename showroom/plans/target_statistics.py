"""Target statistics: a text column as the shares of the classes among the rows with the same value.

A training row must not see its own label. Its fold, a hash of the columns that name the row, decides: its shares come from the rows of the
other folds, and so does the overall share they shrink to. A new row gets the shares of all training rows. A value seen in n rows
counts n against ``strength`` rows of the overall share; one never seen has that share.

The fit is one grouped aggregation over (column, value, fold), whatever the number of columns and of labels. It leaves a stored table with a row per value, in
which the shares without each of the folds are ready; encoding is a look-up by value, whose small side Spark broadcasts if its bytes allow. Every
value has a row of its own, so values never merge.

Defined cases: missing text is a value of its own, as is empty text, which equals it; rows without a label are left out of the fit; a fold with all
rows leaves no others, and the shares without it are equal for all classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.functions.cells import named
from showroom.session import hand_over
from showroom.sources.stores import read_sidecar, write_sidecar

FOLDS = 5
#: Rows of the overall share that every value starts with.
STRENGTH = 10.0
BREAK, FOLD, CLASS = "\x1f", "__fold_of_row", "__class_of_row"


def text_of(column: str) -> Column:
    return F.coalesce(named(column).cast("string"), F.lit(""))


def fold_of(by: Sequence[str], folds: int = FOLDS) -> Column:
    """Fold of a row: the first 32 bits of the MD5 of the columns that name it."""
    name = F.concat_ws(BREAK, *[text_of(c) for c in by])
    return (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


@dataclass
class TargetStatistics:
    """``table`` has rows (feature, value, n, shares, n_without, shares_without): over all folds, and without each of them."""

    texts: list[str]
    classes: list[str]
    by: list[str]
    folds: int
    prior: list[float]
    table: DataFrame

    @property
    def told(self) -> list[int]:
        """Places of the classes that become columns; of two classes, one says all."""
        return list(range(len(self.classes))) if len(self.classes) > 2 else [len(self.classes) - 1]

    def names(self, i: int, prefix: str = "__s") -> list[str]:
        return [f"{prefix}{i}_{c}" for c in self.told]

    def encode(self, df: DataFrame, training: bool = False, counts: str | None = None, prefix: str = "__s") -> DataFrame:
        """The rows with a column per text column and class; ``counts`` is the prefix of columns with the rows behind the shares."""
        if training:
            df = df.withColumn(FOLD, fold_of(self.by, self.folds))  # once a row, not once a look-up
        for i, column in enumerate(self.texts):
            n, shares = ("n_without", "shares_without") if training else ("n", "shares")
            found = self.table.where(F.col("feature") == i).select(
                F.col("value").alias(f"__value{i}"), F.col(n).alias(f"__n_of{i}"), F.col(shares).alias(f"__shares{i}"))
            df = df.join(found, text_of(column) == F.col(f"__value{i}"), "left")
            n, shares = F.col(f"__n_of{i}"), F.col(f"__shares{i}")
            if training:
                n, shares = F.get(n, F.col(FOLD)), F.get(shares, F.col(FOLD))
            new = {name: F.coalesce(F.get(shares, F.lit(c)), F.lit(self.prior[c])) for name, c in zip(self.names(i, prefix), self.told)}
            if counts is not None:
                new[f"{counts}{i}"] = F.coalesce(n, F.lit(0).cast("bigint"))
            df = df.withColumns(new).drop(f"__value{i}", f"__n_of{i}", f"__shares{i}")
        return df.drop(FOLD)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/table")
        write_sidecar(spark, f"{path}/metadata", {
            "texts": self.texts, "classes": self.classes, "by": self.by, "folds": self.folds, "prior": self.prior})

    @staticmethod
    def load(spark: SparkSession, path: str) -> TargetStatistics:
        meta = read_sidecar(spark, f"{path}/metadata")
        if meta is None:
            raise FileNotFoundError(f"no target statistics at {path}")
        return TargetStatistics(**meta, table=spark.read.parquet(f"{path}/table"))


def _numbers(values: Sequence) -> Column:
    return F.array(*[F.lit(x) for x in values])


def _sum(n: Column) -> Column:
    return F.aggregate(n, F.lit(0).cast("bigint"), lambda s, x: s + x)


def fit(
    rows: DataFrame, label: str, texts: Sequence[str], classes: Sequence[str], by: Sequence[str], folds: int = FOLDS, strength: float = STRENGTH,
) -> TargetStatistics:
    """``by``: the columns that name a row, such as its id; rows that agree in them share a fold."""
    return fit_together(rows, {label: classes}, texts, by, folds, strength).each[label]


@dataclass
class Together:
    """Statistics of several labels over the same rows and columns. ``table`` has a row per value with those of all labels, and the counts they come from."""

    each: dict[str, TargetStatistics]
    table: DataFrame

    def _told(self, fold: Column) -> Column:
        """Shares without a fold, label by label."""
        parts = []
        for i, found in enumerate(self.each.values()):
            shares = F.get(F.col(f"shares_without{i}"), fold)
            parts += [F.coalesce(F.get(shares, F.lit(c)), F.lit(found.prior[c])) for c in found.told]
        return F.array(*parts)

    def encode(self, df: DataFrame, prefix: str = "__a") -> DataFrame:
        """Training rows with an array per text column: its shares for one label after the other. One look-up a column serves all labels."""
        first = next(iter(self.each.values()))
        default = F.array(*[F.lit(found.prior[c]) for found in self.each.values() for c in found.told])
        df = df.withColumn(FOLD, fold_of(first.by, first.folds))
        by_fold = F.array(*[self._told(F.lit(f)) for f in range(first.folds)])
        for i, column in enumerate(first.texts):
            found = self.table.where(F.col("feature") == i).select(F.col("value").alias(f"__value{i}"), by_fold.alias(f"__shares{i}"))
            df = df.join(found, text_of(column) == F.col(f"__value{i}"), "left")
            df = df.withColumn(f"{prefix}{i}", F.coalesce(F.get(F.col(f"__shares{i}"), F.col(FOLD)), default)).drop(f"__value{i}", f"__shares{i}")
        return df.drop(FOLD)

    def look_up(self, df: DataFrame, labels: Sequence[str], prefix: str = "__a") -> DataFrame:
        """New rows with an array per text column: the shares for the labels named, one after the other."""
        places = {label: i for i, label in enumerate(self.each)}
        told = [(places[label], c) for label in labels for c in self.each[label].told]
        default = F.array(*[F.lit(self.each[label].prior[c]) for label in labels for c in self.each[label].told])
        shares = F.array(*[F.get(F.col(f"shares{i}"), F.lit(c)) for i, c in told])
        for i, column in enumerate(next(iter(self.each.values())).texts):
            found = self.table.where(F.col("feature") == i).select(F.col("value").alias(f"__value{i}"), shares.alias(f"__shares{i}"))
            df = df.join(found, text_of(column) == F.col(f"__value{i}"), "left")
            df = df.withColumn(f"{prefix}{i}", F.coalesce(F.col(f"__shares{i}"), default)).drop(f"__value{i}", f"__shares{i}")
        return df

    def weighted(self, weights: Sequence[Sequence[float]]) -> DataFrame:
        """Rows (f, x, w): a column's number, the shares that training rows of one value and fold have, and the weight of these rows by label."""
        of_fold = self.table.select("*", F.explode("folds").alias("fold", "cell"))
        w, start = [], 0
        for of_label in weights:
            total = F.lit(0.0)
            for c, x in enumerate(of_label):
                total = total + F.get("cell", F.lit(start + c)) * F.lit(float(x))
            w.append(total)
            start += len(of_label)
        return of_fold.select(F.col("feature").alias("f"), self._told(F.col("fold")).alias("x"), F.array(*w).alias("w"))


def fit_together(
    rows: DataFrame, labels: dict[str, Sequence[str]], texts: Sequence[str], by: Sequence[str], folds: int = FOLDS, strength: float = STRENGTH,
) -> Together:
    """One grouped aggregation for all labels; ``labels`` has the classes of each. A row counts for the labels that it has."""
    if not texts:
        raise ValueError("no text column")
    texts, labels = list(texts), {label: list(classes) for label, classes in labels.items()}
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), text_of(c).alias("value")) for i, c in enumerate(texts)]))
    # Classes and fold are made before the explosion, once a row.
    of_class = {label: named(label).cast("string") for label in labels}
    has_class = F.lit(False)
    for label, classes in labels.items():
        has_class = has_class | F.coalesce(of_class[label].isin(classes), F.lit(False))
    names = {label: f"{CLASS}{i}" for i, label in enumerate(labels)}
    known = rows.where(has_class).withColumns({names[label]: of_class[label] for label in labels} | {FOLD: fold_of(by, folds)})
    known = known.select(*names.values(), F.col(FOLD).alias("fold"), cells.alias("cell"))
    by_class = [F.count_if(F.col(names[label]) == c) for label, classes in labels.items() for c in classes]
    counted = hand_over(known.groupBy("cell.feature", "cell.value", "fold").agg(F.array(*by_class).alias("n")), "fold-counts")

    # A row per fold: every row has one cell of the first column.
    width = len(by_class)
    sums = counted.where("feature = 0").groupBy("fold").agg(*[F.sum(F.get("n", F.lit(c))).alias(f"n{c}") for c in range(width)])
    in_fold = [[0] * width for _ in range(folds)]
    for r in sums.collect():
        in_fold[r["fold"]] = [r[f"n{c}"] for c in range(width)]
    share = lambda n: [x / sum(n) for x in n] if sum(n) else [1 / len(n)] * len(n)

    none = F.array(*[F.lit(0).cast("bigint")] * width)
    shrunk = lambda n, prior: F.zip_with(n, prior, lambda x, p: (x + p * strength) / (_sum(n) + strength))
    values = counted.groupBy("feature", "value").agg(F.map_from_entries(F.collect_list(F.struct("fold", "n"))).alias("folds"))  # one entry per fold
    values = values.withColumn("all", F.aggregate(F.map_values("folds"), none, lambda s, x: F.zip_with(s, x, lambda a, b: a + b)))
    others = lambda f: F.zip_with("all", F.coalesce(F.try_element_at("folds", f), none), lambda a, b: a - b)
    values = values.withColumn("without", F.array(*[others(F.lit(f)) for f in range(folds)]))
    columns, priors, start = [], {}, 0
    for i, (label, classes) in enumerate(labels.items()):
        mine = slice(start, start + len(classes))
        own = lambda n, at=start, size=len(classes): F.slice(n, at + 1, size)
        whole = [sum(f[c] for f in in_fold) for c in range(width)][mine]
        priors[label] = share(whole)
        rest = [share([w - x for w, x in zip(whole, f[mine], strict=True)]) for f in in_fold]
        columns += [
            _sum(own(F.col("all"))).alias(f"n{i}"), shrunk(own(F.col("all")), _numbers(priors[label])).alias(f"shares{i}"),
            F.array(*[_sum(own(F.get("without", F.lit(f)))) for f in range(folds)]).alias(f"n_without{i}"),
            F.array(*[shrunk(own(F.get("without", F.lit(f))), _numbers(rest[f])) for f in range(folds)]).alias(f"shares_without{i}")]
        start += len(classes)
    table = hand_over(values.select("feature", "value", "folds", *columns), "target-statistics")
    each = {}
    for i, (label, classes) in enumerate(labels.items()):
        view = table.where(F.col(f"n{i}") > 0).select("feature", "value", *[F.col(f"{c}{i}").alias(c) for c in ("n", "shares", "n_without", "shares_without")])
        each[label] = TargetStatistics(texts, classes, list(by), folds, priors[label], view)
    return Together(each, table)
