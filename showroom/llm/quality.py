"""Quality classifier: evidence of the document and hierarchical empirical Bayes over host and path.

The document classifier is a logistic regression over a dozen shape features (how words repeat, capitals, symbols,
digits, lengths), fitted on a bounded sample of the labelled rows.

All labelled rows give counts of good and of all documents by path and by host. The rate of a host is shrunk toward the
rate of all, and that of a path toward its host's: ``(good + m * parent) / (n + m)``. The strength ``m`` of each level is
estimated from how much the rates of its groups differ beyond chance, by grouped aggregation. So a sparse site
says little, and one without labels says what its parent says.

A document's log-odds are those of its path and the log-likelihood ratio of the classifier, which is its own log-odds
less those of its training rows. A document goes only if it is bad with odds of more than three to one: losing a good one is
the worse mistake.

Without URLs the source stands for the host, and source and language for the path.

Defined cases: a null or blank text has features of zero and is judged as such; a null host or path is a group of its
own; rows without label are judged only; several labels of one id count as their mean; repeated rows count as often as
they stand there; without any labels every document has an even chance and is kept; other columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom.llm.shared import exact, fresh, hash_sample, with_fields, written
from showroom.llm.words import SPACES, separator_table, slices, words_of

#: Bound of the labelled rows that the document classifier is fitted on.
TRAINING_ROWS = 20_000
#: Least probability of being good with which a document stays.
KEEP = 0.25
RIDGE = 1.0
STEPS = 30
#: Bounds of the strength with which a level's groups are shrunk.
STRENGTH = (1.0, 10_000.0)

FEATURES = [
    "log_words", "word_length", "word_length_spread", "new_words", "new_pairs", "commonest_word", "repeats", "capitals", "symbol_words",
    "bare_symbols", "symbols", "digits", "beyond_ascii", "line_length"]


def _share(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of the values of each document; 0 without any."""
    kind = np.int64 if values.dtype == bool else np.float64
    sums = np.concatenate([np.zeros(1, kind), np.cumsum(values, dtype=kind)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for every text."""
    words = words_of(texts, separator_table(SPACES))
    n, bounds, offsets = words.count(), words.bounds, words.offsets
    data = words.data_as_given
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, wide = (data >= 48) & (data <= 57), data >= 128
    symbol = ~(upper | lower | digit | wide | separator_table(SPACES)[data])
    before = lambda mask: np.concatenate([np.zeros(1, np.int32), np.cumsum(mask, dtype=np.int32)])
    in_word = lambda sums: sums[words.ends] - sums[words.starts]
    uppers, lowers, symbols, wides = in_word(before(upper)), in_word(before(lower)), in_word(before(symbol)), in_word(before(wide))
    length = words.ends - words.starts
    capital = (uppers >= 2) & (lowers == 0)
    codes = words.codes.astype(np.int64)
    follows = np.zeros(len(codes), dtype=bool)
    follows[1:] = codes[1:] == codes[:-1]
    follows[bounds[:-1][bounds[:-1] < len(codes)]] = False  # the word before is another text's
    pairs = np.concatenate([codes[:-1] * (codes.max() + 1) + codes[1:], codes[:1]]) if len(codes) else codes
    distinct, distinct_pairs, commonest = np.zeros((3, len(n)))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            often = np.unique(codes[a:b], return_counts=True)[1]
            distinct[i], commonest[i] = len(often), often.max()
            distinct_pairs[i] = len(np.unique(pairs[a : b - 1])) if b - a > 1 else 1
    some = np.maximum(n, 1)
    mean = _share(length, bounds)
    spread = np.sqrt(np.maximum(_share(length.astype(np.float64) ** 2, bounds) - mean**2, 0))
    size = np.maximum(np.diff(offsets), 1)
    lines = _share(data == 10, offsets) * size + 1
    return np.stack([
        np.log1p(n), mean, spread, distinct / some, distinct_pairs / np.maximum(n - 1, 1), commonest / some, _share(follows, bounds), _share(capital, bounds),
        _share(symbols >= 2, bounds), _share((symbols > 0) & (uppers + lowers + wides == 0), bounds), _share(symbol, offsets), _share(digit, offsets), _share(wide, offsets),
        np.log1p(n / lines)], axis=1)


@dataclass
class Classifier:
    """Log-odds are ``bias + (features - mean) / spread @ weights``; ``base`` are those of the training rows."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.bias + ((x - self.mean) / self.spread) @ self.weights


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> Classifier:
    """Ridge logistic regression by Newton's method, of labels between 0 and 1."""
    n, k = x.shape
    if n == 0:
        return Classifier(np.zeros(k), np.ones(k), np.zeros(k), 0.0, 0.0)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    z = np.concatenate([np.ones((n, 1)), (x - mean) / spread], axis=1)
    rate = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    w, penalty = np.zeros(k + 1), np.full(k + 1, ridge)
    w[0], penalty[0] = base, 1e-6
    loss = lambda w: np.logaddexp(0, z @ w).sum() - y @ (z @ w) + penalty @ w**2 / 2
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), slope)
        now, size = loss(w), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Classifier(mean, spread, w[1:], float(w[0]), base)


def _labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    rows = labels.select(exact(doc_id).alias("label_id"), exact(label).cast("double").alias("y"))
    return rows.where("label_id IS NOT NULL AND y IS NOT NULL").groupBy("label_id").agg(F.avg("y").alias("y"))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAINING_ROWS,
) -> Classifier:
    """Fit on about ``rows`` labelled documents, chosen by a hash of their id. The labels of these are broadcast.

    Rows of one id count once for each text; should they make more than ``rows``, a hash chooses among them as well.
    """
    sample = hash_sample(written(_labels(labels, doc_id, label), "quality-labels"), F.col("label_id"), rows)
    chosen = docs.select(exact(doc_id).alias("doc_id"), exact(text).cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                x = pa.array(list(features(batch["text"])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.string()), batch["y"], x], names=["doc_id", "y", "x"])

    measured = written(chosen.mapInArrow(run, "doc_id string, y double, x array<double>").distinct(), "quality-features")
    # A row of a dozen numbers per document of the sample.
    found = hash_sample(measured, F.struct("doc_id", "x"), 2 * rows).toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    x = np.array(found["x"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, found["y"].to_numpy())


def _strength(groups: DataFrame, parent: str) -> Column:
    """Strength of the prior of rows (n, good, parent): by moments of the rates around their parent's."""
    rate, p = F.col("good") / F.col("n"), F.col(parent)
    weight = F.sum("n")
    # Expected: sum n (rate - p)^2 = sum p (1 - p) (1 + (n - 1) rho), where m = 1 / rho - 1.
    excess = F.sum(F.col("n") * (rate - p) ** 2) - F.sum(p * (1 - p))
    room = F.sum(p * (1 - p) * (F.col("n") - 1))
    rho = F.when(room > 0, excess / room).otherwise(F.lit(0.0))
    low, high = STRENGTH
    m = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(high))
    return F.when(weight > 0, F.least(F.greatest(m, F.lit(low)), F.lit(high))).otherwise(F.lit(high))


def posteriors(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """Rows (host, path, rate) of every host and path with labelled documents, and (host, null path mark, rate) of hosts.

    ``level`` is 2 for paths, 1 for hosts and 0 for the one row of all. The table is stored, so its size is known.
    """
    places = docs.select(exact(doc_id).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    known = places.join(_labels(labels, doc_id, label), F.col("doc_id") == F.col("label_id"))
    paths = written(known.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("good")), "quality-counts")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    all_ = hosts.agg(((F.coalesce(F.sum("good"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1)).alias("rate")).first()["rate"]
    hosts = hosts.withColumn("all", F.lit(all_))
    m = hosts.agg(_strength(hosts, "all").alias("m")).first()["m"]
    hosts = hosts.select("host", ((F.col("good") + m * all_) / (F.col("n") + m)).alias("rate"))
    of_host = hosts.select(F.col("host").alias("h"), F.col("rate").alias("of_host"))
    paths = paths.join(of_host, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    m = paths.agg(_strength(paths, "of_host").alias("m")).first()["m"]
    paths = paths.select("host", "path", ((F.col("good") + m * F.col("of_host")) / (F.col("n") + m)).alias("rate"))
    none = F.lit(None).cast("string")
    table = paths.withColumn("level", F.lit(2)).unionByName(hosts.withColumn("path", none).withColumn("level", F.lit(1)))
    spark = docs.sparkSession
    table = table.unionByName(spark.createDataFrame([(None, None, all_, 0)], "host string, path string, rate double, level int"))
    return written(table, "quality-posteriors")


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    host: str = "source", path: str = "lang", keep: float = KEEP, result: str = "quality", rows: int = TRAINING_ROWS,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``result``: document, host, path, score, kept.

    ``document`` is the classifier's probability, ``host`` and ``path`` are the posterior rates, ``score`` is the combined
    probability of a good document. Texts are not shuffled as long as the table of posteriors is small enough
    for Spark to broadcast. A name that ``docs`` has already is lengthened by ``_``.
    """
    result = fresh(docs.columns, result)
    model = train(docs, labels, doc_id, text, label, rows)
    rates = posteriors(docs, labels, exact(host), exact(path), doc_id, label)
    all_ = rates.where("level = 0").first()["rate"]
    columns = docs.columns
    odds, h1, h2, p2, r1, r2 = (fresh(columns, f"quality_{n}") for n in ("odds", "h1", "h2", "p2", "r1", "r2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                yield with_fields(batch, [(odds, pa.array(model.log_odds(features(batch[text]))))])

    out = docs.mapInArrow(run, T.StructType(list(docs.schema)).add(odds, T.DoubleType()))
    hosts = rates.where("level = 1").select(F.col("host").alias(h1), F.col("rate").alias(r1))
    paths = rates.where("level = 2").select(F.col("host").alias(h2), F.col("path").alias(p2), F.col("rate").alias(r2))
    here, there = exact(host).cast("string"), exact(path).cast("string")
    out = out.join(hosts, here.eqNullSafe(F.col(h1)), "left").join(paths, here.eqNullSafe(F.col(h2)) & there.eqNullSafe(F.col(p2)), "left")
    of_host = F.coalesce(F.col(r1), F.lit(all_))
    of_path = F.coalesce(F.col(r2), of_host)
    logistic = lambda x: 1 / (1 + F.exp(-x))
    total = F.log(of_path / (1 - of_path)) + F.col(odds) - F.lit(model.base)
    value = F.struct(
        logistic(F.col(odds)).alias("document"), of_host.alias("host"), of_path.alias("path"), logistic(total).alias("score"),
        (logistic(total) >= keep).alias("kept"))
    return out.select(*[exact(c) for c in columns], value.alias(result))


def good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without what is judged bad; the columns stay."""
    result = fresh(docs.columns, "quality")
    judged = judge(docs, labels, result=result, **options)
    return judged.where(F.col(result)["kept"]).drop(result)
