"""URL filter: rules, and gradient-boosted trees on lexical features where no rule speaks. DataFrame functions only.

Features: lengths, depth, share and runs of digits, entropy of the characters, counts of parameters, labels and signs, and
statistics of the host's suffixes (how often URLs of the last one and two labels are allowed, shrunk toward all, and how
many were seen). The statistics count all labelled URLs, and the trees are trained on a bounded sample of them; here the URLs that
a rule decides are the labelled ones. A labelled URL is left out of its own suffix statistics.

A rule (verdict, host, path) fits its host and all subdomains, if the URL's path starts with the rule's path. Of those that
fit, the longest wins (the first of several equally long).

Defined cases: host and path of null, of an empty text or of one without ``://`` are empty, and such URLs are judged by their
features; without labelled URLs everything without rule is allowed; with one verdict only, that one holds; repeated
rows count as often as they stand there; other columns pass through whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom.llm.shared import exact, fresh, hash_sample, written

ALLOW, BLOCK = "allow", "block"
#: Bound of the labelled URLs that the trees are trained on.
TRAINING_ROWS = 20_000
TREES = 20
DEPTH = 4
SEED = 7
#: Labelled URLs of the average rate that every suffix starts with.
PRIOR = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_share", "host_digits", "longest_digits", "entropy",
    "parameters", "hyphens", "dots_in_path", "longest_segment", "secure", "suffix1_rate", "suffix1_seen", "suffix2_rate", "suffix2_seen"]


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule], value: str = "text") -> Column:
    """Text or verdict of the rule that holds, or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the text itself."""
    text = F.coalesce(url, F.lit(""))
    length = F.length(text)
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x)))
    chars = F.array_distinct(F.split(text, ""))
    share = lambda c: (length - F.length(F.replace(text, c))) / length
    entropy = F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c)))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = F.regexp_replace(text, r"[^0-9]", "")
    longest = lambda parts: F.coalesce(F.array_max(F.transform(parts, F.length)), F.lit(0))
    values = {
        "url_length": length, "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")), "labels": F.size(F.split(host, r"\.")),
        "digit_share": F.length(digits) / F.greatest(length, F.lit(1)), "host_digits": F.length(F.regexp_replace(host, r"[^0-9]", "")),
        "longest_digits": longest(F.split(text, r"[^0-9]+")), "entropy": F.when(length > 0, entropy).otherwise(0.0),
        "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1), "hyphens": count(text, "-"), "dots_in_path": count(path, "."),
        "longest_segment": longest(F.split(path, "/")), "secure": F.startswith(text, F.lit("https")).cast("int")}
    return {k: v.cast("double") for k, v in values.items()}


def suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


@dataclass
class Filter:
    """Trees (none: ``only`` holds), the average rate, and suffix tables (suffix, n, good), stored and so of known size."""

    trees: PipelineModel | None
    only: str
    rate: float
    suffixes: list[DataFrame]


def _with_suffixes(rows: DataFrame, suffixes: list[DataFrame], rate: float, own: Column | None = None) -> DataFrame:
    """Add the suffix features to rows with ``host``; ``own`` is the label to leave out again."""
    for labels, table in enumerate(suffixes, 1):
        key, n, good = f"key{labels}", F.coalesce(f"n{labels}", F.lit(0)), F.coalesce(f"good{labels}", F.lit(0.0))
        rows = rows.join(table.select(F.col("suffix").alias(key), F.col("n").alias(f"n{labels}"), F.col("good").alias(f"good{labels}")), suffix(F.col("host"), labels) == F.col(key), "left")
        seen = n - (0 if own is None else 1)
        rows = rows.withColumn(f"suffix{labels}_rate", (good - (0 if own is None else own) + PRIOR * rate) / (seen + PRIOR))
        rows = rows.withColumn(f"suffix{labels}_seen", F.log1p(seen.cast("double"))).drop(key, f"n{labels}", f"good{labels}")
    return rows


def train(urls: DataFrame, url: str = "url", label: str = "allowed", rows: int = TRAINING_ROWS, trees: int = TREES, depth: int = DEPTH) -> Filter:
    """Learn from the URLs with a label (1: allow, 0: block, null: none): rate and suffix tables from all of them, trees from about ``rows``.

    A hash of the URL chooses the rows for the trees.
    """
    known = urls.select(exact(url).cast("string").alias("url"), exact(label).cast("double").alias("label")).where("label IS NOT NULL")
    known = known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    known = written(known, "url-labels")
    row = known.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(1.0)).alias("rate")).first()
    suffixes = [
        written(known.groupBy(suffix(F.col("host"), k).alias("suffix")).agg(F.count("*").alias("n"), F.sum("label").alias("good")), "url-suffixes")
        for k in (1, 2)]
    if row["rate"] in (0.0, 1.0):
        return Filter(None, ALLOW if row["rate"] else BLOCK, row["rate"], suffixes)
    chosen = hash_sample(known, F.col("url"), rows)
    if chosen.isEmpty():  # few URLs, repeated many times
        chosen = known.orderBy(F.xxhash64("url", F.lit("sample")), "url", "label").limit(rows)
    data = chosen.withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
    data = written(_with_suffixes(data, suffixes, row["rate"], F.col("label")).select("label", *FEATURES), "url-features")
    # The order of rows must not depend on the partitioning.
    data = data.coalesce(1).sortWithinPartitions("label", *FEATURES)
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=32, seed=SEED, subsamplingRate=1.0)]
    return Filter(Pipeline(stages=stages).fit(data), ALLOW, row["rate"], suffixes)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", result: str = "url_verdict", **options) -> DataFrame:
    """All columns of ``pages`` and a struct ``result``: host, path, rule, verdict.

    A name that ``pages`` has already is lengthened by ``_``.
    """
    result = fresh(pages.columns, result)
    given = exact(url).cast("string")
    host, path = host_of(given), path_of(given)
    verdict = rule_of(host, path, rules, "verdict")
    model = train(pages.select(exact(url).alias("url"), (verdict == ALLOW).cast("double").alias("allowed")), **options)
    # The page's own columns go along inside one struct, apart from the names used here.
    page = F.struct(*[exact(c) for c in pages.columns])
    rows = pages.select(
        page.alias("page"), given.alias("url"), host.alias("host"), path.alias("path"), rule_of(host, path, rules).alias("rule"), verdict.alias("ruled"))
    decided = rows.where("ruled IS NOT NULL").withColumn("verdict", F.col("ruled"))
    left = rows.where("ruled IS NULL")
    if model.trees is None:
        left = left.withColumn("verdict", F.lit(model.only))
    else:
        left = left.withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
        left = model.trees.transform(_with_suffixes(left, model.suffixes, model.rate))
        left = left.withColumn("verdict", F.when(F.col("prediction") == 1, ALLOW).otherwise(BLOCK))
    keep = ["page", "host", "path", "rule", "verdict"]
    out = decided.select(*keep).union(left.select(*keep))
    value = F.struct("host", "path", "rule", "verdict")
    return out.select(*[F.col("page")[c].alias(c) for c in pages.columns], value.alias(result))
