"""Mixing sources to target weights with DataFrame functions only.

Every document has a hash-random key, from its id. Within its source the documents stand in the order of their keys.
The range of keys is cut into slices of about ``SLICE_ROWS`` rows by the source's row count; sizes are summed by
slice, and running sums over the slices of a source give every slice the place where it begins. The slice that holds the
source's budget is sorted and summed by document, which finds the exact key of the cut. No source, however
large, meets in one task; only one row per slice does. What is taken of a document then follows from the row of its source: whole
epochs, once more below the cut, and in part at the cut. The texts are never shuffled.

Targets: the sources by code point (null last) weigh ``WEIGHTS`` in turn and share the total size. A target above
``MOST`` times its source's size stops there, and the excess is shared again by weight. That is the level at which the
sum of ``least(level * weight, MOST * size)`` is the total; it is found from running sums over the sources, one row each.

Defined cases: null and blank texts have size 0 and are taken 0 times; null is a source of its own; documents of one
key (repeated rows) stand together, and where the cut falls on them, they share what is left of the budget alike; without documents
the result is empty; other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showroom.llm.shared import exact, fresh, written

#: Weights of the sources in turn, and the most epochs of a source.
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 0
SLICE_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"
LEADING_AND_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: Keys are whole numbers below this one.
KEYS = 1 << 60


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(exact(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: str, seed: int = SEED) -> Column:
    digest = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), F.coalesce(exact(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Rows (source, n, source_size, target) from rows (source, n, source_size), one per source."""
    name = F.col("source").asc_nulls_last()
    turn = F.array(*map(F.lit, weights))
    place = F.row_number().over(Window.orderBy(name))
    rows = sizes.withColumn("w", F.element_at(turn, (place - 1) % len(weights) + 1))
    # Sources reach their limit in the order of size per weight.
    before = Window.orderBy(F.col("source_size") / F.col("w"), name).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    share = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    rows = rows.withColumn("share", share)
    # The first source that stays below its limit sets the level; the shares of those behind it are no larger.
    level = F.max(F.when(F.col("share") * F.col("w") <= most * F.col("source_size"), F.col("share"))).over(every)
    limit = (most * F.col("source_size")).cast("double")
    return rows.select("source", "n", "source_size", F.least(F.col("w") * F.coalesce(level, F.lit(0.0)), limit).alias("target"))


def cuts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Rows (source, source_size, target, epochs, cut, part), one per source, from a stored table.

    A document below the key ``cut`` is taken ``epochs + 1`` times, one at it ``epochs`` times and with ``part``
    words more, one above it ``epochs`` times.
    """
    rows = docs.select(exact(source).cast("string").alias("source"), random_key(doc_id, seed).alias("key"), word_count(text).alias("size"))
    rows = written(rows, "mix-keys")
    sizes = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, most)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    goals = written(goals, "mix-targets")

    of_source = goals.select(F.col("source").alias("s"), F.ceil(F.col("n") / slice_rows).alias("slices"), "rest")
    sliced = rows.join(of_source, F.col("source").eqNullSafe(F.col("s")))
    sliced = sliced.withColumn("slice", F.floor(F.col("key") / F.lit(KEYS) * F.col("slices")))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("sum"), F.first("rest").alias("rest"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.withColumn("begin", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    holding = begins.where("begin <= rest AND rest < begin + sum").select(
        F.col("source").alias("hs"), F.col("slice").alias("ht"), F.col("begin"))

    held = sliced.join(holding, F.col("source").eqNullSafe(F.col("hs")) & (F.col("slice") == F.col("ht")))
    held = held.groupBy("source", "slice", "key").agg(
        F.sum("size").alias("size"), F.count("*").alias("c"), F.first("rest").alias("rest"), F.first("begin").alias("begin"))
    inside = Window.partitionBy("source", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.col("begin") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = held.where("before <= rest AND rest < before + size").select(
        F.col("source").alias("hs"), F.col("key").alias("cut"), F.floor((F.col("rest") - F.col("before")) / F.col("c")).alias("part"))
    found = goals.join(at, F.col("source").eqNullSafe(F.col("hs")), "left")
    return written(found.select(
        "source", "source_size", "target", "epochs", F.coalesce("cut", F.lit(0)).alias("cut"), F.coalesce("part", F.lit(0)).alias("part")), "mix-cuts")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", result: str = "mix", seed: int = SEED, **options,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``result``: size, source_size, target, epochs, part, taken.

    A name that ``docs`` has already is lengthened by ``_``.
    """
    result = fresh(docs.columns, result)
    names = {c: fresh(docs.columns, f"mix_{c}") for c in ("source", "source_size", "target", "epochs", "cut", "part")}
    found = cuts(docs, doc_id, text, source, seed=seed, **options).select(*[F.col(c).alias(n) for c, n in names.items()])
    of = {c: F.col(n) for c, n in names.items()}
    out = docs.join(found, exact(source).cast("string").eqNullSafe(of["source"]))
    size, key = word_count(text), random_key(doc_id, seed)
    part = F.when(key < of["cut"], size).when(key == of["cut"], F.least(size, of["part"])).otherwise(F.lit(0))
    out = out.withColumn(result, F.struct(
        size.alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"), of["epochs"].alias("epochs"), part.cast("bigint").alias("part")))
    got = F.col(result)
    out = out.withColumn(result, got.withField("taken", (got["epochs"] * got["size"] + got["part"]).cast("bigint")))
    return out.drop(*names.values())


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length_column: str | None = "n_chars", **options) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and once cut to its first words for a part.

    The columns stay; ``length_column``, if there is one, counts the characters of a cut text.
    """
    columns = docs.columns
    plan, copy = fresh(columns, "mix"), fresh(columns, "mix_words")
    out = mix(docs, doc_id, text, result=plan, **options).where(F.col(plan)["taken"] > 0)
    size, part = F.col(plan)["size"], F.col(plan)["part"]
    more = F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn(copy, F.explode(F.concat(F.array_repeat(size, F.col(plan)["epochs"].cast("int")), more)))
    short = F.col(copy) < size
    words = F.regexp_extract_all(exact(text), F.lit(LEADING_AND_WORD), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col(copy).cast("int")), "")
    new = {text: F.when(short, cut).otherwise(exact(text))}
    if length_column in columns:
        kind = docs.schema[length_column].dataType
        new[length_column] = F.when(short, F.length(cut).cast(kind)).otherwise(exact(length_column))
    return out.select(*[new[c].alias(c) if c in new else exact(c) for c in columns])
