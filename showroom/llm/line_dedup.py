"""Removal of lines that many sites share, with DataFrame functions only.

Lines are trimmed and hashed. Every hash gets a HyperLogLog sketch of the sites it stands on: sketches are built inside
tasks and merge by aggregation, so a line on a third of all documents is as cheap as any other. Where the estimate is
so near to the threshold that it may be wrong (``ERRORS`` standard errors, and never less than ``NEAR``), the distinct sites are counted
exactly. Lines on ``SITES`` or more sites are boilerplate and are cut out of every document.

Only document keys, line positions and hashes travel with the lines; a text moves once, to meet the positions of its boilerplate.
Two different lines with one 64-bit hash would be taken as equal (chance about n^2 / 2^65).

Defined cases: blank lines are never boilerplate and stay; a null text has no lines and stays null; a null site counts as
no site; a line that stands on one site any number of times counts once; documents of equal id and text are treated alike, once per row;
other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom.llm.shared import exact, fresh, written

SITES = 10
#: Size of a sketch: 2 ** LOG_SIZE registers, with a relative standard error of 1.04 / sqrt(2 ** LOG_SIZE).
LOG_SIZE = 10
ERRORS = 5
NEAR = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _band(sites: int, log_size: int) -> float:
    return max(NEAR, ERRORS * 1.04 / 2 ** (log_size / 2) * sites)


def boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", sites: int = SITES, log_size: int = LOG_SIZE,
) -> DataFrame:
    """Rows (line) with the hashes of lines on ``sites`` or more sites, from a stored table."""
    lines = docs.where(exact(site).isNotNull()).select(
        exact(site).cast("string").alias("site"), F.explode(F.array_distinct(F.transform(_lines(exact(text).cast("string")), lambda x: F.trim(x)))).alias("line"))
    lines = lines.where("line <> ''").select("site", F.xxhash64("line").alias("line"))
    sketches = lines.groupBy("line").agg(F.hll_sketch_agg("site", log_size).alias("sketch"))
    band = _band(sites, log_size)
    spread = sketches.select("line", F.hll_sketch_estimate("sketch").alias("about")).where(F.col("about") >= sites - band)
    spread = written(spread, "line-spread")
    near = spread.where(F.col("about") < sites + band).select(F.col("line").alias("near"))
    pairs = lines.join(near, F.col("line") == F.col("near")).select("line", "site").distinct()
    counted = pairs.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line")
    return written(spread.where(F.col("about") >= sites + band).select("line").union(counted), "line-boilerplate")


def without_boilerplate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source", result: str = "lines",
    sites: int = SITES, log_size: int = LOG_SIZE,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``result``: n_lines, n_removed, text (of the lines that stay).

    A name that ``docs`` has already is lengthened by ``_``.
    """
    columns = docs.columns
    result = fresh(columns, result)
    common = boilerplate(docs, text, site, sites, log_size).withColumnRenamed("line", "common")
    given = exact(text).cast("string")
    places = docs.select(
        exact(doc_id).alias("doc_id"), F.xxhash64(given).alias("text_hash"),
        F.posexplode(F.transform(_lines(given), lambda x: F.xxhash64(F.trim(x)))).alias("place", "line"))
    gone = places.join(common, F.col("line") == F.col("common")).groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("gone"))
    id_, hash_, gone_ = fresh(columns, "line_id"), fresh(columns, "line_hash"), fresh(columns, "line_gone")
    gone = gone.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("gone").alias(gone_))
    out = docs.join(gone, exact(doc_id).eqNullSafe(F.col(id_)) & (F.xxhash64(given) == F.col(hash_)), "left")
    stays = F.filter(_lines(given), lambda x, i: ~F.array_contains(F.col(gone_), i))
    n = F.coalesce(F.size(_lines(given)), F.lit(0))
    value = F.struct(
        F.when(given.isNull(), 0).otherwise(n).cast("bigint").alias("n_lines"),
        F.when(F.col(gone_).isNull(), 0).otherwise(F.size(gone_)).cast("bigint").alias("n_removed"),
        F.when(F.col(gone_).isNull(), given).otherwise(F.array_join(stays, "\n")).alias("text"))
    return out.select(*[exact(c) for c in columns], value.alias(result))
