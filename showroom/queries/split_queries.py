"""Splits. Random members differ between engines, so sizes, disjointness and completeness are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.operators import splits as sp
from showroom.plans.lead_view import LEADS_SQL, base, leads, table
from showroom.queries.registry import query, tidy

STRATA = LEADS_SQL + ", s AS (SELECT rating AS label, count(*) AS n FROM leads GROUP BY rating)\n"


def _label():
    return F.col(v.RATING_RESULT).alias("label")


def _sizes(df, *keys):
    return tidy(df.groupBy(*keys, "split").agg(F.count("*").alias("n"), F.count_distinct(v.LEAD_ID).alias("ids")))


def _two_way(test):
    return f"""SELECT label, split, n, n AS ids FROM (
SELECT label, 'test' AS split, CAST({test} AS BIGINT) AS n FROM s WHERE label IS NOT NULL UNION ALL
SELECT label, 'train', CAST(n - CAST({test} AS BIGINT) AS BIGINT) FROM s WHERE label IS NOT NULL) WHERE n > 0"""


@query("w1_stratified_sizes", STRATA + _two_way("CAST(n * 0.2::DOUBLE AS INTEGER)"))
def stratified_sizes(spark, folder):
    out = sp.random_split(base(spark, folder), v.RATING_RESULT)
    return _sizes(out, _label())


@query("w2_floored_sizes", STRATA + _two_way("floor(n * 0.15::DOUBLE)"))
def floored_sizes(spark, folder):
    out = sp.random_split(base(spark, folder), v.RATING_RESULT, test_ratio=0.15, rounding="floor", seed=7)
    return _sizes(out, _label())


@query("w3_simple_sizes", LEADS_SQL + """
SELECT split, n, n AS ids FROM (SELECT 'test' AS split, CAST(CAST(count(*) * 0.2::DOUBLE AS INTEGER) AS BIGINT) AS n FROM leads UNION ALL
SELECT 'train', count(*) - CAST(CAST(count(*) * 0.2::DOUBLE AS INTEGER) AS BIGINT) FROM leads)""")
def simple_sizes(spark, folder):
    return _sizes(sp.random_split(base(spark, folder), None))


THREE = """, e AS (SELECT label, n, CASE WHEN n >= 3 THEN greatest(1, CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT)) ELSE greatest(1, n - 2) END AS a FROM s),
b AS (SELECT *, CASE WHEN n >= 3 THEN least(a + greatest(1, CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT)), n - 1) ELSE least(n, a + 1) END AS c FROM e)
SELECT label, split, n, n AS ids FROM (SELECT label, 'train' AS split, a AS n FROM b UNION ALL SELECT label, 'valid', c - a FROM b
UNION ALL SELECT label, 'test', n - c FROM b) WHERE n > 0"""


@query("w4_three_way_sizes", STRATA + THREE)
def three_way_sizes(spark, folder):
    out = sp.stratified_split(base(spark, folder), v.RATING_RESULT, v.LEAD_ID, sp.three_way_sizes((0.7, 0.15, 0.15)))
    return _sizes(out, _label())


@query("w5_holdout_sizes", STRATA + """, e AS (SELECT label, n, greatest(1, CAST(round_even(n * 0.8::DOUBLE, 0) AS BIGINT)) AS a FROM s WHERE label IS NOT NULL)
SELECT label, split, n, n AS ids FROM (SELECT label, 'train' AS split, a AS n FROM e UNION ALL SELECT label, 'test', n - least(a + 1, n - 1) FROM e) WHERE n > 0""")
def holdout_sizes(spark, folder):
    return _sizes(sp.holdout_split(base(spark, folder), v.RATING_RESULT), _label())


def phoned(spark, folder):
    k = F.col(v.LEAD_ID)
    phone = F.when(k % 9 == 0, "").when(k % 9 == 1, F.lit(None)).when(k % 9 == 2, " null ").otherwise(F.concat(F.lit(" "), F.col(v.PHONE)))
    return base(spark, folder).withColumn(v.PHONE, phone)


KEYED = LEADS_SQL + """, keyed AS (SELECT id, rating, CASE WHEN id % 9 IN (0, 1, 2) THEN 'lead::' || id ELSE 'phone::' || phone END AS k FROM leads)
"""


@query("w6_group_keys", KEYED + "SELECT id, k FROM keyed")
def group_keys(spark, folder):
    df = phoned(spark, folder)
    return df.select(F.col(v.LEAD_ID).alias("id"), sp.group_key(df).alias("k"))


@query("w7_dominant_labels", KEYED + """
SELECT k, rating AS label FROM (SELECT k, rating, count(*) AS n FROM keyed GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, rating ASC NULLS LAST) = 1""")
def dominant_labels(spark, folder):
    df = phoned(spark, folder)
    df = df.withColumn("k", sp.group_key(df))
    return sp.dominant_label(df, "k", v.RATING_RESULT).withColumnRenamed(v.RATING_RESULT, "label")


DOMINANT = KEYED + """, g AS (SELECT k, rating AS label FROM (SELECT k, rating, count(*) AS n FROM keyed GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, rating ASC NULLS LAST) = 1),
s AS (SELECT label, count(*) AS n FROM g GROUP BY label)
"""


@query("w8_group_split_sizes", DOMINANT + THREE.replace("n AS ids", "CAST(0 AS BIGINT) AS shared"))
def group_split_sizes(spark, folder):
    df = phoned(spark, folder)
    rows, assigned = sp.group_split(df, v.RATING_RESULT, keep_key=True)
    labels = sp.dominant_label(rows, "split_group_key", v.RATING_RESULT)
    parts = rows.groupBy("split_group_key").agg(F.min("split").alias("split"), (F.count_distinct("split") - 1).alias("more"))
    out = parts.join(labels, "split_group_key").groupBy(_label(), "split").agg(F.count("*").alias("n"), F.sum("more").alias("shared"))
    return tidy(out)


@query("w9_time_split", LEADS_SQL + """
SELECT id, CASE WHEN created < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split FROM leads""")
def time_split(spark, folder):
    out = sp.require_parts(sp.time_split(base(spark, folder), "1998-01-01"), ("train", "test"))
    return tidy(out.select(F.col(v.LEAD_ID).alias("id"), "split"))


@query("w9_part_ranges", LEADS_SQL + """
SELECT CASE WHEN created < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'test' END AS split, rating AS label, count(*) AS n,
       epoch_us(min(created)) AS first_time, epoch_us(max(created)) AS last_time FROM leads GROUP BY ALL""")
def part_ranges(spark, folder):
    out = sp.part_ranges(sp.time_split(base(spark, folder), "1998-01-01"), target=v.RATING_RESULT)
    return tidy(out.withColumnRenamed(v.RATING_RESULT, "label"))


@query("w10_time_split_three", LEADS_SQL + """
SELECT id, CASE WHEN created < TIMESTAMP '1996-06-01' THEN 'train' WHEN created < TIMESTAMP '1998-01-01' THEN 'valid' ELSE 'test' END AS split FROM leads""")
def time_split_three(spark, folder):
    out = sp.time_split_three(base(spark, folder), "1996-06-01", "1998-01-01")
    return tidy(out.select(F.col(v.LEAD_ID).alias("id"), "split"))


@query("w11_auto_split", LEADS_SQL + """, c AS (SELECT CAST(min(created) + (max(created) - min(created)) * 0.8 AS DATE) AS d FROM leads)
SELECT id, CASE WHEN created < d THEN 'train' ELSE 'test' END AS split, CAST(d AS VARCHAR) AS cutoff FROM leads, c""")
def auto_split(spark, folder):
    out, info = sp.auto_split(base(spark, folder), v.RATING_RESULT)
    return tidy(out.select(F.col(v.LEAD_ID).alias("id"), "split", F.lit(info["cutoff"]).alias("cutoff")))


@query("w12_smart_split", LEADS_SQL + """, known AS (SELECT * FROM leads WHERE rating IS NOT NULL),
c AS (SELECT CAST(min(created) + (max(created) - min(created)) * 0.70 AS DATE) AS a, CAST(min(created) + (max(created) - min(created)) * 0.85 AS DATE) AS b FROM known)
SELECT id, CASE WHEN created < a THEN 'train' WHEN created < b THEN 'valid' ELSE 'test' END AS split, 'oot' AS mode FROM known, c""")
def smart_split(spark, folder):
    out, info = sp.smart_split(base(spark, folder), v.RATING_RESULT)
    return tidy(out.select(F.col(v.LEAD_ID).alias("id"), "split", F.lit(info["mode"]).alias("mode")))


@query("w13_unified_split", LEADS_SQL + """, c AS (SELECT quantile_cont(epoch_us(created), 0.8) AS q FROM leads)
SELECT CASE WHEN epoch_us(created) < q THEN 'train' ELSE 'test' END AS split, count(*) AS n, count(driven) AS driven FROM leads, c GROUP BY ALL""")
def unified_split(spark, folder):
    full, driven = sp.unified_split(leads(spark, folder, "lines"))
    a = full.groupBy("split").agg(F.count("*").alias("n"))
    return tidy(a.join(driven.groupBy("split").agg(F.count("*").alias("driven")), "split"))


@query("w14_given_dates", LEADS_SQL + """
SELECT id, 'oot_manual' AS mode FROM leads WHERE created >= TIMESTAMP '1998-01-01'""")
def given_dates(spark, folder):
    out = sp.time_split_three(base(spark, folder), "1996-06-01", "1998-01-01")
    test = sp.isolate_test(sp.parts(out)["test"], {"mode": "oot_manual", "valid_end": "1998-01-01"})
    return tidy(test.select(F.col(v.LEAD_ID).alias("id"), F.lit("oot_manual").alias("mode")))


@query("j3_group_members", KEYED + """
SELECT k, count(*) AS n FROM keyed WHERE k IN (SELECT k FROM keyed WHERE rating = 'H') GROUP BY k""")
def group_members(spark, folder):
    df = phoned(spark, folder)
    df = df.withColumn("k", sp.group_key(df))
    keys = df.where(F.col(v.RATING_RESULT) == "H").select("k")
    return df.join(keys, "k", "left_semi").groupBy("k").agg(F.count("*").alias("n"))


@query("j5_disjoint_ids", LEADS_SQL + "SELECT count(*) AS test_rows, CAST(0 AS BIGINT) AS shared FROM leads WHERE created >= TIMESTAMP '1998-01-01'")
def disjoint_ids(spark, folder):
    parts = sp.parts(sp.time_split(base(spark, folder), "1998-01-01"))
    sp.check_disjoint(parts["train"], parts["test"])
    shared = parts["test"].join(parts["train"].select(v.LEAD_ID), v.LEAD_ID, "left_semi")
    return tidy(parts["test"].agg(F.count("*").alias("test_rows")).withColumn("shared", F.lit(shared.count())))


@query("w14_given_sets", """
SELECT split, count(*) AS n, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS ids FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'test' END AS split FROM orders) GROUP BY split""")
def given_sets(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", v.LEAD_ID)
    return _sizes(sp.given_parts(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus != 'F'")))
