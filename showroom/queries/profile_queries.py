"""Profiles and cleaning statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import labels as lb
from showroom.operators import cleaning as cg, profiling as pf
from showroom.plans.lead_view import LEADS_SQL, base, leads, table
from showroom.queries.registry import query, tidy

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a2_duplicate_summary", """
SELECT count(*) AS rows, CAST(4 AS BIGINT) AS columns, count(*) - count(DISTINCT {'a': l_returnflag, 'b': l_linestatus, 'c': l_quantity, 'd': l_discount}) AS duplicate_rows
FROM lineitem""")
def duplicate_summary(spark, folder):
    return tidy(pf.duplicate_summary(table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")))


def sparse(spark, folder):
    df = leads(spark, folder, "lines", "place", "car")
    return df.select(
        F.col(v.LEAD_ID).alias("id"), F.col(v.RATING_RESULT).alias("rating"), F.col(v.FIRST_TOUCH).alias("touched"),
        F.col(v.DRIVEN).alias("driven"), F.col(v.CITY).alias("city"), F.col(v.CAR).alias("car"),
        F.col("意向金支付状态").alias("paid"), F.when(F.col(v.LEAD_ID) % 3 == 0, F.col("p7")).alias("p7"))


SPARSE_SQL = LEADS_SQL + """, sparse AS (SELECT id, rating, touched, driven, city, car, paid, CASE WHEN id % 3 = 0 THEN p7 END AS p7 FROM leads),
missing AS (SELECT "column", n FROM (SELECT """ + ", ".join(
    f"count(*) - count({c}) AS {c}" for c in ("id", "rating", "touched", "driven", "city", "car", "paid", "p7")) + """ FROM sparse)
UNPIVOT (n FOR "column" IN (id, rating, touched, driven, city, car, paid, p7))),
total AS (SELECT count(*) AS t FROM sparse)
"""


@query("a3_missing_by_column", SPARSE_SQL + """
SELECT "column", t AS total, n AS missing_count, round(n * 100.0 / t, 2) AS missing_ratio FROM missing, total""")
def missing_by_column(spark, folder):
    return tidy(pf.missing_by_column(sparse(spark, folder)).drop("exact_ratio"))


@query("a3_missing_summary", SPARSE_SQL + """
SELECT CAST(sum(n) AS BIGINT) AS total_missing, max(t) * count(*) AS total_cells, count(*) FILTER (n * 100.0 / t > 50) AS high_missing_columns,
       count(*) FILTER (n * 100.0 / t > 10 AND n * 100.0 / t <= 50) AS medium_missing_columns,
       round(CAST(sum(n) AS DOUBLE) / (max(t) * count(*)), 6) AS missing_share FROM missing, total""")
def missing_summary(spark, folder):
    out = pf.missing_summary(sparse(spark, folder)).drop("overall_missing_ratio")
    return tidy(out.withColumn("missing_share", F.col("total_missing") / F.col("total_cells")))


@query("a4_column_summary", """
SELECT 'l_quantity' AS "column", 'numeric' AS category, round(min(l_quantity), 2) AS low, round(max(l_quantity), 2) AS high, round(avg(l_quantity), 6) AS mean, CAST(0 AS BIGINT) AS missing_count FROM lineitem UNION ALL
SELECT 'l_extendedprice', 'numeric', round(min(l_extendedprice), 2), round(max(l_extendedprice), 2), round(avg(l_extendedprice), 6), 0 FROM lineitem UNION ALL
SELECT 'l_discount', 'numeric', round(min(l_discount), 2), round(max(l_discount), 2), round(avg(l_discount), 6), 0 FROM lineitem UNION ALL
SELECT 'l_returnflag', 'categorical', NULL, NULL, NULL, 0 FROM (SELECT 1) UNION ALL
SELECT 'l_shipdate', 'datetime', NULL, NULL, NULL, 0 FROM (SELECT 1)""")
def column_summary(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    out = pf.column_summary(df)
    number = lambda c: F.round(F.expr(f"try_cast({c} as double)"), 2)
    return tidy(out.select("column", "category", number("min").alias("low"), number("max").alias("high"), "mean", "missing_count"))


@query("a5_top_values", """
WITH c AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL
           SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY ALL UNION ALL
           SELECT 'day', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY ALL)
SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS position FROM c
QUALIFY position <= 5""")
def top_values(spark, folder):
    df = table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string").alias("day"))
    return tidy(pf.top_values(df))


@query("a6_target_summary", LEADS_SQL + """, c AS (SELECT rating, count(*) AS n FROM leads GROUP BY rating)
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (rating IS NULL), 0) AS BIGINT) AS null_count, count(*) AS classes,
       round(max(n) / min(n), 2) AS imbalance_ratio, max(n) / min(n) > 10 AS is_imbalanced, '线索评级结果' AS target FROM c""")
def target_summary(spark, folder):
    return tidy(pf.target_summary(base(spark, folder)))


@query("a8_full_profile", """
WITH b AS (SELECT count(*) AS n FROM orders)
SELECT 'basic' AS section, '' AS item, 'rows' AS metric, CAST(n AS VARCHAR) AS value FROM b UNION ALL
SELECT 'basic', '', 'columns', '3' UNION ALL
SELECT 'basic', '', 'duplicate_rows', CAST(count(*) - count(DISTINCT {'a': o_orderstatus, 'b': o_orderpriority, 'c': o_custkey}) AS VARCHAR) FROM orders UNION ALL
SELECT 'missing', c, 'missing_count', '0' FROM (VALUES ('o_orderstatus'), ('o_orderpriority'), ('o_custkey')) t(c) UNION ALL
SELECT 'top_values', 'o_orderstatus=' || o_orderstatus, 'count', CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_orderstatus UNION ALL
SELECT 'top_values', 'o_orderpriority=' || o_orderpriority, 'count', CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_orderpriority UNION ALL
SELECT 'columns', 'o_custkey', 'max', CAST(max(o_custkey) AS VARCHAR) FROM orders""")
def full_profile(spark, folder):
    out = pf.full_profile(table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey"))
    exact = (F.col("section") == "basic") | (F.col("section") == "top_values") | (F.col("metric") == "missing_count")
    return out.where(exact | ((F.col("item") == "o_custkey") & (F.col("metric") == "max")))


@query("a8_cleaning_suggestions", SPARSE_SQL + """, t AS (SELECT *, CAST(1 AS BIGINT) AS same FROM sparse)
SELECT 'high_missing' AS rule, count(*) AS n FROM missing, total WHERE n * 100.0 / t > 50 UNION ALL
SELECT 'medium_missing', count(*) FROM missing, total WHERE n * 100.0 / t > 10 AND n * 100.0 / t <= 50 UNION ALL
SELECT 'constant', 1""")
def cleaning_suggestions(spark, folder):
    return tidy(pf.cleaning_suggestions(sparse(spark, folder).withColumn("same", F.lit(1).cast("bigint")), "rating"))


@query("a9_outliers_iqr", "WITH u AS (SELECT \"column\", value FROM (SELECT l_quantity, l_extendedprice, l_discount, l_tax, "
       "CASE WHEN l_orderkey % 50 = 0 THEN l_quantity * 40 ELSE l_quantity END AS spiked FROM lineitem) "
       "UNPIVOT (value FOR \"column\" IN (l_quantity, l_extendedprice, l_discount, l_tax, spiked))), "
       "q AS (SELECT \"column\", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM u GROUP BY ALL) "
       "SELECT u.\"column\", round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper, count(*) AS outliers "
       "FROM u JOIN q ON u.\"column\" = q.\"column\" WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) GROUP BY ALL")
def outliers_iqr(spark, folder):
    return tidy(cg.outliers_iqr(spiked(spark, folder)))


def spiked(spark, folder):
    spike = F.when(F.col("l_orderkey") % 50 == 0, F.col("l_quantity") * 40).otherwise(F.col("l_quantity"))
    return table(spark, folder, "lineitem").select(*LINE_NUMBERS, spike.alias("spiked"))


SPIKED_SQL = """WITH u AS (SELECT "column", value FROM (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_orderkey % 50 = 0 THEN l_quantity * 40 ELSE l_quantity END AS spiked FROM lineitem)
  UNPIVOT (value FOR "column" IN (l_quantity, l_extendedprice, l_discount, l_tax, spiked)))
"""


@query("a10_outliers_zscore", SPIKED_SQL + """, s AS (SELECT "column", avg(value) AS m, stddev_pop(value) AS d FROM u GROUP BY ALL)
SELECT u."column", round(m, 6) AS mean, round(d, 6) AS std, count(*) AS outliers FROM u JOIN s ON u."column" = s."column"
WHERE d > 0 AND abs((value - m) / d) > 1.7 GROUP BY ALL""")
def outliers_zscore(spark, folder):
    return tidy(cg.outliers_zscore(spiked(spark, folder), threshold=1.7))


@query("a11_skewed_columns", SPIKED_SQL + """, s AS (SELECT "column", avg(value) AS m, stddev_pop(value) AS d FROM u GROUP BY ALL),
k AS (SELECT u."column", avg(power((value - m) / d, 3)) AS skew, count(*) AS n FROM u JOIN s ON u."column" = s."column" GROUP BY ALL)
SELECT "column", round(skew, 2) AS skewness, CASE WHEN skew > 0 THEN 'log' ELSE 'power' END AS suggestion FROM k WHERE n >= 10 AND abs(skew) > 1""")
def skewed_columns(spark, folder):
    return tidy(cg.skewed_columns(spiked(spark, folder)))


@query("a12_high_cardinality", """
SELECT "column", n AS distinct_values, 'frequency_encoding or target_encoding' AS suggestion FROM (
 SELECT 'customer' AS "column", count(DISTINCT customer) + max(CAST(customer IS NULL AS INTEGER)) AS n FROM (SELECT CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders)
 UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders) WHERE n > 100""")
def high_cardinality(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderstatus", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("customer"))
    return tidy(cg.high_cardinality(df))


@query("a13_quality_report", SPARSE_SQL + """
SELECT 'rows' AS kind, '' AS "column", CAST(t AS DOUBLE) AS value FROM total UNION ALL SELECT 'columns', '', 8.0 UNION ALL SELECT 'duplicate_rows', '', 0.0 UNION ALL
SELECT 'missing_count', "column", CAST(n AS DOUBLE) FROM missing WHERE n > 0 UNION ALL
SELECT 'missing_percent', "column", round(n * 100.0 / t, 6) FROM missing, total WHERE n > 0""")
def quality_report(spark, folder):
    return tidy(pf.quality_report(sparse(spark, folder)))


@query("a14_basic_stats", LEADS_SQL + """
SELECT 'missing' AS kind, '线索唯一ID' AS "column", '' AS item, CAST(0 AS BIGINT) AS value UNION ALL
SELECT 'missing', '线索评级结果', '', count(*) - count(rating) FROM leads UNION ALL
SELECT 'label', '线索评级结果', rating, count(*) FROM leads WHERE rating IS NOT NULL GROUP BY rating""")
def basic_stats(spark, folder):
    return tidy(pf.basic_stats(base(spark, folder).select(v.LEAD_ID, v.RATING_RESULT)))


@query("a15_label_distribution", LEADS_SQL + """, g AS (
SELECT CASE WHEN days IS NULL THEN 'N' WHEN days <= 7 THEN 'H' WHEN days <= 14 THEN 'A' WHEN days <= 21 THEN 'B' ELSE 'O' END AS label
FROM (SELECT date_diff('day', CAST(created AS DATE), CAST(driven AS DATE)) AS days FROM leads))
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,
       CAST(CASE label WHEN 'H' THEN 1 WHEN 'A' THEN 2 WHEN 'B' THEN 3 WHEN 'O' THEN 4 WHEN 'N' THEN 5 ELSE 6 END AS BIGINT) AS position FROM g GROUP BY label""")
def label_distribution(spark, folder):
    return tidy(pf.label_distribution(leads(spark, folder, "lines").transform(lb.drive_date_labels), "label_OHAB"))


@query("a17_correlations", """
SELECT "column", round(c, 6) AS correlation, round(m, 6) AS mean FROM (
 SELECT 'l_quantity' AS "column", corr(l_quantity, CAST(l_linestatus = 'F' AS INTEGER)) AS c, avg(l_quantity) AS m FROM lineitem UNION ALL
 SELECT 'l_extendedprice', corr(l_extendedprice, CAST(l_linestatus = 'F' AS INTEGER)), avg(l_extendedprice) FROM lineitem UNION ALL
 SELECT 'l_discount', corr(l_discount, CAST(l_linestatus = 'F' AS INTEGER)), avg(l_discount) FROM lineitem UNION ALL
 SELECT 'l_tax', corr(l_tax, CAST(l_linestatus = 'F' AS INTEGER)), avg(l_tax) FROM lineitem) ORDER BY abs(c) DESC LIMIT 3""")
def correlations(spark, folder):
    df = table(spark, folder, "lineitem").select(*LINE_NUMBERS, (F.col("l_linestatus") == "F").cast("int").alias("target"))
    return tidy(pf.explore(df, "target", limit=3).select("column", "correlation", "mean"))


@query("a17_conversion_rates", LEADS_SQL + """
SELECT '到店标签_14天' AS "column", round(avg(CAST(coalesce(epoch(arrived) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS DOUBLE)), 6) AS rate FROM leads UNION ALL
SELECT '试驾标签_30天', round(avg(CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 30 * 86400, false) AS DOUBLE)), 6) FROM leads""")
def conversion_rates(spark, folder):
    df = leads(spark, folder, "lines").transform(lb.window_labels)
    return tidy(pf.conversion_rates(df, ["到店标签_14天", "试驾标签_30天"]))


@query("a17_mostly_missing", SPARSE_SQL + """
SELECT "column", n AS missing_count, round(n * 100.0 / t, 2) AS missing_ratio FROM missing, total WHERE n * 100.0 / t > 10""")
def mostly_missing(spark, folder):
    return tidy(pf.mostly_missing(sparse(spark, folder)))
