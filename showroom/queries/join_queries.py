"""Behaviour log, lead join, scans and round trips through the writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.operators import behavior as b
from showroom.plans.lead_view import LEADS_SQL, base, behavior_log, leads, table
from showroom.queries.registry import query, tidy
from showroom.session import ensure_shared_folder
from showroom.sources import readers, writers

BEHAVIOR_SQL = """
behavior AS (
  SELECT '138' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS log_phone, count(*) AS events,
         max(epoch_us(ts)) AS latest,
         count(*) FILTER (event_type = 'view') AS drives,
         count(*) FILTER (event_type = 'purchase') AS orders,
         count(DISTINCT event_type) AS kinds
  FROM events GROUP BY user_id)
"""
SHORT = dict(zip(v.BEHAVIOR_FEATURES, ("events", "latest", "drives", "orders", "kinds")))


@query("a1_behavior_features", "WITH " + BEHAVIOR_SQL + "SELECT * FROM behavior")
def behavior_features(spark, folder):
    out = b.behavior_features(behavior_log(spark, folder))
    return tidy(out.withColumnsRenamed({**SHORT, v.BEHAVIOR_PHONE: "log_phone"}))


def merged(spark, folder):
    return b.merge_leads(base(spark, folder), behavior_log(spark, folder))


@query("j1_behavior_join", LEADS_SQL + "," + BEHAVIOR_SQL + """
SELECT id, phone, rating, events, latest, drives, orders, kinds FROM leads LEFT JOIN behavior ON phone = log_phone""")
def behavior_join(spark, folder):
    out = merged(spark, folder).withColumnsRenamed(SHORT)
    return tidy(out.select(
        F.col(v.LEAD_ID).alias("id"), F.col(v.PHONE).alias("phone"), F.col(v.RATING_RESULT).alias("rating"), *SHORT.values()))


@query("j2_match_statistics", LEADS_SQL + "," + BEHAVIOR_SQL + """
SELECT count(*) AS total, count(events) AS matched, round(count(events) / count(*), 6) AS match_rate
FROM leads LEFT JOIN behavior ON phone = log_phone""")
def match_statistics(spark, folder):
    return tidy(b.match_statistics(merged(spark, folder)))


@query("s3_parquet_columns", "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders")
def parquet_columns(spark, folder):
    return tidy(readers.read_parquet(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"]))


@query("s4_sql_scan", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def sql_scan(spark, folder):
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus", orders=table(spark, folder, "orders"))


@query("s8_union_parts", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys
FROM orders GROUP BY o_orderstatus""")
def union_parts(spark, folder):
    orders = table(spark, folder, "orders")
    part = lambda s: orders.where(F.col("o_orderstatus") == s)
    both = b.union_parts({"Sheet1": part("F"), "query log": part("O"), "Sheet2": part("O"), "Sheet3": part("P")})
    return tidy(both.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys")))


def _folder(spark, folder, name):
    scale = folder.rstrip("/").rsplit("/", 1)[-1]
    return f"{ensure_shared_folder(spark)}/hand-over/{scale}/{name}"


@query("s9_write_parquet", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY o_orderstatus""")
def write_parquet(spark, folder):
    path = _folder(spark, folder, "orders.parquet")
    writers.write_parquet(table(spark, folder, "orders"), path, "zstd", by=["o_orderstatus"])
    back = spark.read.parquet(path)
    return tidy(back.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price")))


@query("s10_parquet_to_text", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders""")
def parquet_to_text(spark, folder):
    path = _folder(spark, folder, "orders-text")
    writers.parquet_to_delimited(
        spark, f"{folder}/orders.parquet", path, delimiter="pipe", columns=["o_orderkey", "o_orderpriority", "o_orderstatus"])
    back = readers.read_header(spark, path, "|")
    return tidy(back.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")))


@query("s11_text_to_parquet", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def text_to_parquet(spark, folder):
    text, target = _folder(spark, folder, "events.tsv"), _folder(spark, folder, "events.parquet")
    writers.write_delimited(table(spark, folder, "events").select("event_id", "user_id", "event_type"), text, "tab")
    writers.text_to_parquet(spark, text, target)
    return spark.read.parquet(target).groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("s11_folder_to_parquet", """
SELECT part, count(*) AS n, count(DISTINCT user_id) AS users FROM (
  SELECT CASE WHEN event_type = 'purchase' THEN 'a' ELSE 'b' END AS part, user_id FROM events) GROUP BY part""")
def folder_to_parquet(spark, folder):
    """Two subfolders whose files have the same names; every file becomes a table of its own."""
    source, target = _folder(spark, folder, "event-files"), _folder(spark, folder, "event-tables")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    parts = {"a": events.where("event_type = 'purchase'"), "b": events.where("event_type <> 'purchase' OR event_type IS NULL")}
    out = None
    for name, rows in parts.items():
        writers.write_delimited(rows, f"{source}/{name}")
    done = writers.convert_folder(spark, source, target)
    for path in done:
        below = "/".join(path.rsplit("/", 2)[-2:])
        rows = spark.read.parquet(f"{target}/{below}.parquet").select(F.lit(below[0]).alias("part"), "user_id")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("s7_behavior_log", """
SELECT '138' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS phone, epoch_us(ts) AS at,
       CASE event_type WHEN 'purchase' THEN 'submitOrder' WHEN 'view' THEN 'testDrive' ELSE event_type END AS event
FROM events""")
def read_log(spark, folder):
    path = _folder(spark, folder, "behavior-log")
    log = behavior_log(spark, folder).withColumn(
        v.BEHAVIOR_TIME, F.date_format(v.BEHAVIOR_TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    empty = {c: F.lit("x") for c in v.BEHAVIOR_COLUMNS[3:]}
    writers.write_delimited(log.withColumns(empty), path, "tab", v.BEHAVIOR_COLUMNS, header=False)
    back = readers.read_behavior_log(spark, path)
    return tidy(back.select(
        F.col(v.BEHAVIOR_PHONE).alias("phone"), F.col(v.BEHAVIOR_TIME).alias("at"), F.col(v.BEHAVIOR_EVENT).alias("event")))


def lead_export(spark, folder):
    """The lead view as a 46-column headerless export."""
    known = leads(spark, folder, "lines", "place", "car")
    stamp = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in (v.CREATED, v.FIRST_TOUCH, v.ARRIVED, v.DRIVEN, v.ORDERED)}
    known = known.withColumns(stamp).withColumn(v.LEAD_ID, F.concat(F.lit("DIS"), F.col(v.LEAD_ID)))
    known = known.withColumn(v.FOLLOWUPS, F.concat(
        F.lit('[{"意向级别":"'), F.coalesce(v.RATING_RESULT, F.lit("")), F.lit('","通话结果":"已接通","通话时长(分:秒)":"1:'),
        F.lpad((F.substring(v.PHONE, -2, 2).cast("int") % 60).cast("string"), 2, "0"), F.lit('"}]')))
    return known.select(*[
        (F.col(c).cast("string") if c in known.columns else F.lit(None).cast("string")).alias(c) for c in v.LEAD_EXPORT_COLUMNS])


ADAPT_SQL = LEADS_SQL + """
SELECT 'DIS' || id AS id, epoch_us(created) AS created, rating,
       CAST(coalesce(epoch(arrived) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS BIGINT) AS arrive_14,
       CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 21 * 86400, false) AS BIGINT) AS drive_21,
       CAST(coalesce(epoch(ordered) - epoch(driven) BETWEEN 0 AND 21 * 86400, false) AS BIGINT) AS order_21,
       CAST(isodow(created) AS BIGINT) AS weekday, CAST(hour(created) AS BIGINT) AS hour,
       CAST(1 AS BIGINT) AS records, CAST(60 + CAST(right(phone, 2) AS INTEGER) % 60 AS BIGINT) AS longest
FROM leads"""


@query("s17_load_and_adapt", ADAPT_SQL)
def load_and_adapt(spark, folder):
    path = _folder(spark, folder, "leads-export")
    writers.write_delimited(lead_export(spark, folder), path, "tab", header=False)
    adapted, _ = readers.load_leads(spark, path)
    return tidy(adapted.select(
        F.col(v.LEAD_ID).alias("id"), F.col(v.CREATED).cast("timestamp").alias("created"), F.col(v.RATING_RESULT).alias("rating"),
        F.col("到店标签_14天").alias("arrive_14"), F.col("试驾标签_21天").alias("drive_21"), F.col("下订标签_21天").alias("order_21"),
        F.col("线索创建星期几").alias("weekday"), F.col("线索创建小时").alias("hour"), F.col("跟进总次数").alias("records"),
        F.col("最长通话时长_秒").alias("longest")))


@query("s2_lead_export", LEADS_SQL + """
SELECT 'DIS' || id AS id, phone, rating, city, car, CAST(calls AS BIGINT) AS calls FROM leads""")
def read_lead_export(spark, folder):
    path = _folder(spark, folder, "leads-export-raw")
    writers.write_delimited(lead_export(spark, folder), path, "tab", header=False)
    back = readers.read_lead_export(spark, path)
    return tidy(back.select(
        F.col(v.LEAD_ID).alias("id"), F.col(v.PHONE).alias("phone"), F.col(v.RATING_RESULT).alias("rating"),
        F.col(v.CITY).alias("city"), F.col(v.CAR).alias("car"), F.col("通话次数").cast("bigint").alias("calls")))


@query("s1_header_text", "SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, c_n FROM (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, n_regionkey, count(c_custkey) AS c_n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)")
def header_text(spark, folder):
    path = _folder(spark, folder, "customer.csv")
    writers.write_delimited(table(spark, folder, "customer"), path, "comma")
    customers = readers.read_table(spark, path).select(F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_custkey")
    counted = customers.groupBy("c_nationkey").agg(F.count("c_custkey").alias("c_n"))
    joined = table(spark, folder, "nation").join(counted, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return tidy(joined.select("n_nationkey", "n_name", "n_regionkey", F.coalesce("c_n", F.lit(0)).alias("c_n")))


@query("s5_format_detection", """
SELECT 'events.parquet' AS name, 'parquet' AS kind, 'none' AS separator, count(*) AS n FROM events UNION ALL
SELECT 'leads.txt', 'headerless', 'tab', count(*) FROM orders UNION ALL
SELECT 'orders.csv', 'header', 'comma', count(*) FROM orders""")
def format_detection(spark, folder):
    csv, export = _folder(spark, folder, "detect-orders.csv"), _folder(spark, folder, "detect-leads")
    writers.write_delimited(table(spark, folder, "orders"), csv, "comma")
    writers.write_delimited(lead_export(spark, folder), export, "tab", header=False)
    names = {None: "none", "\t": "tab", ",": "comma"}
    out = None
    for name, path in (("events.parquet", f"{folder}/events.parquet"), ("leads.txt", export), ("orders.csv", csv)):
        found = readers.detect_format(spark, path)
        row = readers.read_table(spark, path).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), F.lit(found.kind).alias("kind"), F.lit(names[found.separator]).alias("separator"), "n")
        out = row if out is None else out.unionByName(row)
    return out
