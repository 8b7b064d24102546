"""The benchmark tables seen as sales leads.

An order is a lead: its customer gives the phone, its lines give the arrival, drive and order
times, calls and the car. ``leads`` builds only the parts a query asks for. ``LEADS_SQL`` is the
same view in SQL, for checking results in another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.session import use_utc

RATINGS = {"1": "H", "2": "A", "3": "B", "4": "O"}
YES, NO = "是", "否"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def phone_of(key: str) -> Column:
    return F.concat(F.lit("138"), F.lpad(F.col(key).cast("string"), 8, "0"))


def _cents(factor: int = 1) -> Column:
    whole = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return F.pmod(whole * factor, F.lit(1000)) / 1000.0


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")


def base(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: ids, creation, rating, first touch, yes/no answers, probabilities."""
    return table(spark, folder, "orders").select(*_base_columns())


def _base_columns() -> list[Column]:
    level = F.substring("o_orderpriority", 1, 1)
    rating = F.lit(None).cast("string")
    for mark, name in RATINGS.items():
        rating = F.when(level == mark, name).otherwise(rating)
    k = F.col("o_orderkey")
    yes = lambda part, of: (
        F.when(k % of == 0, F.lit(None).cast("string")).when(k % of == 1, "").when(k % of <= part, YES).otherwise(NO))
    touched = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), ((k * 7) % 40 - 2).cast("int"))
    return [
        k.alias(v.LEAD_ID),
        F.col("o_custkey").alias("__cust"),
        phone_of("o_custkey").alias(v.PHONE),
        F.col("o_orderdate").cast("timestamp").alias(v.CREATED),
        F.when(k % 11 != 0, touched).alias(v.FIRST_TOUCH),
        rating.alias(v.RATING_RESULT),
        F.col("o_orderpriority").alias("二级渠道名称"),
        yes(3, 5).alias("客户是否主动询问交车时间"),
        yes(4, 7).alias("客户是否主动询问购车权益"),
        yes(5, 9).alias("客户是否主动询问金融政策"),
        yes(6, 8).alias("客户是否同意加微信"),
        yes(2, 6).alias("客户是否表示门店距离太远拒绝到店"),
        (k % 3).cast("int").alias("历史到店次数"),
        (k % 4).cast("int").alias("历史试驾次数"),
        (k % 2).cast("int").alias("历史订单次数"),
        F.when(F.col("o_orderstatus") == "F", "已支付").when(F.col("o_orderstatus") == "P", "未支付").alias("意向金支付状态"),
        _cents(1).alias("p7"), _cents(7).alias("p14"), _cents(13).alias("p21"),
    ]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order from its lines; the car is the part of the first line."""
    shipped = F.col("l_shipdate").cast("timestamp")
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min(shipped).alias(v.ARRIVED),
        F.min(F.when(F.col("l_returnflag") == "R", shipped)).alias(v.DRIVEN),
        F.max(F.when(F.col("l_linestatus") == "F", shipped)).alias(v.ORDERED),
        F.count("*").alias("通话次数"),
        F.sum("l_quantity").alias("通话总时长"),
        F.min_by("l_partkey", F.col("l_linenumber").cast("bigint") * 2**40 + F.col("l_partkey")).alias("__part"),
    )


def leads(spark: SparkSession, folder: str, *parts: str) -> DataFrame:
    """The lead view. ``parts``: "lines" (times, calls), "place" (channel, city), "car", "classes"."""
    out, more = table(spark, folder, "orders").select(*ORDER_COLUMNS), []
    if "place" in parts:
        customer = table(spark, folder, "customer").join(
            table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(F.col("c_custkey"), F.col("c_mktsegment").alias("一级渠道名称"), F.col("n_name").alias(v.CITY))
        out = out.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        more = ["一级渠道名称", v.CITY]
    if "lines" in parts or "car" in parts:
        lines = _lines(spark, folder)
        out = out.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        more = [c for c in lines.columns if c not in ("l_orderkey", "__part")] + more
    if "car" in parts:
        part = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias(v.CAR))
        out = out.join(part, F.col("__part") == F.col("p_partkey"), "left")
        more = [*more, v.CAR]
    # The joins move the orders' own columns; what is derived from them is made behind the last one.
    out = out.select(*_base_columns(), *more)
    if "classes" in parts:
        total = F.col("p7") + F.col("p14") + F.col("p21") + 0.001
        out = out.withColumns({"p_H": F.col("p7") / total, "p_A": F.col("p14") / total, "p_B": F.col("p21") / total})
    return out.drop("__cust")


def behavior_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the behaviour log; purchases speak of orders, views of test drives."""
    event = F.when(F.col("event_type") == "purchase", F.lit("submitOrder")).when(
        F.col("event_type") == "view", F.lit("testDrive")).otherwise(F.col("event_type"))
    return table(spark, folder, "events").select(
        phone_of("user_id").alias(v.BEHAVIOR_PHONE), F.col("ts").alias(v.BEHAVIOR_TIME), event.alias(v.BEHAVIOR_EVENT))


LEADS_SQL = """
WITH lines AS (
  SELECT l_orderkey,
         min(l_shipdate) AS arrived,
         min(l_shipdate) FILTER (l_returnflag = 'R') AS driven,
         max(l_shipdate) FILTER (l_linestatus = 'F') AS ordered,
         count(*) AS calls, sum(l_quantity) AS call_seconds,
         arg_min(l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) AS partkey
  FROM lineitem GROUP BY l_orderkey),
leads AS (
  SELECT o_orderkey AS id, '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS phone,
         o_orderdate AS created,
         CASE WHEN o_orderkey % 11 <> 0
              THEN o_orderdate + to_hours(CAST((o_orderkey * 7) % 40 - 2 AS INTEGER)) END AS touched,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'H' WHEN '2' THEN 'A' WHEN '3' THEN 'B'
              WHEN '4' THEN 'O' END AS rating,
         o_orderpriority AS channel2, c_mktsegment AS channel1, n_name AS city, p_brand AS car,
         CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '是' WHEN 3 THEN '是' ELSE '否' END AS ask_time,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN ''
              WHEN o_orderkey % 7 <= 4 THEN '是' ELSE '否' END AS ask_benefit,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN ''
              WHEN o_orderkey % 9 <= 5 THEN '是' ELSE '否' END AS ask_finance,
         CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN ''
              WHEN o_orderkey % 8 <= 6 THEN '是' ELSE '否' END AS add_wechat,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN ''
              WHEN o_orderkey % 6 <= 2 THEN '是' ELSE '否' END AS too_far,
         o_orderkey % 3 AS past_arrivals, o_orderkey % 4 AS past_drives, o_orderkey % 2 AS past_orders,
         CASE o_orderstatus WHEN 'F' THEN '已支付' WHEN 'P' THEN '未支付' END AS paid,
         (CAST(round(o_totalprice * 100) AS BIGINT) % 1000) / 1000.0 AS p7,
         (CAST(round(o_totalprice * 100) AS BIGINT) * 7 % 1000) / 1000.0 AS p14,
         (CAST(round(o_totalprice * 100) AS BIGINT) * 13 % 1000) / 1000.0 AS p21,
         arrived, driven, ordered, calls, call_seconds
  FROM orders
  LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN part ON p_partkey = partkey),
scored AS (
  SELECT *, p7 / (p7 + p14 + p21 + 0.001) AS ph, p14 / (p7 + p14 + p21 + 0.001) AS pa,
         p21 / (p7 + p14 + p21 + 0.001) AS pb
  FROM leads)
"""
