"""Labels, features, follow-up records."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import followups as fu
from showroom.functions import labels as lb
from showroom.operators import features as ft, policy
from showroom.plans.lead_view import LEADS_SQL, base, leads, table
from showroom.queries.registry import lead_id, query, tidy



def _flag_sql(expr, name):
    return f"CAST(coalesce({expr}, false) AS BIGINT) AS {name}"


def _within(seconds, days):
    return f"{seconds} BETWEEN 0 AND {days} * 86400"


ARRIVE, DRIVE, ORDER = "(epoch(arrived) - epoch(created))", "(epoch(driven) - epoch(created))", "(epoch(ordered) - epoch(driven))"


@query("c1_window_labels", LEADS_SQL + "SELECT id, " + ", ".join(
    [_flag_sql(_within(ARRIVE, n), f"arrive_{n}") for n in (7, 14, 30)]
    + [_flag_sql(_within(DRIVE, n), f"drive_{n}") for n in (7, 14, 21, 30)]) + " FROM leads")
def window_labels(spark, folder):
    out = leads(spark, folder, "lines").transform(lb.window_labels)
    return tidy(out.select(
        lead_id(), *[F.col(f"到店标签_{n}天").alias(f"arrive_{n}") for n in (7, 14, 30)],
        *[F.col(f"试驾标签_{n}天").alias(f"drive_{n}") for n in (7, 14, 21, 30)]))


@query("c2_outcome_labels", LEADS_SQL + """
SELECT id, coalesce(rating, 'Unknown') AS target, CAST(ordered IS NOT NULL AS BIGINT) AS deal,
       CAST(ordered IS NOT NULL AS BIGINT) AS final FROM leads""")
def outcome_labels(spark, folder):
    out = leads(spark, folder, "lines").transform(lb.outcome_labels)
    return tidy(out.select(lead_id(), F.col(v.RATING_BEFORE_DRIVE).alias("target"), F.col("成交标签").alias("deal"), F.col("is_final_ordered").alias("final")))


@query("c3_order_after_drive", LEADS_SQL + "SELECT id, " + ", ".join(
    _flag_sql(_within(ORDER, n), f"order_{n}") for n in (7, 14, 21)) + f", round({ORDER} / 86400.0, 6) AS days FROM leads")
def order_after_drive(spark, folder):
    out = leads(spark, folder, "lines").transform(lb.order_after_drive_labels)
    return tidy(out.select(lead_id(), *[F.col(f"下订标签_{n}天").alias(f"order_{n}") for n in (7, 14, 21)], F.col("试驾后下订天数差").alias("days")))


@query("c4_drive_date_labels", LEADS_SQL + """, d AS (SELECT id, date_diff('day', CAST(created AS DATE), CAST(driven AS DATE)) AS days FROM leads)
SELECT id, CAST(days AS BIGINT) AS days, """ + ", ".join(_flag_sql(f"days <= {n}", f"label_{n}") for n in (7, 14, 21)) + """,
       CASE WHEN days IS NULL THEN 'N' WHEN days <= 7 THEN 'H' WHEN days <= 14 THEN 'A' WHEN days <= 21 THEN 'B' ELSE 'O' END AS grade
FROM d""")
def drive_date_labels(spark, folder):
    out = leads(spark, folder, "lines").transform(lb.drive_date_labels)
    return tidy(out.select(
        lead_id(), F.col("试驾天数差").alias("days"), *[F.col(f"label_{n}天内试驾").alias(f"label_{n}") for n in (7, 14, 21)],
        F.col("label_OHAB").alias("grade")))


@query("c5_order_date_labels", LEADS_SQL + """, d AS (SELECT id, date_diff('day', CAST(driven AS DATE), CAST(ordered AS DATE)) AS days FROM leads)
SELECT id, CAST(days AS BIGINT) AS days, """ + ", ".join(_flag_sql(f"days BETWEEN 0 AND {n}", f"order_{n}") for n in (7, 14, 21)) + " FROM d")
def order_date_labels(spark, folder):
    out = leads(spark, folder, "lines").transform(lb.order_date_labels)
    return tidy(out.select(lead_id(), F.col("下订天数差").alias("days"), *[F.col(f"下订标签_{n}天").alias(f"order_{n}") for n in (7, 14, 21)]))


@query("c6_creation_time", LEADS_SQL + """
SELECT id, CAST(isodow(created) AS BIGINT) AS weekday, CAST(hour(created) AS BIGINT) AS hour FROM leads""")
def creation_time(spark, folder):
    out = base(spark, folder).transform(lb.creation_time_features)
    return tidy(out.select(lead_id(), F.col("线索创建星期几").alias("weekday"), F.col("线索创建小时").alias("hour")))


@query("c7_time_parts", LEADS_SQL + """
SELECT id, CAST(isodow(touched) - 1 AS BIGINT) AS weekday, CAST(hour(touched) AS BIGINT) AS hour,
       CAST(coalesce(isodow(touched) >= 6, false) AS BIGINT) AS weekend FROM leads""")
def time_parts(spark, folder):
    out = ft.time_parts(base(spark, folder))
    t = v.FIRST_TOUCH
    return tidy(out.select(
        lead_id(), F.col(f"{t}_day_of_week").alias("weekday"), F.col(f"{t}_hour").alias("hour"), F.col(f"{t}_is_weekend").alias("weekend")))


@query("c8_numbers", """
SELECT event_id, try_cast(event_type AS DOUBLE) AS a, round(try_cast(CAST(value AS VARCHAR) AS DOUBLE), 6) AS b FROM events""")
def numbers(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("通话次数"), F.col("value").cast("string").alias("通话总时长"))
    out = ft.numbers(df)
    return tidy(out.select("event_id", F.col("通话次数").alias("a"), F.col("通话总时长").alias("b")))


BANDS_SQL = LEADS_SQL + """, r AS (SELECT id, (epoch(touched) - epoch(created)) / 3600.0 AS hours FROM leads)
SELECT id, round(hours, 6) AS hours, CASE WHEN coalesce(hours, -1) <= -1 THEN 'nan' WHEN hours <= 0 THEN '未知' WHEN hours <= 1 THEN '即时'
       WHEN hours <= 4 THEN '快速' WHEN hours <= 24 THEN '正常' ELSE '延迟' END AS band FROM r"""


@query("c9_c10_response", BANDS_SQL)
def response(spark, folder):
    df = base(spark, folder)
    new = ft.interaction_columns(df)
    return tidy(df.select(lead_id(), new["首触响应时长_小时"].alias("hours"), new["响应及时性"].alias("band")))


@query("c11_channel_combination", LEADS_SQL + """
SELECT id, coalesce(channel1, '未知') || '_' || coalesce(channel2, '未知') AS combination FROM leads""")
def channel_combination(spark, folder):
    df = leads(spark, folder, "place")
    return tidy(df.select(lead_id(), ft.interaction_columns(df)["渠道组合"].alias("combination")))


@query("a18_city_car_heat", LEADS_SQL + """
SELECT coalesce(city, '未知') AS heat_city, coalesce(car, '未知') AS heat_car, count(*) AS heat FROM leads GROUP BY ALL""")
def city_car_heat(spark, folder):
    return tidy(ft.fit_heat(leads(spark, folder, "place", "car")))


@query("j6_c12_heat_lookup", LEADS_SQL + """, heat AS (
SELECT coalesce(city, '未知') AS hc, coalesce(car, '未知') AS hk, count(*) AS heat FROM leads WHERE created < TIMESTAMP '1996-01-01' GROUP BY ALL)
SELECT id, coalesce(heat, 0) AS heat FROM leads LEFT JOIN heat ON hc = coalesce(city, '未知') AND hk = coalesce(car, '未知')""")
def heat_lookup(spark, folder):
    df = leads(spark, folder, "place", "car")
    heat = ft.stored_lookup(ft.fit_heat(df.where(F.col(v.CREATED) < "1996-01-01")))
    return tidy(ft.add_heat(df, heat).select(lead_id(), F.col("城市车型热度").alias("heat")))


@query("c13_c14_calls", LEADS_SQL + """
SELECT id, round(coalesce(call_seconds / nullif(calls, 0), 0), 6) AS mean_seconds,
       CAST(coalesce(calls > 0 AND call_seconds > 60, false) AS BIGINT) AS effective FROM leads""")
def calls(spark, folder):
    df = leads(spark, folder, "lines")
    new = ft.interaction_columns(df)
    return tidy(df.select(lead_id(), new["平均通话时长_派生"].alias("mean_seconds"), new["有效通话"].alias("effective")))


@query("c15_semantic_labels", LEADS_SQL + """
SELECT id, CAST(coalesce(ask_time <> '', false) OR coalesce(ask_benefit <> '', false) OR coalesce(ask_finance <> '', false)
            OR coalesce(add_wechat <> '', false) OR coalesce(too_far <> '', false) AS BIGINT) AS available,
  CAST(coalesce(ask_time = '是', false) AS BIGINT) + CAST(coalesce(ask_benefit = '是', false) AS BIGINT)
  + CAST(coalesce(ask_finance = '是', false) AS BIGINT) + CAST(coalesce(add_wechat = '是', false) AS BIGINT)
  + CAST(coalesce(too_far = '是', false) AS BIGINT) AS hits FROM leads""")
def semantic_labels(spark, folder):
    df = base(spark, folder)
    new = ft.interaction_columns(df)
    return tidy(df.select(lead_id(), new["AI语义标签可用"].alias("available"), new["语义标签命中数"].alias("hits")))


@query("c16_followups_available", """
SELECT event_id, CAST(CASE WHEN event_id % 4 = 0 THEN false WHEN event_id % 4 = 1 THEN false WHEN event_id % 4 = 2 THEN false ELSE true END AS BIGINT) AS available
FROM events""")
def followups_available(spark, folder):
    k = F.col("event_id")
    df = table(spark, folder, "events").select(
        "event_id", F.when(k % 4 == 0, "{}").when(k % 4 == 1, " ").when(k % 4 == 3, F.col("props")).alias(v.FOLLOWUPS))
    return tidy(df.select("event_id", ft.interaction_columns(df)["JSON跟进明细可用"].alias("available")))


@query("c17_fitted_features", LEADS_SQL + """, train AS (
SELECT coalesce(city, '未知') AS hc, coalesce(car, '未知') AS hk, count(*) AS heat FROM leads WHERE created < TIMESTAMP '1996-01-01' GROUP BY ALL)
SELECT id, CAST(coalesce(heat, 0) AS BIGINT) AS heat, CAST(isodow(created) - 1 AS BIGINT) AS weekday,
       round(coalesce(call_seconds / nullif(calls, 0), 0), 6) AS mean_seconds
FROM leads LEFT JOIN train ON hc = coalesce(city, '未知') AND hk = coalesce(car, '未知') WHERE created >= TIMESTAMP '1996-01-01'""")
def fitted_features(spark, folder):
    df = leads(spark, folder, "lines", "place", "car")
    _, heat = ft.fit_transform(df.where(F.col(v.CREATED) < "1996-01-01"))
    out = ft.transform(df.where(F.col(v.CREATED) >= "1996-01-01"), heat)
    return tidy(out.select(
        lead_id(), F.col("城市车型热度").alias("heat"), F.col("线索创建时间_day_of_week").alias("weekday"), F.col("平均通话时长_派生").alias("mean_seconds")))


@query("c18_stage_labels", LEADS_SQL + """
SELECT id, CASE WHEN rating = 'H' THEN 'H' ELSE '非H' END AS stage1, CASE WHEN rating <> 'H' THEN rating END AS stage2 FROM leads""")
def stage_labels(spark, folder):
    df = base(spark, folder)
    one = df.select(lead_id(), policy.stage_one_label(F.col(v.RATING_RESULT)).alias("stage1"))
    two = policy.stage_two_rows(df, v.RATING_RESULT).select(F.col(v.LEAD_ID).alias("id"), F.col("stage2_label").alias("stage2"))
    return tidy(one.join(two, "id", "left"))


@query("c19_label_policy", LEADS_SQL + """, small AS (SELECT id, CASE WHEN rating = 'O' AND id % 1000 <> 0 THEN 'A' ELSE rating END AS rating FROM leads WHERE rating IS NOT NULL),
o AS (SELECT count(*) AS n FROM small WHERE rating = 'O')
SELECT id, CASE WHEN rating = 'O' AND n > 0 AND n < 50 THEN 'H' ELSE rating END AS label FROM small, o""")
def label_policy(spark, folder):
    k = F.col(v.LEAD_ID)
    rare = F.when((F.col(v.RATING_RESULT) == "O") & (k % 1000 != 0), "A").otherwise(F.col(v.RATING_RESULT))
    df = base(spark, folder).withColumn(v.RATING_RESULT, rare)
    rule = policy.build_policy(df, v.RATING_RESULT)
    return tidy(policy.keep_effective(policy.apply_policy(df, v.RATING_RESULT, rule), v.RATING_RESULT, rule).select(
        lead_id(), F.col(v.RATING_RESULT).alias("label")))


# --- follow-up records: every line of a conversation turn is one record of its lead ---------

def conversation_records(spark, folder):
    """JSON records per turn: level, call result and duration follow from the length of the line."""

    def record(line):
        n = F.length(line)
        level = F.element_at(F.array(*[F.lit(x) for x in ("O", "H", "A", "B", "")]), (n % 5 + 1).cast("int"))
        return F.struct(
            level.alias(v.LEVEL_FIELD),
            F.when(n % 3 == 0, v.CONNECTED).when(n % 3 == 1, v.NOT_CONNECTED).otherwise("").alias(v.CALL_FIELD),
            F.when(n % 4 == 0, v.DEFEATED).when(n % 4 < 3, v.CONTINUED).otherwise("").alias(v.RESULT_FIELD),
            F.when(n % 6 == 5, "bad").when(n % 6 == 4, "1:2:3").otherwise(
                F.concat((n % 7).cast("string"), F.lit(":"), (n % 60).cast("string"))).alias(v.DURATION_FIELD),
            F.when(n % 11 == 0, "想问优惠").when(n % 11 == 1, "预约试驾").when(n % 11 == 2, "下周去看车")
            .when(n % 11 == 3, "比较蔚来").otherwise("").alias(v.MEMO_FIELD))

    records = F.transform(F.split("text", "\n"), record)
    return table(spark, folder, "conversations").select("conv_id", "turn", F.to_json(records).alias(v.FOLLOWUPS))


RECORDS_SQL = """
WITH r AS (
  SELECT conv_id, turn, pos, length(line) AS n FROM (
    SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM conversations)),
f AS (
  SELECT *, CASE n % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 END AS level,
    CASE n % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS call,
    CASE WHEN n % 6 < 4 THEN (n % 7) * 60 + n % 60 END AS seconds FROM r)
SELECT conv_id, turn, count(*) AS records, count(*) FILTER (call = 'yes') AS connected, count(*) FILTER (call = 'no') AS unconnected,
  round(coalesce(count(*) FILTER (call = 'yes') / nullif(count(call), 0), 0), 6) AS connect_rate,
  count(*) FILTER (n % 4 IN (1, 2)) AS continued, bool_or(n % 4 = 0) AS defeated,
  coalesce(arg_max(level, pos) FILTER (level IS NOT NULL) < arg_min(level, pos) FILTER (level IS NOT NULL), false) AS dropped,
  bool_or(n % 11 = 0) AS price, bool_or(n % 11 = 1) AS drive, bool_or(n % 11 = 2) AS store, bool_or(n % 11 = 3) AS competitor,
  round(coalesce(avg(seconds), 0), 1) AS mean_seconds, CAST(coalesce(max(seconds), 0) AS BIGINT) AS max_seconds
FROM f GROUP BY conv_id, turn"""
SHORT = dict(zip(fu.FEATURES, ("records", "connected", "unconnected", "connect_rate", "continued", "defeated", "dropped", "price",
                               "drive", "store", "competitor", "mean_seconds", "max_seconds")))


@query("k1_k13_followup_features", RECORDS_SQL)
def followup_features(spark, folder):
    out = fu.add_followup_features(conversation_records(spark, folder), drop_source=True)
    out = out.withColumn("平均通话时长_秒", F.round("平均通话时长_秒", 1))
    return tidy(out.withColumnsRenamed(SHORT))


@query("k14_followups_lone_object", """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS records, CAST(0 AS BIGINT) AS connected FROM events""")
def lone_objects(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit("{ }")).otherwise(F.col("props")).alias("detail"))
    out = fu.add_followup_features(df, "detail")
    return tidy(out.select("event_id", F.col("跟进总次数").alias("records"), F.col("接通次数").alias("connected")))
