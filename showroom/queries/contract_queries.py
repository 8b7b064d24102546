"""Schema contract, projections, screening and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import labels as lb
from showroom.functions import status
from showroom.functions.followups import add_followup_features
from showroom.operators import cleaning, contract as ct, policy, profiling, splits
from showroom.plans.lead_view import LEADS_SQL, base, leads, table
from showroom.queries.registry import lead_id, query, tidy



def _names(spark, rows, schema="item string, value string"):
    return spark.createDataFrame(rows, schema)


@query("p1_alias_contract", LEADS_SQL + """
SELECT id, CASE WHEN id % 4 = 0 THEN ' ' WHEN id % 4 = 1 AND phone IS NULL THEN NULL
            WHEN id % 4 = 1 THEN phone ELSE CAST(id AS VARCHAR) END AS gender, channel2 AS budget,
       CAST(coalesce(CASE WHEN id % 3 <> 0 THEN id END, id * 2) AS BIGINT) AS orders
FROM leads""")
def alias_contract(spark, folder):
    k = F.col(v.LEAD_ID)
    raw = base(spark, folder).select(
        k,
        F.when(k % 4 == 0, " ").when(k % 4 == 1, F.lit(None)).otherwise(k.cast("string")).alias("客户性别"),
        F.when(k % 4 == 0, "").otherwise(F.col(v.PHONE)).alias("客户性别_备用"),
        F.col("二级渠道名称").alias("预算区间(购车预算)"),
        F.when(k % 3 != 0, k).alias("历史订单次数"),
        (k * 2).alias("历史订单次数_备用"),
    )
    out, report = ct.apply_alias_contract(raw)
    assert report.filled_aliases == {"客户性别_备用": "客户性别", "历史订单次数_备用": "历史订单次数"}
    assert report.applied_aliases == {"预算区间(购车预算)": "预算区间"}
    return tidy(out.select(lead_id(), F.col("客户性别").alias("gender"), F.col("预算区间").alias("budget"), F.col("历史订单次数").alias("orders")))


@query("p2_normalised_names", 'SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus AS "客户ID_店端" FROM orders')
def normalised_names(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order（key）"), F.col("o_custkey").alias("customer//id_"), F.col("o_orderstatus").alias("客户ID(店端)"))
    return ct.normalise_names(raw)


def labelled(spark, folder, *parts):
    return leads(spark, folder, "lines", *parts).transform(lb.target_labels)


@query("p3_training_projection", LEADS_SQL + """
SELECT epoch_us(created) AS created, channel2, CAST(calls AS BIGINT) AS calls,
       CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS BIGINT) AS target,
       CAST(17 AS BIGINT) AS kept
FROM leads""")
def training_projection(spark, folder):
    out = ct.training_projection(labelled(spark, folder), "试驾标签_14天")
    return tidy(out.select(
        F.col(v.CREATED).alias("created"), F.col("二级渠道名称").alias("channel2"), F.col("通话次数").alias("calls"),
        F.col("试驾标签_14天").alias("target"), F.lit(len(out.columns)).alias("kept")))


@query("p6_window_projections", LEADS_SQL + """, d AS (
SELECT epoch(driven) - epoch(created) AS to_drive, epoch(ordered) - epoch(driven) AS to_order FROM leads)
SELECT target, CAST(siblings AS BIGINT) AS siblings, false AS leaks, count(*) AS n,
       count(*) FILTER (WHERE (target LIKE '试驾%' AND to_drive BETWEEN 0 AND days * 86400)
                           OR (target LIKE '下订%' AND to_order BETWEEN 0 AND days * 86400)) AS positives
FROM d, (VALUES ('试驾标签_7天', 3, 7), ('试驾标签_14天', 3, 14), ('试驾标签_21天', 3, 21),
                ('下订标签_7天', 2, 7), ('下订标签_14天', 2, 14), ('下订标签_21天', 2, 21)) t(target, siblings, days)
GROUP BY target, siblings""")
def window_projections(spark, folder):
    """The projections are lists of names; one aggregate counts for all of them."""
    df = labelled(spark, folder)
    targets = ("试驾标签_7天", "试驾标签_14天", "试驾标签_21天", "下订标签_7天", "下订标签_14天", "下订标签_21天")
    columns = {t: ct.training_projection(df, t).columns for t in targets}
    assert all(t in c for t, c in columns.items())
    sums = df.agg(F.count("*").alias("n"), *[F.sum(t).alias(t) for t in targets])
    rows = [
        F.struct(
            F.lit(t).alias("target"), F.lit(len(ct.sibling_labels(t))).alias("siblings"), F.lit(bool(ct.remaining_leaks(columns[t], t))).alias("leaks"),
            F.col("n"), F.col(t).alias("positives"))
        for t in targets]
    return tidy(sums.select(F.explode(F.array(*rows)).alias("x")).select("x.*"))


@query("p7_order_stage_projection", LEADS_SQL + """
SELECT epoch_us(driven) AS driven, channel2, paid, false AS has_rating, false AS has_id FROM leads""")
def order_stage_projection(spark, folder):
    out = ct.order_stage_projection(leads(spark, folder, "lines"), keep=["意向金支付状态"])
    return tidy(out.select(
        F.col(v.DRIVEN).alias("driven"), F.col("二级渠道名称").alias("channel2"), F.col("意向金支付状态").alias("paid"),
        F.lit(v.RATING_RESULT in out.columns).alias("has_rating"), F.lit(v.LEAD_ID in out.columns).alias("has_id")))


@query("p8_feature_columns", LEADS_SQL + """
SELECT channel2, ask_time, CAST(past_orders AS BIGINT) AS past_orders, rating FROM leads""")
def feature_columns(spark, folder):
    df = base(spark, folder)
    features = ct.feature_columns(df.columns, v.RATING_RESULT)
    assert v.LEAD_ID not in features and v.RATING_RESULT not in features and "p7" in features
    return tidy(df.select(*features, v.RATING_RESULT).select(
        F.col("二级渠道名称").alias("channel2"), F.col("客户是否主动询问交车时间").alias("ask_time"),
        F.col("历史订单次数").alias("past_orders"), F.col(v.RATING_RESULT).alias("rating")))


@query("p9_aligned_features", 'WITH q AS (' + LEADS_SQL + """
SELECT round(p14, 6) AS p14, round(p7, 6) AS p7, rating AS "线索评级结果" FROM leads) SELECT * FROM q""")
def aligned_features(spark, folder):
    return tidy(ct.align_to_features(base(spark, folder), ["p14", "p7"], v.RATING_RESULT))


@query("p10_scoring_projection", LEADS_SQL + """
SELECT rating AS "线索评级结果", true AS keeps_labels, false AS keeps_ids FROM leads""")
def scoring_projection(spark, folder):
    df = labelled(spark, folder)
    out = ct.scoring_projection(df, ct.excluded_columns("试驾标签_14天"))
    return out.select(
        v.RATING_RESULT, F.lit("到店标签_7天" in out.columns).alias("keeps_labels"), F.lit(v.LEAD_ID in out.columns).alias("keeps_ids"))


@query("p11_collision_names", """
SELECT event_id, user_id AS "跟进总次数", CAST(1 AS BIGINT) AS "跟进总次数_json", event_type AS "接通率", event_type AS "接通率_json",
       false AS "最终战败" FROM events""")
def collision_names(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.col("user_id").alias("跟进总次数"), F.col("event_type").alias("接通率"),
        F.col("event_type").alias("接通率_json"), F.col("props").alias(v.FOLLOWUPS))
    out = add_followup_features(df, drop_source=True)
    return tidy(out.select("event_id", "跟进总次数", "跟进总次数_json", "接通率", "接通率_json", "最终战败"))


def wide(spark, folder):
    """Lead columns of every screening kind: empty, mostly empty, constant, weak, normal."""
    k = F.col(v.LEAD_ID)
    return base(spark, folder).select(
        v.LEAD_ID, v.CREATED, v.RATING_RESULT, "二级渠道名称", "p7",
        F.when(k % 50 == 0, "x").alias("预算区间"),
        F.when(k % 5 == 0, "是").alias("客户是否主动询问购车权益"),
        F.when(k % 5 != 0, "否").alias("客户是否同意加微信"),
        F.lit(7).alias("常数字段"),
        F.when(k % 2 == 0, "y").alias("半空字段"),
        (k % 9).alias("跟进内容_备用"),
        F.col(v.PHONE).alias("SOP开口标签"),
    )


SCREEN_SQL = """
SELECT * FROM (VALUES ('added_missing_indicators', '客户是否主动询问购车权益_缺失'), ('dropped_high_missing', '预算区间'),
 ('dropped_weak_semantic', '跟进内容_备用')) t(item, value)"""


def _report_rows(report):
    return [(k, c) for k, cs in report.items() if isinstance(cs, list) for c in cs]


@query("p12_raw_screening", SCREEN_SQL)
def raw_screening(spark, folder):
    _, report = ct.screen_raw(wide(spark, folder), v.RATING_RESULT)
    return _names(spark, _report_rows(report))


@query("p13_feature_screening", """
SELECT * FROM (VALUES ('dropped_constant', '常数字段'), ('dropped_constant', '半空字段'), ('dropped_constant', '客户是否主动询问购车权益'),
 ('dropped_constant', '客户是否同意加微信'), ('dropped_high_missing', '预算区间')) t(item, value)""")
def feature_screening(spark, folder):
    _, report = ct.screen_features(wide(spark, folder), v.RATING_RESULT)
    return _names(spark, _report_rows(report))


@query("p14_screening_replay", LEADS_SQL + """
SELECT id, CAST(id % 5 <> 0 AS BIGINT) AS marked, CAST(7 AS BIGINT) AS columns FROM leads""")
def screening_replay(spark, folder):
    df = wide(spark, folder)
    _, report = ct.screen_all(df, v.RATING_RESULT)
    out = ct.replay_screening(df, report)
    return tidy(out.select(lead_id(), F.col("客户是否主动询问购车权益_缺失").alias("marked"), F.lit(len(out.columns)).alias("columns")))


@query("p15_leakage_residual", LEADS_SQL + """
SELECT "column", n AS missing_count FROM (
  SELECT count(*) - count(paid) AS "意向金支付状态", count(*) - count(rating) AS "线索评级结果", count(*) - count(arrived) AS "到店时间",
         count(*) - count(driven) AS "试驾时间", count(*) - count(ordered) AS "下订时间" FROM leads)
UNPIVOT (n FOR "column" IN ("意向金支付状态", "线索评级结果", "到店时间", "试驾时间", "下订时间"))""")
def leakage_residual(spark, folder):
    df = leads(spark, folder, "lines")
    return profiling.missing_by_column(df.select(*ct.leakage_residual(df))).select("column", "missing_count")


# --- filters ----------------------------------------------------------------------------


@query("f1_driven_leads", LEADS_SQL + """
SELECT count(*) AS before, count(driven) AS after FROM leads""")
def driven_leads(spark, folder):
    df = leads(spark, folder, "lines")
    return tidy(df.agg(F.count("*").alias("before"), F.count_if(status.is_driven(df.select(v.DRIVEN))).alias("after")))


@query("f2_known_target", LEADS_SQL + """
SELECT id, rating FROM leads WHERE rating IS NOT NULL""")
def known_target(spark, folder):
    df = base(spark, folder).transform(lb.outcome_labels)
    return tidy(policy.drop_unknown(df, v.RATING_BEFORE_DRIVE).select(lead_id(), F.col(v.RATING_BEFORE_DRIVE).alias("rating")))


@query("f3_effective_labels", LEADS_SQL + """
SELECT id, rating FROM leads WHERE rating IN ('H', 'A', 'B')""")
def effective_labels(spark, folder):
    df = base(spark, folder)
    rule = policy.build_policy(df, v.RATING_RESULT, mode="hab")
    return tidy(policy.keep_effective(df, v.RATING_RESULT, rule).select(lead_id(), F.col(v.RATING_RESULT).alias("rating")))


@query("f4_test_isolation", LEADS_SQL + """
SELECT id FROM leads WHERE created >= TIMESTAMP '1997-01-01'""")
def test_isolation(spark, folder):
    return tidy(splits.isolate_test(base(spark, folder), {"mode": "oot", "valid_end": "1997-01-01"}).select(lead_id()))


@query("j4_recorded_test_ids", LEADS_SQL + """
SELECT id, phone FROM leads WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def recorded_test_ids(spark, folder):
    recorded = table(spark, folder, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias(v.LEAD_ID))
    out = splits.isolate_test(base(spark, folder), {"mode": "random", "id_column": v.LEAD_ID}, recorded)
    return tidy(out.select(lead_id(), F.col(v.PHONE).alias("phone")))


def status_leads(spark, folder):
    df = leads(spark, folder, "lines")
    k = F.col(v.LEAD_ID)
    return df.withColumns({
        v.ORDERED: F.when(k % 3 == 0, F.col(v.ORDERED)),
        v.DRIVEN: F.when(k % 2 == 0, F.col(v.DRIVEN)),
        "试驾状态": F.when(k % 13 == 0, "客户已试驾两次").otherwise("未安排"),
        "订单状态": F.when(k % 17 == 0, "订单已完成").otherwise("进行中"),
        "战败原因": F.when(k % 7 == 0, "客户已购车了").when(k % 7 == 1, "价格"),
        "线索类型": F.when(k % 19 == 0, "测试线索").otherwise("普通"),
        "手机号": F.when(k % 23 == 0, "00000000000").when(k % 23 == 1, " 138 ").otherwise(F.col(v.PHONE)),
    })


STATUS_SQL = LEADS_SQL + """, status AS (
SELECT id, p7, p14, p21,
  (id % 3 = 0 AND ordered IS NOT NULL) OR id % 17 = 0 OR coalesce(paid = '已支付', false) AS is_ordered,
  (id % 2 = 0 AND driven IS NOT NULL) OR id % 13 = 0 AS is_driven,
  id % 7 = 0 OR id % 19 = 0 OR id % 23 IN (0, 1) AS is_invalid
FROM leads)
"""


@query("f5_ordered_status", STATUS_SQL + "SELECT id, is_ordered FROM status")
def ordered_status(spark, folder):
    df = status_leads(spark, folder)
    return df.select(lead_id(), status.is_ordered(df).alias("is_ordered"))


@query("f6_driven_status", STATUS_SQL + "SELECT id, is_driven FROM status")
def driven_status(spark, folder):
    df = status_leads(spark, folder)
    return df.select(lead_id(), status.is_driven(df).alias("is_driven"))


@query("f7_invalid_status", STATUS_SQL + "SELECT id, is_invalid FROM status")
def invalid_status(spark, folder):
    df = status_leads(spark, folder)
    return df.select(lead_id(), status.is_invalid(df).alias("is_invalid"))


LINES = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]


@query("f8_distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, round(l_quantity, 6) AS l_quantity, round(l_discount, 6) AS l_discount FROM lineitem""")
def distinct_rows(spark, folder):
    return tidy(cleaning.drop_duplicates(table(spark, folder, "lineitem").select(*LINES)))


def _dropped(spark, before, after):
    return _names(spark, [(c,) for c in before.columns if c not in after.columns], "item string")


@query("f9_high_missing", """
SELECT * FROM (VALUES ('预算区间'), ('客户是否主动询问购车权益')) t(item)""")
def high_missing(spark, folder):
    df = wide(spark, folder)
    return _dropped(spark, df, cleaning.drop_high_missing(df))


@query("f10_constant_columns", "SELECT '常数字段' AS item")
def constant_columns(spark, folder):
    df = wide(spark, folder)
    return _dropped(spark, df, cleaning.drop_constant(df))


@query("f11_cleaning_log", """
WITH w AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax,
                  CASE WHEN l_orderkey % 3 = 0 THEN l_tax END AS mostly_null FROM lineitem),
d AS (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax FROM w)
SELECT 'dropped_column' AS action, 'mostly_null' AS "column", 'high_missing' AS detail UNION ALL
SELECT 'dropped_column', 'fixed', 'constant' UNION ALL
SELECT 'rows_before', '', CAST(count(*) AS VARCHAR) FROM w UNION ALL
SELECT 'rows_after', '', CAST(count(*) AS VARCHAR) FROM d UNION ALL
SELECT 'dropped_rows', '', CAST((SELECT count(*) FROM w) - count(*) AS VARCHAR) FROM d UNION ALL
SELECT 'columns_before', '', '7' UNION ALL SELECT 'columns_after', '', '5'""")
def cleaning_log(spark, folder):
    df = table(spark, folder, "lineitem").select(
        *LINES, "l_tax", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_tax")).alias("mostly_null"), F.lit("one").alias("fixed"))
    cleaned, log = cleaning.clean(df)
    return cleaning.clean_log_table(cleaned, log)
