"""Ratings, scorecard, reasons and actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import actions as ac
from showroom.functions import ratings as rt
from showroom.functions import scorecard as sc
from showroom.functions.cells import present, truthy
from showroom.operators import features as ft
from showroom.plans.lead_view import LEADS_SQL, base, leads
from showroom.queries.contract_queries import STATUS_SQL, status_leads
from showroom.queries.registry import lead_id, query, tidy



def drive():
    return {7: F.col("p7"), 14: F.col("p14"), 21: F.col("p21")}


def order():
    return {7: F.col("p21"), 14: F.col("p7"), 21: F.col("p14")}


def _score_sql(p7, p14, p21):
    return (f"((CASE WHEN {p7} > 0 THEN {p7} ELSE 0 END) * 100 + (CASE WHEN {p14} > 0 THEN {p14} ELSE 0.5 END) * 60"
            f" + (CASE WHEN {p21} > 0 THEN {p21} ELSE 0 END) * 30) / 190.0 * 100")


def _window_sql(p7, p14, p21):
    return f"CASE WHEN {p7} >= 0.5 THEN 'H' WHEN {p14} >= 0.5 THEN 'A' WHEN {p21} >= 0.5 THEN 'B' ELSE 'C' END"


def _short(df):
    return tidy(df.select(lead_id(), F.col("评级").alias("rating"), F.col("阶段").alias("stage"), F.col("__raw").alias("score")))


def _rated(spark, folder, mode, order=None):
    """Rated leads, the score taken to one digit from its unrounded parts."""
    df = rt.add_rating(status_leads(spark, folder), mode, drive(), order)
    return df.withColumn("__raw", F.round("分值", 1))


SIMPLE = "CASE WHEN p14 >= 0.5 THEN 'H' WHEN p14 >= 0.35 THEN 'A' WHEN p14 >= 0.15 THEN 'B' ELSE 'C' END"


@query("r1_rating_simple", STATUS_SQL + f"""
SELECT id, CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN 'N' ELSE {SIMPLE} END AS rating,
       CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN '无效' ELSE '试驾前' END AS stage FROM status""")
def rating_simple(spark, folder):
    return _short(_rated(spark, folder, "simple")).drop("score")


@query("r2_rating_medium", STATUS_SQL + f"""
SELECT id, CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN 'N' ELSE {_window_sql('p7', 'p14', 'p21')} END AS rating,
       CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN '无效' ELSE '试驾前' END AS stage FROM status""")
def rating_medium(spark, folder):
    return _short(_rated(spark, folder, "medium")).drop("score")


@query("r3_rating_advanced", STATUS_SQL + f"""
SELECT id, CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN 'N' WHEN is_driven THEN {_window_sql('p21', 'p7', 'p14')}
                ELSE {_window_sql('p7', 'p14', 'p21')} END AS rating,
       CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN '无效' WHEN is_driven THEN '试驾后' ELSE '试驾前' END AS stage FROM status""")
def rating_advanced(spark, folder):
    return _short(_rated(spark, folder, "advanced", order())).drop("score")


@query("r4_rating_scores", STATUS_SQL + f""", g AS (SELECT *, CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN 'N' ELSE 'C' END AS rating FROM status)
SELECT rating, count(*) AS n, round(avg(CASE rating WHEN 'O' THEN 100 WHEN 'N' THEN 0 ELSE {_score_sql('p7', 'p14', 'p21')} END), 3) AS mean_score FROM g GROUP BY rating""")
def rating_scores(spark, folder):
    df = status_leads(spark, folder)
    kind = F.when(rt.is_ordered(df), "O").when(rt.is_invalid(df), "N").otherwise("C")
    out = df.withColumn("rating", kind).withColumn("s", rt.score(F.col("rating"), *drive().values()))
    return tidy(out.groupBy("rating").agg(F.count("*").alias("n"), F.round(F.avg("s"), 3).alias("mean_score")))


@query("r5_rating_distribution", STATUS_SQL + f""", g AS (SELECT CASE WHEN is_ordered THEN 'O' WHEN is_invalid THEN 'N' ELSE {_window_sql('p7', 'p14', 'p21')} END AS r FROM status)
SELECT rating, count(r) AS n FROM (VALUES ('O'), ('H'), ('A'), ('B'), ('C'), ('N')) t(rating) LEFT JOIN g ON r = rating GROUP BY rating""")
def rating_distribution(spark, folder):
    return rt.rating_distribution(rt.add_rating(status_leads(spark, folder), "medium", drive()))


@query("r6_hab_rating", LEADS_SQL + """, g AS (SELECT id, p7, p14, p21, CASE WHEN p7 >= 0.5 THEN 'H' WHEN p14 >= 0.5 THEN 'A' WHEN p21 >= 0.5 THEN 'B' ELSE 'N' END AS rating FROM leads)
SELECT id, rating, round(CASE WHEN rating = 'N' THEN greatest(p7, p14, p21) ELSE least(greatest(p7, p14, p21), 1) END, 6) AS confidence,
 CASE rating WHEN 'H' THEN '高意向，7天内计划试驾（P(7天试驾)=' || printf('%.2f%%', p7 * 100) || '）'
  WHEN 'A' THEN '中意向，14天内计划试驾（P(14天试驾)=' || printf('%.2f%%', p14 * 100) || '，P(7天试驾)=' || printf('%.2f%%', p7 * 100) || '）'
  WHEN 'B' THEN '低意向，21天内计划试驾（P(21天试驾)=' || printf('%.2f%%', p21 * 100) || '，P(14天试驾)=' || printf('%.2f%%', p14 * 100) || '）'
  ELSE '无意向，暂无试驾计划（所有时间窗口概率均低于阈值50%）' END AS explanation,
 CAST(CASE rating WHEN 'H' THEN 3 WHEN 'A' THEN 7 WHEN 'B' THEN 14 END AS BIGINT) AS next_contact_days FROM g""")
def hab_rating(spark, folder):
    df = base(spark, folder)
    return tidy(df.select(lead_id(), *[c.alias(n) for n, c in rt.hab_columns(*drive().values()).items()]))


@query("r7_factor_lists", LEADS_SQL + """, c AS (SELECT id, unnest(['a', 'b', 'c', 'd', 'e', 'f']) AS name,
  unnest([p7 - 0.5, 0.5 - p14, p21 - 0.25, p7 - p14, p14 - p21, 0.1]) AS value, unnest([1, 2, 3, 4, 5, 6]) AS pos FROM leads),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, pos) AS k FROM c)
SELECT id, coalesce(string_agg(name, ',' ORDER BY k) FILTER (k <= 3 AND value > 0), '') AS positive,
       coalesce(string_agg(name, ',' ORDER BY k) FILTER (k <= 5 AND value < 0), '') AS risk FROM r GROUP BY id""")
def factor_lists(spark, folder):
    p7, p14, p21 = drive().values()
    values = [p7 - 0.5, 0.5 - p14, p21 - 0.25, p7 - p14, p14 - p21, F.lit(0.1)]
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), x.alias("value")) for n, x in zip("abcdef", values)])
    df = base(spark, folder).withColumn("pairs", pairs)
    lists = rt.factor_lists(F.col("pairs"))
    names = lambda c: F.array_join(F.transform(c, lambda t: F.substring_index(t, ":", 1)), ",")
    return df.select(lead_id(), names(lists["positive_factors"]).alias("positive"), names(lists["risk_factors"]).alias("risk"))


SCORED_SQL = LEADS_SQL


@query("r8_class_engine", SCORED_SQL + """
SELECT id, CASE WHEN ph >= 0.5 THEN 'H' WHEN pa >= 0.4 THEN 'A' WHEN pb >= 0.3 THEN 'B' ELSE 'N' END AS rating FROM scored""")
def class_engine(spark, folder):
    df = leads(spark, folder, "classes")
    return tidy(df.select(lead_id(), rt.engine_columns(F.col("p_H"), F.col("p_A"), F.col("p_B"))["rating"].alias("rating")))


@query("r9_decision_policy", SCORED_SQL + """
SELECT id, CASE WHEN ph >= 0.45 THEN 'H' WHEN pb >= 0.25 THEN 'B' ELSE 'A' END AS by_threshold,
       CASE WHEN ph >= pa AND ph >= pb THEN 'H' WHEN pa >= pb THEN 'A' ELSE 'B' END AS by_maximum FROM scored""")
def decision_policy(spark, folder):
    df = leads(spark, folder, "classes")
    p = {c: F.col(f"p_{c}") for c in "HAB"}
    rule = {"strategy": "hab_threshold", "h_threshold": 0.45, "b_threshold": 0.25}
    return tidy(df.select(lead_id(), rt.apply_policy(p, rule).alias("by_threshold"), rt.apply_policy(p).alias("by_maximum")))


@query("r10_combined_stages", LEADS_SQL + """
SELECT id, CASE WHEN p7 >= 0.6 THEN 'H' WHEN p14 >= p21 THEN 'A' ELSE 'B' END AS label, round(p7, 6) AS ph,
       round((1 - p7) * p14, 6) AS pa, round((1 - p7) * p21, 6) AS pb FROM leads""")
def combined_stages(spark, folder):
    c = rt.combine_stages(*drive().values(), threshold=0.6)
    return tidy(base(spark, folder).select(
        lead_id(), c[v.PREDICTED].alias("label"), c["p_H"].alias("ph"), c["p_A"].alias("pa"), c["p_B"].alias("pb")))


def card_leads(spark, folder):
    df = leads(spark, folder, "lines", "place", "car")
    new = ft.interaction_columns(df)
    return df.withColumns({**new, "是否接通": (F.col("通话次数") > 3).cast("int"), "跟进总次数": F.col(v.LEAD_ID) % 6,
                           "接通次数": F.col(v.LEAD_ID) % 3, "提及试驾": F.col(v.LEAD_ID) % 5 == 0})


CARD_SQL = LEADS_SQL + """, f AS (SELECT *, (epoch(touched) - epoch(created)) / 3600.0 AS hours, coalesce(call_seconds / nullif(calls, 0), 0) AS mean_seconds,
  coalesce(calls > 0 AND call_seconds > 60, false) AS effective, coalesce(calls > 3, false) AS connected FROM leads),
d AS (SELECT id, p7,
  (0.30 * CAST(channel1 IS NOT NULL OR channel2 IS NOT NULL AS INTEGER) + 0.25 * CAST(car IS NOT NULL AS INTEGER) + 0.20 * CAST(city IS NOT NULL AS INTEGER)) * 100 AS basic,
  (0.35 * least((past_arrivals + past_drives) / 2.0, 1) + 0.35 * least(past_orders, 1)) * 100 AS profile,
  (0.15 * least(coalesce(calls, 0) / 4.0, 1) + 0.20 * least(coalesce(call_seconds, 0) / 900.0, 1) + 0.15 * least(mean_seconds / 300.0, 1)
   + 0.15 * CAST(connected AS INTEGER) + 0.15 * CAST(effective AS INTEGER) + 0.20 * least((id % 6 + id % 3) / 5.0, 1)) * 100 AS behavior,
  (0.45 * greatest(least(1 - coalesce(hours, 0) / 72.0, 1), 0)) * 100 AS timing,
  (CAST(coalesce(ask_time = '是', false) AS INTEGER) + CAST(coalesce(ask_benefit = '是', false) AS INTEGER) + CAST(coalesce(ask_finance = '是', false) AS INTEGER)
   + CAST(coalesce(add_wechat = '是', false) AS INTEGER) + CAST(id % 5 = 0 AS INTEGER)) / 7.0 * 100 AS intent FROM f)
"""


@query("r11_scorecard", CARD_SQL + """
SELECT id, round(CAST(basic AS DOUBLE), 4) AS basic, round(profile, 4) AS profile, round(timing, 4) AS timing, round(intent, 4) AS intent,
       CASE WHEN basic * 0.20 + profile * 0.10 + behavior * 0.25 + timing * 0.20 + intent * 0.25 >= 75 THEN 'H'
            WHEN basic * 0.20 + profile * 0.10 + behavior * 0.25 + timing * 0.20 + intent * 0.25 >= 60 THEN 'A' ELSE 'B' END AS label FROM d""")
def scorecard(spark, folder):
    out = sc.add_scorecard(card_leads(spark, folder))
    short = {"基础特征得分": "basic", "画像特征得分": "profile", "时序特征得分": "timing", "意图特征得分": "intent"}
    return tidy(out.select(lead_id(), *[F.col(a).alias(b) for a, b in short.items()], F.col(v.PREDICTED).alias("label")))


@query("r12_scorecard_shares", LEADS_SQL + """, s AS (SELECT id, p7 * 100 AS s FROM leads), p AS (SELECT id, greatest(least((s - 60) / 40.0, 1), 0) AS h,
  greatest(least(1 - abs(s - 67.5) / 22.5, 1), 0) + 0.05 AS a, greatest(least((75 - s) / 35.0, 1), 0) AS b FROM s)
SELECT id, round(h / (h + a + b), 6) AS h, round(a / (h + a + b), 6) AS a, round(b / (h + a + b), 6) AS b FROM p""")
def scorecard_shares(spark, folder):
    p = sc.score_probabilities(F.col("p7") * 100)
    return tidy(base(spark, folder).select(lead_id(), p["p_H"].alias("h"), p["p_A"].alias("a"), p["p_B"].alias("b")))


@query("r13_truthy_present", LEADS_SQL + """
SELECT id, coalesce(paid = '已支付', false) AS paid_yes, paid IS NOT NULL AS paid_there, past_arrivals > 0 AS arrived_yes,
       coalesce(ask_time <> '', false) AS asked_there FROM leads""")
def truthy_present(spark, folder):
    df = base(spark, folder)
    return tidy(df.select(
        lead_id(), truthy(df, "意向金支付状态").alias("paid_yes"), present(df, "意向金支付状态").alias("paid_there"),
        truthy(df, "历史到店次数").alias("arrived_yes"), present(df, "客户是否主动询问交车时间").alias("asked_there")))


def _conditions_sql():
    """Condition per phrase for the lead view, in phrase order."""
    yes = lambda c: f"coalesce({c} = '是', false)"
    tests = {
        "提及试驾": "id % 5 = 0", "提及到店": "false", "提及价格": "false", "客户是否主动询问金融政策": yes("ask_finance"),
        "客户是否主动询问交车时间": yes("ask_time"), "客户是否同意加微信": yes("add_wechat"), "有效通话": "effective",
        "接通率": "false", "首触响应时长_小时": "coalesce(hours > 0 AND hours <= 1, false)", "历史到店次数": "past_arrivals > 0",
        "历史试驾次数": "past_drives > 0", "客户是否表示门店距离太远拒绝到店": yes("too_far"), "最终战败": "false", "意向级别下降": "false",
        "未接通次数": "false", "通话次数": "NOT effective AND coalesce(calls, 0) > 0",
    }
    return [(tests[k], v.REASON_PHRASES[k]) for k in v.REASON_PHRASES]


def _first_sql(words):
    return "(" + " OR ".join(f"contains(r, '{w}')" for w in words) + ")"


REASON_SQL = LEADS_SQL + """, f AS (SELECT *, (epoch(touched) - epoch(created)) / 3600.0 AS hours, coalesce(calls > 0 AND call_seconds > 60, false) AS effective,
  CASE WHEN p7 >= 0.6 THEN 'H' WHEN p14 >= p21 THEN 'A' ELSE 'B' END AS label FROM leads),
c AS (SELECT id, label, p7, [""" + ", ".join(f"CASE WHEN {t} THEN '{p}' END" for t, p in _conditions_sql()) + """] AS l FROM f),
e AS (SELECT id, label, unnest(l) AS r, generate_subscripts(l, 1) AS pos FROM c),
k AS (SELECT id, r, row_number() OVER (PARTITION BY id ORDER BY CASE label WHEN 'H' THEN CAST(NOT """ + _first_sql(v.REASON_FIRST_WORDS["H"]) + """ AS INTEGER)
   WHEN 'B' THEN CAST(NOT """ + _first_sql(v.REASON_FIRST_WORDS["B"]) + """ AS INTEGER) ELSE 0 END, pos) AS k FROM e WHERE r IS NOT NULL),
t AS (SELECT id, max(r) FILTER (k = 1) AS r1, max(r) FILTER (k = 2) AS r2, max(r) FILTER (k = 3) AS r3 FROM k GROUP BY id)
"""
FALLBACK_SQL = "CASE label " + " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in v.REASON_FALLBACK.items()) + " END"


def reason_leads(spark, folder):
    df = leads(spark, folder, "lines")
    new = ft.interaction_columns(df)
    label = F.when(F.col("p7") >= 0.6, "H").when(F.col("p14") >= F.col("p21"), "A").otherwise("B")
    return df.withColumns({**new, "提及试驾": F.col(v.LEAD_ID) % 5 == 0, v.PREDICTED: label})


@query("r14_reasons", REASON_SQL + f"""SELECT f.id, coalesce(r1, {FALLBACK_SQL}) AS r1, coalesce(r2, '') AS r2, coalesce(r3, '') AS r3 FROM f LEFT JOIN t USING (id)""")
def reasons(spark, folder):
    df = reason_leads(spark, folder)
    out = df.withColumn("found", ac.reason_candidates(df)).withColumn("r", ac.prioritise(F.col("found"), F.col(v.PREDICTED)))
    return tidy(out.select(lead_id(), *[F.coalesce(F.get("r", F.lit(i)), F.lit("")).alias(f"r{i + 1}") for i in range(3)]))


@query("r15_lead_actions", REASON_SQL + f"""SELECT f.id, label, CASE label WHEN 'H' THEN '高意向' WHEN 'A' THEN '中高意向' ELSE '待培育' END AS level,
  CASE label {' '.join(f"WHEN '{k}' THEN '{t}'" for k, t in v.SOP_TEXT.items())} END AS sop, coalesce(r1, {FALLBACK_SQL}) AS reason, round(p7, 6) AS ph FROM f LEFT JOIN t USING (id)""")
def lead_actions(spark, folder):
    out = ac.lead_actions(reason_leads(spark, folder), probabilities={"H": F.col("p7")})
    return tidy(out.select(
        lead_id(), F.col("预测HAB").alias("label"), F.col("等级说明").alias("level"), F.col("建议SOP").alias("sop"), F.col("原因1").alias("reason"),
        F.col("概率_H").alias("ph")))
