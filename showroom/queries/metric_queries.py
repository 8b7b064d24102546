"""Evaluation: ranking, classes, thresholds, business results, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import labels as lb
from showroom.functions import ratings as rt
from showroom.operators import business as bz, classes as cl, ranking as rk
from showroom.plans.lead_view import LEADS_SQL, base, leads
from showroom.queries.registry import query, tidy

KS = (100, 500, 1000)
PROBS = {"H": "p_H", "A": "p_A", "B": "p_B"}


def scored(spark, folder):
    """id, binary outcome y (order within a year), score s, rival score, all narrow."""
    df = base(spark, folder)
    return df.select(
        F.col(v.LEAD_ID).alias("id"), F.coalesce(F.col(v.RATING_RESULT) == "H", F.lit(False)).cast("int").alias("y"),
        F.col("p7").alias("s"), F.col("p14").alias("rival"))


S_SQL = LEADS_SQL + ", s AS (SELECT id, CAST(coalesce(rating = 'H', false) AS BIGINT) AS y, p7 AS s, p14 AS rival FROM leads)\n"
RANK_SQL = S_SQL + ", r AS (SELECT *, row_number() OVER (ORDER BY s DESC, id) AS k, row_number() OVER (ORDER BY rival DESC, id) AS k2 FROM s), t AS (SELECT count(*) AS n, sum(y) AS p FROM s)\n"
KS_SQL = "(VALUES (100), (500), (1000)) q(top)"


@query("e1_top_k", RANK_SQL + f"""
SELECT CAST(top AS BIGINT) AS k, CAST(sum(y) FILTER (r.k <= top) AS BIGINT) AS hit_count, round(sum(y) FILTER (r.k <= top) / top, 6) AS hit_rate,
  round(sum(y) FILTER (r.k <= top) / top, 6) AS precision, round(sum(y) FILTER (r.k <= top) / max(p), 6) AS recall,
  round(max(p) / max(n), 6) AS expected_rate, round((sum(y) FILTER (r.k <= top) / top) / (max(p) / max(n)), 6) AS lift
FROM r, t, {KS_SQL} WHERE top <= n GROUP BY top""")
def top_k(spark, folder):
    return tidy(rk.top_k_metrics(scored(spark, folder), "y", "s", "id", KS))


@query("e2_top_list", RANK_SQL + """
SELECT k AS rank, id, round(s, 6) AS predicted_proba, y AS actual_label FROM r WHERE k <= 1000""")
def top_list(spark, folder):
    return tidy(rk.top_list(scored(spark, folder), "s", "id", "y", 1000))


@query("e3_hit_count", RANK_SQL + "SELECT CAST(sum(y) AS BIGINT) AS hits FROM r WHERE k <= 500")
def hit_count(spark, folder):
    score = rk.resolve_score({"0": "rival", "1": "s"}, None)
    return rk.hit_count(rk.top_list(scored(spark, folder), score, "id", "y", 500))


@query("e4_decile_lift", RANK_SQL + """
, d AS (SELECT least((k - 1) // (n // 10), 9) + 1 AS decile, y, n, p FROM r, t),
g AS (SELECT decile, count(*) AS count, sum(y) AS hits, max(n) AS n, max(p) AS p FROM d GROUP BY decile)
SELECT CAST(decile AS BIGINT) AS decile, count, CAST(hits AS BIGINT) AS hit_count, round(hits / count, 6) AS hit_rate,
  round(sum(hits) OVER (ORDER BY decile) / sum(count) OVER (ORDER BY decile), 6) AS cumulative_hit_rate, round((hits / count) / (p / n), 6) AS lift FROM g""")
def decile_lift(spark, folder):
    return tidy(rk.decile_lift(scored(spark, folder), "y", "s", "id"))


@query("e5_baseline_comparison", RANK_SQL + f"""
SELECT CAST(top AS BIGINT) AS k, CAST(sum(y) FILTER (r.k <= top) AS BIGINT) AS model_hits, CAST(sum(y) FILTER (k2 <= top) AS BIGINT) AS baseline_hits,
  count(*) FILTER (r.k <= top AND k2 <= top) AS overlap_count,
  round((sum(y) FILTER (r.k <= top) - sum(y) FILTER (k2 <= top)) / sum(y) FILTER (k2 <= top), 6) AS improvement
FROM r, {KS_SQL} GROUP BY top""")
def baseline_comparison(spark, folder):
    return tidy(rk.compare_rankings(scored(spark, folder), "y", "s", "rival", "id", KS))


BIN_SQL = S_SQL + """, c AS (SELECT *, CASE WHEN s < 0.3 THEN 0.0 ELSE s END AS score FROM s),
e AS (SELECT list_sort(list_distinct(quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM c),
b AS (SELECT *, greatest(len(list_filter(edges, lambda x: x < score)), 1) AS bin FROM c, e),
g AS (SELECT bin, count(*) AS count, avg(y) AS actual_rate, avg(s) AS predicted_rate, sum(y) AS positive_count FROM b GROUP BY bin)
"""


def binned(spark, folder):
    df = scored(spark, folder).withColumn("score", F.when(F.col("s") < 0.3, 0.0).otherwise(F.col("s")))
    return rk.quantile_bins(df, "y", "s", "score")


@query("e6_quantile_bins", BIN_SQL + """
SELECT CAST(bin AS BIGINT) AS bin, count, round(actual_rate, 6) AS actual_rate, round(predicted_rate, 6) AS predicted_rate, CAST(positive_count AS BIGINT) AS positive_count FROM g""")
def quantile_bins(spark, folder):
    return tidy(binned(spark, folder))


@query("e6_bin_summary", BIN_SQL + """
SELECT CAST(sum(count) AS BIGINT) AS total_samples, CAST(sum(positive_count) AS BIGINT) AS total_positives, round(sum(positive_count) / sum(count), 6) AS overall_rate,
  round(arg_max(actual_rate, bin), 6) AS high_bin_rate, round(arg_min(actual_rate, bin), 6) AS low_bin_rate FROM g""")
def bin_summary(spark, folder):
    return tidy(rk.bin_summary(binned(spark, folder)))


@query("e7_metric_bundle", S_SQL + "SELECT count(*) AS total_samples, CAST(sum(y) AS BIGINT) AS total_positives, round(avg(y), 6) AS positive_rate FROM s")
def metric_bundle(spark, folder):
    return tidy(rk.metric_bundle(scored(spark, folder), "y", "s", "id", KS)["summary"])


# --- classes ----------------------------------------------------------------------------


def classed(spark, folder):
    """Known ratings with a threshold prediction, class probabilities and outcomes."""
    df = leads(spark, folder, "lines", "classes").transform(lb.window_labels)
    said = rt.apply_policy({c: F.col(p) for c, p in PROBS.items()}, {"strategy": "hab_threshold", "h_threshold": 0.45, "b_threshold": 0.25})
    return df.where(F.col(v.RATING_RESULT).isin("H", "A", "B")).withColumn(v.PREDICTED, said)


C_SQL = LEADS_SQL + """, c AS (SELECT *, CASE WHEN ph >= 0.45 THEN 'H' WHEN pb >= 0.25 THEN 'B' ELSE 'A' END AS said,
  CAST(coalesce(epoch(arrived) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS INTEGER) AS arrive14,
  CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS INTEGER) AS drive14
  FROM scored WHERE rating IN ('H', 'A', 'B'))
"""
PER_CLASS = """, pc AS (SELECT label, count(*) FILTER (rating = label) AS sup, count(*) FILTER (said = label) AS pred, count(*) FILTER (rating = label AND said = label) AS tp
  FROM c, (VALUES ('H'), ('A'), ('B')) q(label) GROUP BY label),
f AS (SELECT *, coalesce(tp / nullif(pred, 0), 0) AS pr, coalesce(tp / nullif(sup, 0), 0) AS re, coalesce(2 * tp / nullif(sup + pred, 0), 0) AS f1 FROM pc)
"""
METRICS_SQL = """SELECT sum(tp) / sum(sup) AS accuracy, avg(re) AS balanced_accuracy, avg(f1) AS macro_f1, sum(f1 * sup) / sum(sup) AS weighted_f1,
  (CAST(sum(tp) AS DOUBLE) * sum(sup) - sum(CAST(sup AS DOUBLE) * pred)) / (sqrt(CAST(sum(sup) AS DOUBLE) ** 2 - sum(CAST(pred AS DOUBLE) ** 2)) * sqrt(CAST(sum(sup) AS DOUBLE) ** 2 - sum(CAST(sup AS DOUBLE) ** 2))) AS mcc,
  CAST(sum(sup) AS BIGINT) AS n FROM f"""


@query("e8_confusion_matrix", C_SQL + """
SELECT rating AS actual, CAST(CASE rating WHEN 'H' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS BIGINT) AS position, count(*) FILTER (said = 'H') AS "pred_H",
  count(*) FILTER (said = 'A') AS "pred_A", count(*) FILTER (said = 'B') AS "pred_B" FROM c GROUP BY rating""")
def confusion_matrix(spark, folder):
    return tidy(cl.confusion_matrix(classed(spark, folder), v.RATING_RESULT, v.PREDICTED))


@query("e9_classification_report", C_SQL + PER_CLASS + """
SELECT label AS class, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, sup AS support FROM f UNION ALL
SELECT 'accuracy', round(sum(tp) / sum(sup), 6), round(sum(tp) / sum(sup), 6), round(sum(tp) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM f UNION ALL
SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(sup) AS BIGINT) FROM f UNION ALL
SELECT 'weighted avg', round(sum(pr * sup) / sum(sup), 6), round(sum(re * sup) / sum(sup), 6), round(sum(f1 * sup) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM f""")
def classification_report(spark, folder):
    return tidy(cl.classification_report(classed(spark, folder), v.RATING_RESULT, v.PREDICTED))


@query("e10_class_metrics", C_SQL + PER_CLASS + f"""
SELECT n, round(accuracy, 6) AS accuracy, round(balanced_accuracy, 6) AS balanced_accuracy, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1, round(mcc, 6) AS mcc FROM ({METRICS_SQL})""")
def class_metrics(spark, folder):
    return tidy(cl.class_metrics(classed(spark, folder), v.RATING_RESULT, v.PREDICTED))


AUC_SQL = """, a AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY s),
w AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM a)
"""


@query("e11_binary_metrics", S_SQL + AUC_SQL + """, b AS (SELECT count(*) AS n, count(*) FILTER (y = 1 AND s >= 0.5) AS tp, count(*) FILTER (s >= 0.5) AS pred,
  count(*) FILTER (y = 1) AS act, count(*) FILTER ((y = 1) = (s >= 0.5)) AS ok FROM s)
SELECT round(ok / n, 6) AS accuracy, round(tp / pred, 6) AS precision, round(tp / act, 6) AS recall, round(2 * tp / (pred + act), 6) AS f1,
  (SELECT round(sum(CAST(pos AS DOUBLE) * (below + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) FROM w) AS auc FROM b""")
def binary_metrics(spark, folder):
    return tidy(cl.binary_metrics(scored(spark, folder), "y", "s"))


@query("e12_class_ranking", LEADS_SQL + """, x AS (SELECT id, rating, ph, pa, pb FROM scored),
u AS (SELECT id, rating, 'H' AS class, ph AS s FROM x UNION ALL SELECT id, rating, 'A', pa FROM x UNION ALL SELECT id, rating, 'B', pb FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY s DESC, id) AS k, count(*) OVER (PARTITION BY class) AS n, CAST(coalesce(rating = class, false) AS INTEGER) AS hit FROM u),
q AS (SELECT *, greatest(1, CAST(floor(n * top_ratio) AS BIGINT)) AS top_n FROM r, (VALUES (0.05::DOUBLE), (0.10::DOUBLE), (0.20::DOUBLE)) q(top_ratio))
SELECT class, round(top_ratio, 6) AS top_ratio, top_n, round(sum(hit) / count(*), 6) AS baseline_rate, round(sum(hit) FILTER (k <= top_n) / top_n, 6) AS hit_rate,
  round((sum(hit) FILTER (k <= top_n) / top_n) / (sum(hit) / count(*)), 6) AS lift FROM q GROUP BY class, top_ratio, top_n""")
def class_ranking(spark, folder):
    return tidy(rk.class_ranking(leads(spark, folder, "classes"), v.RATING_RESULT, PROBS, v.LEAD_ID))


@query("e13_threshold_report", LEADS_SQL + """
SELECT round(t, 6) AS threshold, count(*) FILTER (pb >= t) AS predicted_positive, count(*) FILTER (rating = 'B') AS actual_positive,
  count(*) FILTER (pb >= t AND rating = 'B') AS true_positive, round(coalesce(count(*) FILTER (pb >= t AND rating = 'B') / nullif(count(*) FILTER (pb >= t), 0), 0), 6) AS precision,
  round(count(*) FILTER (pb >= t AND rating = 'B') / count(*) FILTER (rating = 'B'), 6) AS recall,
  round(2 * count(*) FILTER (pb >= t AND rating = 'B') / (count(*) FILTER (pb >= t) + count(*) FILTER (rating = 'B')), 6) AS f1
FROM scored, (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE)) q(t) GROUP BY t""")
def threshold_report(spark, folder):
    return tidy(cl.threshold_report(leads(spark, folder, "classes"), v.RATING_RESULT, "p_B"))


GRID_SQL = LEADS_SQL + """, x AS (SELECT id, rating, ph, pa, pb FROM scored WHERE rating IN ('H', 'A', 'B')),
cells AS (SELECT h, b, row_number() OVER (ORDER BY h, b) - 1 AS cell FROM (VALUES (0.45::DOUBLE), (0.50::DOUBLE), (0.55::DOUBLE), (0.60::DOUBLE), (0.65::DOUBLE)) q(h),
  (VALUES (0.20::DOUBLE), (0.25::DOUBLE), (0.30::DOUBLE), (0.35::DOUBLE), (0.40::DOUBLE)) p(b)),
y AS (SELECT cell, h, b, rating, CASE WHEN ph >= h THEN 'H' WHEN pb >= b THEN 'B' ELSE 'A' END AS said FROM x, cells),
pc AS (SELECT cell, h, b, label, count(*) FILTER (rating = label) AS sup, count(*) FILTER (said = label) AS pred, count(*) FILTER (rating = label AND said = label) AS tp, count(*) AS n
  FROM y, (VALUES ('H'), ('A'), ('B')) q(label) GROUP BY ALL),
m AS (SELECT cell, h, b, avg(coalesce(tp / nullif(sup, 0), 0)) AS ba, avg(coalesce(2 * tp / nullif(sup + pred, 0), 0)) AS mf, max(tp / sup) FILTER (label = 'B') AS br,
  max(pred / n) FILTER (label = 'B') AS bs FROM pc GROUP BY ALL)
"""


@query("j7_policy_grid", GRID_SQL + """
SELECT cell, round(h, 6) AS h_threshold, round(b, 6) AS b_threshold, round(ba, 6) AS balanced_accuracy, round(mf, 6) AS macro_f1, round(bs, 6) AS predicted_b_rate,
  round(br, 6) AS b_recall, CAST(bs >= 0.03 AS BIGINT) AS enough_b FROM m""")
def policy_grid(spark, folder):
    df = leads(spark, folder, "classes").where(F.col(v.RATING_RESULT).isin("H", "A", "B"))
    return tidy(cl.hab_policy_grid(df, v.RATING_RESULT, PROBS))


@query("e14_best_policy", GRID_SQL + """
SELECT cell, round(h, 6) AS h_threshold, round(b, 6) AS b_threshold FROM m ORDER BY bs >= 0.03 DESC, ba DESC, br DESC, mf DESC, cell LIMIT 1""")
def best_policy(spark, folder):
    df = leads(spark, folder, "classes").where(F.col(v.RATING_RESULT).isin("H", "A", "B"))
    best = cl.best_hab_policy(cl.hab_policy_grid(df, v.RATING_RESULT, PROBS))
    return tidy(best.select("cell", "h_threshold", "b_threshold"))


@query("e15_h_threshold", LEADS_SQL + """, x AS (SELECT rating, p7, CASE WHEN p14 >= p21 THEN 'A' ELSE 'B' END AS rest FROM leads WHERE rating IN ('H', 'A', 'B')),
y AS (SELECT t, rating, CASE WHEN p7 >= t THEN 'H' ELSE rest END AS said FROM x, (VALUES (0.35::DOUBLE), (0.40::DOUBLE), (0.45::DOUBLE), (0.50::DOUBLE), (0.55::DOUBLE), (0.60::DOUBLE), (0.65::DOUBLE)) q(t)),
pc AS (SELECT t, label, count(*) FILTER (rating = label) AS sup, count(*) FILTER (said = label) AS pred, count(*) FILTER (rating = label AND said = label) AS tp
  FROM y, (VALUES ('H'), ('A'), ('B')) q(label) GROUP BY ALL)
SELECT round(t, 6) AS h_threshold, round(avg(coalesce(tp / nullif(sup, 0), 0)), 6) AS balanced_accuracy, round(avg(coalesce(2 * tp / nullif(sup + pred, 0), 0)), 6) AS macro_f1 FROM pc GROUP BY t""")
def h_threshold(spark, folder):
    df = base(spark, folder).where(F.col(v.RATING_RESULT).isin("H", "A", "B"))
    return tidy(cl.h_threshold_grid(df, v.RATING_RESULT, "p7", "p14", "p21").drop("cell"))


# --- business ---------------------------------------------------------------------------


@query("e16_bucket_summary", C_SQL + """
SELECT said AS bucket, count(*) AS sample_count, round(avg(arrive14), 6) AS arrive, round(avg(drive14), 6) AS drive, round(count(*) / sum(count(*)) OVER (), 6) AS sample_ratio FROM c GROUP BY said""")
def bucket_summary(spark, folder):
    out = bz.bucket_summary(classed(spark, folder), outcomes=[bz.ARRIVE_14, bz.DRIVE_14])
    return tidy(out.withColumnsRenamed({f"{bz.ARRIVE_14}_rate": "arrive", f"{bz.DRIVE_14}_rate": "drive"}))


RATES_SQL = """, b AS (SELECT avg(arrive14) FILTER (said = 'H') AS ah, avg(arrive14) FILTER (said = 'A') AS aa, avg(arrive14) FILTER (said = 'B') AS ab,
  avg(drive14) FILTER (said = 'H') AS dh, avg(drive14) FILTER (said = 'A') AS da, avg(drive14) FILTER (said = 'B') AS db,
  avg(arrive14) AS oa, avg(drive14) AS od, avg(CAST(said IN ('H', 'A') AS INTEGER)) FILTER (arrive14 = 1) AS ca,
  avg(CAST(said IN ('H', 'A') AS INTEGER)) FILTER (drive14 = 1) AS cd, avg(CAST(said = 'B' AS INTEGER)) AS sb FROM c)
"""


@query("e17_monotonicity", C_SQL + RATES_SQL + """
SELECT dh > da AND da > db AS passed, '试驾标签_14天_rate' AS metric, CASE WHEN dh > da AND da > db THEN 'H/A/B 分层单调' ELSE 'H/A/B 分层未形成单调' END AS message FROM b""")
def monotonicity(spark, folder):
    return bz.monotonicity(bz.bucket_summary(classed(spark, folder)))


@query("e18_business_kpis", C_SQL + RATES_SQL + """
SELECT round(oa, 6) AS overall_arrive_14d_rate, round(od, 6) AS overall_drive_14d_rate, round(ah, 6) AS h_arrive_14d_rate, round(aa, 6) AS a_arrive_14d_rate,
 round(ab, 6) AS b_arrive_14d_rate, round(dh, 6) AS h_drive_14d_rate, round(da, 6) AS a_drive_14d_rate, round(db, 6) AS b_drive_14d_rate,
 round(ah / oa, 6) AS h_arrive_lift, round(dh / od, 6) AS h_drive_lift, round(ca, 6) AS ha_arrive_capture, round(cd, 6) AS ha_drive_capture, round(sb, 6) AS b_bucket_share,
 CASE WHEN ah > aa AND aa > ab AND dh > da AND da > db THEN '已形成清晰分层效果' WHEN (ah > aa AND aa > ab) OR (dh > da AND da > db) THEN '已形成初步分层效果，H/A 边界仍需二期优化'
  ELSE 'POC 已验证建模与 SOP 联动可行，分层边界仍需结合更多行为特征继续校准' END AS client_layering_message, ah > aa AND aa > ab AS arrive_monotonic, dh > da AND da > db AS drive_monotonic FROM b""")
def business_kpis(spark, folder):
    return tidy(bz.business_kpis(classed(spark, folder)))


@query("e19_derivation_check", LEADS_SQL + """, g AS (SELECT CASE WHEN p7 >= 0.5 THEN 'H' WHEN p14 >= 0.5 THEN 'A' WHEN p21 >= 0.5 THEN 'B' ELSE 'N' END AS rating,
 CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 7 * 86400, false) AS INTEGER) AS d7, CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 14 * 86400, false) AS INTEGER) AS d14,
 CAST(coalesce(epoch(driven) - epoch(created) BETWEEN 0 AND 21 * 86400, false) AS INTEGER) AS d21 FROM leads),
r AS (SELECT rating, count(*) AS count, avg(d7) AS r7, avg(d14) AS r14, avg(d21) AS r21 FROM g GROUP BY rating),
k AS (SELECT max(r14) FILTER (rating = 'H') AS h, max(r14) FILTER (rating = 'A') AS a, max(r14) FILTER (rating = 'B') AS b FROM r)
SELECT rating, count, round(r7, 6) AS rate_7d, round(r14, 6) AS rate_14d, round(r21, 6) AS rate_21d, NOT ((h > 0 AND a > 0 AND h < a) OR (a > 0 AND b > 0 AND a < b)) AS is_hierarchical FROM r, k""")
def derivation_check(spark, folder):
    df = leads(spark, folder, "lines").transform(lb.window_labels)
    return tidy(bz.validate_derivation(df, "p7", "p14", "p21", {n: f"试驾标签_{n}天" for n in (7, 14, 21)}))


def _models(spark, folder):
    """The same leads judged by three rules."""
    df = classed(spark, folder)
    p = {c: F.col(x) for c, x in PROBS.items()}
    said = {
        ("two_stage_pipeline", "two_stage"): rt.combine_stages(F.col("p7"), F.col("p14"), F.col("p21"), 0.5)[v.PREDICTED],
        ("argmax", "baseline"): rt.argmax_label(p),
        ("thresholds", "scorecard"): F.col(v.PREDICTED),
    }
    return [bz.comparison_row(df.withColumn("__said", c), n, r, v.RATING_RESULT, "__said") for (n, r), c in said.items()]


def _model_sql(name, role, said):
    return f"""SELECT '{name}' AS model_name, '{role}' AS role, * FROM (WITH c2 AS (SELECT rating, {said} AS said FROM c),
  pc AS (SELECT label, count(*) FILTER (rating = label) AS sup, count(*) FILTER (said = label) AS pred, count(*) FILTER (rating = label AND said = label) AS tp
   FROM c2, (VALUES ('H'), ('A'), ('B')) q(label) GROUP BY label),
  f AS (SELECT *, coalesce(tp / nullif(sup, 0), 0) AS re, coalesce(2 * tp / nullif(sup + pred, 0), 0) AS f1 FROM pc)
  SELECT m.*, (SELECT max(re) FILTER (label = 'B') FROM f) AS b_recall FROM ({METRICS_SQL}) m)"""


MODELS_SQL = C_SQL + ", models AS (" + " UNION ALL ".join([
    _model_sql("two_stage_pipeline", "two_stage", "CASE WHEN p7 >= 0.5 THEN 'H' WHEN p14 >= p21 THEN 'A' ELSE 'B' END"),
    _model_sql("argmax", "baseline", "CASE WHEN ph >= pa AND ph >= pb THEN 'H' WHEN pa >= pb THEN 'A' ELSE 'B' END"),
    _model_sql("thresholds", "scorecard", "said")]) + ")\n"


@query("e21_model_comparison", MODELS_SQL + """
SELECT m.model_name, m.role, round(m.accuracy, 6) AS accuracy, round(m.macro_f1, 6) AS macro_f1, round(m.mcc, 6) AS mcc, round(m.b_recall, 6) AS b_recall,
  round(m.accuracy - b.accuracy, 6) AS delta_vs_baseline_accuracy, round(m.macro_f1 - b.macro_f1, 6) AS delta_vs_baseline_macro_f1
FROM models m, models b WHERE b.role = 'baseline'""")
def model_comparison(spark, folder):
    out = bz.compare_models(_models(spark, folder))
    return tidy(out.select("model_name", "role", "accuracy", "macro_f1", "mcc", "b_recall", "delta_vs_baseline_accuracy", "delta_vs_baseline_macro_f1"))


@query("e21_recommended_model", MODELS_SQL + """
SELECT model_name, role FROM models WHERE macro_f1 >= (SELECT max(macro_f1) FROM models) - 0.01 ORDER BY balanced_accuracy DESC, b_recall DESC LIMIT 1""")
def recommended_model(spark, folder):
    return bz.recommend(bz.compare_models(_models(spark, folder))).select("model_name", "role")


@query("e20_comparator_bundle", C_SQL + """
SELECT id, rating AS actual, said, round(ph, 6) AS ph FROM c""")
def comparator_bundle(spark, folder):
    bundle = bz.comparator_bundle(classed(spark, folder), "thresholds", "baseline", v.RATING_RESULT, PROBS)
    return tidy(bundle["results"].select(
        F.col(v.LEAD_ID).alias("id"), F.col("真实标签").alias("actual"), F.col("预测标签").alias("said"), F.col("概率_H").alias("ph")))


@query("e25_ensemble_evaluation", RANK_SQL + AUC_SQL + """
SELECT CAST(top AS BIGINT) AS k, CAST(sum(y) FILTER (r.k <= top) AS BIGINT) AS hit_count, round(avg(CAST((s >= 0.5) = (y = 1) AS INTEGER)), 6) AS accuracy,
  (SELECT round(sum(CAST(pos AS DOUBLE) * (below + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) FROM w) AS auc
FROM r, (VALUES (100), (500)) q(top) GROUP BY top""")
def ensemble_evaluation(spark, folder):
    out = bz.ensemble_evaluation(scored(spark, folder), "y", "s", "id", (100, 500))
    return tidy(out.select("k", "hit_count", "accuracy", "auc"))


SAID_SQL = {
    "two_stage": "CASE WHEN p7 >= 0.5 THEN 'H' WHEN p14 >= p21 THEN 'A' ELSE 'B' END",
    "highest": "CASE WHEN ph >= pa AND ph >= pb THEN 'H' WHEN pa >= pb THEN 'A' ELSE 'B' END",
    "thresholds": "CASE WHEN ph >= 0.45 THEN 'H' WHEN pb >= 0.25 THEN 'B' ELSE 'A' END"}


@query("j8_side_by_side", LEADS_SQL + ", j AS (SELECT id, ph, pa, pb, " + ", ".join(f"{c} AS {n}" for n, c in SAID_SQL.items()) + """ FROM scored)
SELECT id, two_stage, highest, thresholds, two_stage = highest AND highest = thresholds AS agree FROM j""")
def side_by_side(spark, folder):
    p = {c: F.col(x) for c, x in PROBS.items()}
    out = bz.side_by_side(leads(spark, folder, "classes"), {
        "two_stage": rt.combine_stages(F.col("p7"), F.col("p14"), F.col("p21"), 0.5)[v.PREDICTED], "highest": rt.argmax_label(p),
        "thresholds": rt.apply_policy(p, {"strategy": "hab_threshold", "h_threshold": 0.45, "b_threshold": 0.25})})
    return out.withColumnRenamed(v.LEAD_ID, "id")
