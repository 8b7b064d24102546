"""Naive Bayes from fit to comparison: the family whose training and prediction SQL can state row by row.

Leads are split by creation: before 1996 for training, until June 1997 for thresholds, and the rest as the rows to predict.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.labels import target_labels
from showroom.operators import splits as sp
from showroom.plans import closed_form, scoring, training as tr, validation
from showroom.plans.lead_view import LEADS_SQL, leads
from showroom.queries.registry import lead_id, query, tidy
from showroom.session import ensure_shared_folder, hand_over

TRAIN_END, VALID_END = "1996-01-01", "1997-06-01"
FAMILY = closed_form.FAMILY
#: Columns of the leads and the same in SQL: numbers first, as in a model.
NUMBERS = {"通话次数": "calls", "通话总时长": "call_seconds"}
TEXTS = {
    v.CITY: "city", v.CAR: "car", "一级渠道名称": "channel1", "客户是否主动询问交车时间": "ask_time", "客户是否主动询问购车权益": "ask_benefit",
    "客户是否主动询问金融政策": "ask_finance", "客户是否同意加微信": "add_wechat", "客户是否表示门店距离太远拒绝到店": "too_far"}
FEATURES = NUMBERS | TEXTS
ANSWERS = [c for c in TEXTS if c.startswith("客户")]
DRIVE_14 = f"{scoring.DRIVE}_14天"
#: What the models of each window learn for the scores. The smallest tables hardly have a test drive within 7 days, so arrivals stand in.
WINDOW_LABELS = {
    "drive": {7: "到店标签_7天", 14: "到店标签_14天", 21: "到店标签_30天"},
    "order": {n: f"{scoring.ORDER}_{n}天" for n in scoring.WINDOWS}}


def split_leads(spark, folder):
    """Leads with labels and their part; only ids, labels, what a status needs, and the features."""
    rows = leads(spark, folder, "lines", "place", "car").transform(target_labels)
    rows = sp.time_split_three(rows, TRAIN_END, VALID_END)
    labels = [DRIVE_14, *(label for by_days in WINDOW_LABELS.values() for label in by_days.values())]
    return rows.select(v.LEAD_ID, v.RATING_RESULT, v.DRIVEN, v.ORDERED, "意向金支付状态", *dict.fromkeys(labels), sp.SPLIT, *FEATURES)


def rated(spark, folder, features: Sequence[str] = tuple(FEATURES)) -> tr.Prepared:
    rows = split_leads(spark, folder).where(F.col(v.RATING_RESULT).isin("H", "A", "B"))
    parts = sp.parts(hand_over(rows.select(v.LEAD_ID, v.RATING_RESULT, sp.SPLIT, *features), "rated"))
    return tr.Prepared(parts["train"], parts["valid"], parts["test"], v.RATING_RESULT, None, {})


# --- the same in SQL --------------------------------------------------------------------

SPLIT_SQL = LEADS_SQL + f""", x AS MATERIALIZED (
  SELECT *, CASE WHEN created < TIMESTAMP '{TRAIN_END}' THEN 'train' WHEN created < TIMESTAMP '{VALID_END}' THEN 'valid' ELSE 'test' END AS part FROM leads),
r AS MATERIALIZED (SELECT * FROM x WHERE rating IN ('H', 'A', 'B'))"""
TENTHS = "[" + ", ".join(f"{i}/10::DOUBLE" for i in range(1, 10)) + "]"


def bayes_sql(name: str, source: str, label: str, classes: Sequence[str], features: Sequence[str] = tuple(FEATURES)) -> str:
    """Common table expressions ending in ``{name}(id, part, c, p)``: the probability of class ``c`` for every row of ``source``."""
    known = f"part = 'train' AND {label} IN ({', '.join(repr(c) for c in classes)})"
    numbers = [FEATURES[c] for c in features if c in NUMBERS]
    values = [f"CASE WHEN {c} IS NULL THEN '' ELSE CAST(len(list_filter(b_{c}, lambda t: t < {c})) AS VARCHAR) END" for c in numbers]
    values += [f"coalesce({TEXTS[c]}, '')" for c in features if c in TEXTS]
    borders = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {TENTHS}) AS b_{c}" for c in numbers) or "count(*) AS nothing"
    return f""", {name}_b AS (SELECT {borders} FROM {source} WHERE {known}),
{name}_f AS MATERIALIZED (SELECT id, part, {label} AS y, ({known}) AS known, unnest(range({len(values)})) AS i, unnest([{', '.join(values)}]) AS val FROM {source}, {name}_b),
{name}_n AS (SELECT {label} AS c, count(*) AS nc FROM {source} WHERE {known} GROUP BY 1),
{name}_k AS (SELECT i, val, y AS c, count(*) AS n FROM {name}_f WHERE known GROUP BY ALL),
{name}_v AS (SELECT i, count(DISTINCT val) AS vs FROM {name}_f WHERE known GROUP BY i),
{name}_t AS (SELECT f.id, f.part, m.c, round(ln(1 / {len(classes)}) + sum(ln((coalesce(k.n, 0) + 1) / (nc + vs + 1))), 9) AS t FROM {name}_f f CROSS JOIN {name}_n m JOIN {name}_v w ON w.i = f.i
  LEFT JOIN {name}_k k ON k.i = f.i AND k.val = f.val AND k.c = m.c GROUP BY ALL),
{name} AS MATERIALIZED (SELECT id, part, c, exp(t - max(t) OVER (PARTITION BY id)) / sum(exp(t - top)) OVER (PARTITION BY id) AS p
  FROM (SELECT *, max(t) OVER (PARTITION BY id) AS top FROM {name}_t))"""


def wide_sql(name: str, source: str, columns: dict[str, str]) -> str:
    """``source``'s probabilities in columns, by class."""
    return f", {name} AS (SELECT id, part, " + ", ".join(f"max(p) FILTER (c = '{c}') AS {n}" for c, n in columns.items()) + f" FROM {source} GROUP BY id, part)"


def metrics_sql(name: str, source: str, keys: str) -> str:
    """Of rows (keys, rating, said): ``{name}(keys, acc, ba, mf, br, bs, mcc)``."""
    return f""", {name}_c AS (SELECT {keys}, label, count(*) FILTER (rating = label) AS sup, count(*) FILTER (said = label) AS pred,
  count(*) FILTER (rating = label AND said = label) AS tp, count(*) AS n FROM {source}, (VALUES ('H'), ('A'), ('B')) q(label) GROUP BY ALL),
{name} AS (SELECT {keys}, sum(tp) / sum(sup) AS acc, avg(coalesce(tp / nullif(sup, 0), 0)) AS ba, avg(coalesce(2 * tp / nullif(sup + pred, 0), 0)) AS mf,
  max(tp / sup) FILTER (label = 'B') AS br, max(pred / n) FILTER (label = 'B') AS bs,
  (CAST(sum(tp) AS DOUBLE) * sum(sup) - sum(CAST(sup AS DOUBLE) * pred)) / (sqrt(CAST(sum(sup) AS DOUBLE) ** 2 - sum(CAST(pred AS DOUBLE) ** 2)) * sqrt(CAST(sum(sup) AS DOUBLE) ** 2 - sum(CAST(sup AS DOUBLE) ** 2))) AS mcc
  FROM {name}_c GROUP BY ALL)"""


def window_label(begin: str, end: str, days: int) -> str:
    return f"CASE WHEN epoch({end}) - epoch({begin}) BETWEEN 0 AND {days} * 86400 THEN '1' ELSE '0' END"


HAB_SQL = SPLIT_SQL + bayes_sql("m", "r", "rating", ("H", "A", "B")) + wide_sql("w", "m", {"H": "ph", "A": "pa", "B": "pb"})
STAGES_SQL = (
    SPLIT_SQL + bayes_sql("one", "r", f"CASE WHEN rating = 'H' THEN 'H' ELSE '{v.NOT_H}' END", ("H", v.NOT_H))
    + bayes_sql("two", "r", "rating", ("A", "B")) + wide_sql("first", "one", {"H": "h"}) + wide_sql("second", "two", {"A": "a", "B": "b"})
    + """, s AS (SELECT r.id, r.part, rating, h, a, b FROM r JOIN first USING (id) JOIN second USING (id)),
g AS (SELECT t, rating, CASE WHEN h >= t THEN 'H' WHEN a >= b THEN 'A' ELSE 'B' END AS said FROM s, (VALUES """
    + ", ".join(f"({t}::DOUBLE)" for t in v.STAGE_H_THRESHOLDS) + ") q(t) WHERE part = 'valid')" + metrics_sql("gm", "g", "t")
    + """, best AS (SELECT t FROM gm ORDER BY ba DESC, mf DESC, t LIMIT 1),
staged AS (SELECT id, rating, t, h, (1 - h) * a AS pa, (1 - h) * b AS pb, CASE WHEN h >= t THEN 'H' WHEN a >= b THEN 'A' ELSE 'B' END AS said FROM s, best WHERE part = 'test')""")
POLICY_SQL = (
    """, cells AS (SELECT h, b, row_number() OVER (ORDER BY h, b) AS cell FROM (VALUES """ + ", ".join(f"({t}::DOUBLE)" for t in v.H_THRESHOLDS) + ") q(h), (VALUES "
    + ", ".join(f"({t}::DOUBLE)" for t in v.B_THRESHOLDS) + """) p(b)),
y AS (SELECT cell, h, b, rating, CASE WHEN ph >= h THEN 'H' WHEN pb >= b THEN 'B' ELSE 'A' END AS said FROM w JOIN r USING (id), cells WHERE w.part = 'valid')"""
    + metrics_sql("ym", "y", "cell, h, b")
    + """, rule AS (SELECT h, b FROM ym ORDER BY bs >= 0.03 DESC, ba DESC, br DESC, mf DESC, cell LIMIT 1),
ruled AS (SELECT w.id, rating, h, b, CASE WHEN ph >= h THEN 'H' WHEN pb >= b THEN 'B' ELSE 'A' END AS said FROM w JOIN r USING (id), rule WHERE w.part = 'test')""")


# --- queries ----------------------------------------------------------------------------


@query("m1_m4_closed_form", SPLIT_SQL + bayes_sql("m", "x", window_label("created", "driven", 14), ("0", "1")) + """
SELECT id, round(max(p) FILTER (c = '0'), 6) AS p_0, round(max(p) FILTER (c = '1'), 6) AS p_1 FROM m WHERE part = 'test' GROUP BY id""")
def closed_form_probabilities(spark, folder):
    parts = sp.parts(split_leads(spark, folder).select(v.LEAD_ID, DRIVE_14, sp.SPLIT, *FEATURES))
    model = tr.train(parts["train"], DRIVE_14, FAMILY)
    return tidy(model.probabilities(parts["test"]).select(lead_id(), "p_0", "p_1"))


@query("m10_closed_form_stages", STAGES_SQL + """
SELECT id, said AS predicted, round(t, 6) AS h_threshold, round(h, 6) AS "p_H", round(pa, 6) AS "p_A", round(pb, 6) AS "p_B" FROM staged""")
def closed_form_stages(spark, folder):
    prep = rated(spark, folder)
    model = tr.train_two_stage(prep, FAMILY)
    out = model.predict(prep.test).withColumn("h_threshold", F.lit(float(model.threshold["h_threshold"])))
    return tidy(out.select(lead_id(), F.col(v.PREDICTED).alias("predicted"), "h_threshold", "p_H", "p_A", "p_B"))


@query("m11_closed_form_policy", HAB_SQL + POLICY_SQL + """
SELECT id, said AS predicted, round(h, 6) AS h_threshold, round(b, 6) AS b_threshold FROM ruled""")
def closed_form_policy(spark, folder):
    prep = rated(spark, folder)
    model, rule = tr.train_multiclass(prep, FAMILY)
    out = model.predict(prep.test, rule=rule)
    return tidy(out.select(
        lead_id(), F.col(v.PREDICTED).alias("predicted"), F.lit(float(rule["h_threshold"])).alias("h_threshold"), F.lit(float(rule["b_threshold"])).alias("b_threshold")))


#: Three models of one family; the names share its prefix.
BOARD = {f"{FAMILY}_all": list(FEATURES), f"{FAMILY}_answers": ANSWERS, f"{FAMILY}_calls": [*NUMBERS, v.CITY]}
BOARD_SQL = SPLIT_SQL + "".join(bayes_sql(f"m{i}", "r", "rating", ("H", "A", "B"), f) for i, f in enumerate(BOARD.values())) + ", u AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, id, c, p FROM m{i} WHERE part = 'test'" for i, name in enumerate(BOARD)) + """),
said AS (SELECT model, id, arg_max(c, p + CASE c WHEN 'H' THEN 2e-15 WHEN 'A' THEN 1e-15 ELSE 0 END) AS said FROM u GROUP BY model, id),
j AS (SELECT model, rating, said FROM said JOIN r USING (id))""" + metrics_sql("b", "j", "model")


@query("m3_m5_closed_form_board", BOARD_SQL + """
SELECT model, round(mf, 6) AS score_test, round(acc, 6) AS accuracy, round(ba, 6) AS balanced_accuracy, round(mf, 6) AS macro_f1, round(mcc, 6) AS mcc,
  row_number() OVER (ORDER BY mf DESC, model) = 1 AS is_baseline FROM b""")
def closed_form_board(spark, folder):
    """The baseline is the best of three models of the family."""
    prep = rated(spark, folder)
    models = {name: tr.train(prep.train.select(v.LEAD_ID, prep.target, *columns), prep.target, FAMILY) for name, columns in BOARD.items()}
    board = tr.leaderboard(models, prep.test)
    picked = tr.pick_baseline(board, "bayes")
    return tidy(board.withColumn("is_baseline", F.col("model") == picked["baseline_model_name"]))


@query("m7_closed_form_importance", SPLIT_SQL + bayes_sql("m", "r", "rating", ("H", "A", "B")) + f""", a AS (SELECT k.i, n, sum(n) OVER (PARTITION BY k.i, val) AS nv, nc, sum(n) OVER (PARTITION BY k.i) AS total FROM m_k k JOIN m_n USING (c)),
t AS (SELECT i, greatest(0, sum(n / total * ln(CAST(n AS DOUBLE) * total / (CAST(nv AS DOUBLE) * nc)))) AS told FROM a GROUP BY i)
SELECT [{', '.join(repr(c) for c in FEATURES)}][i + 1] AS feature, round(told / sum(told) OVER (), 6) AS importance FROM t""")
def closed_form_importance(spark, folder):
    prep = rated(spark, folder)
    return tidy(tr.importance_table(spark, tr.train(prep.train, prep.target, FAMILY).importances()))


@query("s16_closed_form_reloaded", HAB_SQL + """
SELECT id, round(ph, 6) AS "p_H", round(pa, 6) AS "p_A", round(pb, 6) AS "p_B" FROM w WHERE part = 'test'""")
def closed_form_reloaded(spark, folder):
    """Probabilities of a model that was saved and loaded."""
    prep = rated(spark, folder)
    path = f"{ensure_shared_folder(spark)}/models/closed-form-{uuid4().hex}"
    tr.train(prep.train, prep.target, FAMILY).save(spark, path)
    return tidy(tr.LeadModel.load(spark, path).probabilities(prep.test).select(lead_id(), "p_H", "p_A", "p_B"))


def _points(p7: str, p14: str, p21: str) -> str:
    return (f"round_even(((CASE WHEN {p7} > 0 THEN {p7} ELSE 0 END) * 100 + (CASE WHEN {p14} > 0 THEN {p14} ELSE 0.5 END) * 60"
            f" + (CASE WHEN {p21} > 0 THEN {p21} ELSE 0 END) * 30) / 190.0 * 100, 2)")


def _by_windows(a: str, b: str, c: str) -> str:
    return f"CASE WHEN {a} >= 0.5 THEN 'H' WHEN {b} >= 0.5 THEN 'A' WHEN {c} >= 0.5 THEN 'B' ELSE 'C' END"


KINDS = {"d": ("created", "arrived", (7, 14, 30)), "o": ("driven", "ordered", (7, 14, 21))}
SCORES_SQL = SPLIT_SQL + "".join(
    bayes_sql(f"{k}{n}", "x", window_label(begin, end, d), ("0", "1")) for k, (begin, end, days) in KINDS.items() for n, d in zip(scoring.WINDOWS, days, strict=True)) + """
, z AS (SELECT x.id, ordered IS NOT NULL OR coalesce(paid = '已支付', false) AS is_ordered, driven IS NOT NULL AS is_driven, """ + ", ".join(
    f"{k}{n}.p AS {k}p{n}" for k in KINDS for n in scoring.WINDOWS) + " FROM x " + " ".join(
    f"JOIN {k}{n} ON {k}{n}.id = x.id AND {k}{n}.c = '1'" for k in KINDS for n in scoring.WINDOWS) + " WHERE x.part = 'test')" + f"""
SELECT id, 'simple' AS mode, CASE WHEN is_ordered THEN 'O' WHEN dp14 >= 0.5 THEN 'H' WHEN dp14 >= 0.35 THEN 'A' WHEN dp14 >= 0.15 THEN 'B' ELSE 'C' END AS rating,
  CASE WHEN is_ordered THEN 'O' ELSE '试驾前' END AS stage, round(CASE WHEN is_ordered THEN 100 ELSE {_points('0', 'dp14', '0')} END, 6) AS score FROM z
UNION ALL SELECT id, 'medium', CASE WHEN is_ordered THEN 'O' ELSE {_by_windows('dp7', 'dp14', 'dp21')} END,
  CASE WHEN is_ordered THEN 'O' ELSE '试驾前' END, round(CASE WHEN is_ordered THEN 100 ELSE {_points('dp7', 'dp14', 'dp21')} END, 6) FROM z
UNION ALL SELECT id, 'advanced', CASE WHEN is_ordered THEN 'O' WHEN is_driven THEN {_by_windows('op7', 'op14', 'op21')} ELSE {_by_windows('dp7', 'dp14', 'dp21')} END,
  CASE WHEN is_ordered THEN 'O' WHEN is_driven THEN '试驾后' ELSE '试驾前' END,
  round(CASE WHEN is_ordered THEN 100 WHEN is_driven THEN {_points('op7', 'op14', 'op21')} ELSE {_points('dp7', 'dp14', 'dp21')} END, 6) FROM z"""


@query("m13_m15_closed_form_scores", SCORES_SQL)
def closed_form_scores(spark, folder):
    """Rating, stage and score of every later lead in the three modes."""
    parts = sp.parts(hand_over(split_leads(spark, folder), "scores"))
    given = {
        kind: {n: tr.train(parts["train"].select(v.LEAD_ID, label, *FEATURES), label, FAMILY) for n, label in labels.items()}
        for kind, labels in WINDOW_LABELS.items()}
    given["model"] = given["drive"][14]
    out = None
    for mode in ("simple", "medium", "advanced"):
        rows = scoring.score(parts["test"], mode, given).select(
            lead_id(), F.lit(mode).alias("mode"), F.col("评级").alias("rating"), F.col("阶段").alias("stage"), F.col("分值").alias("score"))
        out = rows if out is None else out.unionByName(rows)
    return tidy(out)


COMPARISON_SQL = STAGES_SQL + bayes_sql("m", "r", "rating", ("H", "A", "B")) + wide_sql("w", "m", {"H": "ph", "A": "pa", "B": "pb"}) + POLICY_SQL + f""",
c AS (SELECT 'two_stage_pipeline' AS model_name, 'two_stage' AS role, rating, said FROM staged UNION ALL SELECT 'multiclass_{FAMILY}', 'baseline', rating, said FROM ruled)""" + metrics_sql(
    "cm", "c", "model_name, role")


@query("m17_closed_form_comparison", COMPARISON_SQL + """
SELECT model_name, role, round(acc, 6) AS accuracy, round(ba, 6) AS balanced_accuracy, round(mf, 6) AS macro_f1, round(br, 6) AS b_recall,
  round(mf - max(mf) FILTER (role = 'baseline') OVER (), 6) AS delta_vs_baseline_macro_f1 FROM cm""")
def closed_form_comparison(spark, folder):
    """Two stages against the multiclass baseline, with the differences of both roles."""
    prep = rated(spark, folder)
    bundles = validation.compare(prep.test, prep.target, tr.train_two_stage(prep, FAMILY), tr.train_multiclass(prep, FAMILY), scorecard=False)
    table = validation.bz.compare_models([b["comparison_row"] for b in bundles.values()])
    return tidy(table.select("model_name", "role", "accuracy", "balanced_accuracy", "macro_f1", "b_recall", "delta_vs_baseline_macro_f1"))
