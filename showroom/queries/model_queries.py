"""Model training, scoring and whole jobs. Fits have no SQL twin; what SQL can say is checked."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.labels import target_labels
from showroom.operators import ranking as rk, splits as sp
from showroom.plans import data_job, scoring, training as tr, validation
from showroom.plans.lead_view import LEADS_SQL, base, behavior_log, leads
from showroom.queries.join_queries import BEHAVIOR_SQL
from showroom.queries.registry import lead_id, query, tidy
from showroom.session import ensure_shared_folder, hand_over
from showroom.sources.stores import PrepStore, prep_key

def adapted(spark, folder):
    """Leads with labels. The second channel is left out: in this view it spells the rating."""
    return leads(spark, folder, "lines", "place", "car").drop("二级渠道名称").transform(target_labels)


@lru_cache(maxsize=4)
def _stored(spark, folder):
    """The adapted leads, joined and written once; splits, fits and scores read them many times."""
    return hand_over(adapted(spark, folder), "adapted")


@lru_cache(maxsize=4)
def _prepared(spark, folder):
    return tr.prepare(_stored(spark, folder))


@lru_cache(maxsize=4)
def _two_stage(spark, folder):
    return tr.train_two_stage(_prepared(spark, folder))


@lru_cache(maxsize=4)
def _multiclass(spark, folder):
    return tr.train_multiclass(_prepared(spark, folder), "RandomForest")


WINDOW_TARGETS = {n: f"试驾标签_{n}天" for n in (7, 14, 21)}
ORDER_TARGETS = {n: f"下订标签_{n}天" for n in (7, 14, 21)}
ALL_TARGETS = [*WINDOW_TARGETS.values(), "到店标签_14天", *ORDER_TARGETS.values()]


@lru_cache(maxsize=4)
def _window_parts(spark, folder):
    return sp.parts(sp.time_split(_stored(spark, folder), "1999-01-01"))


@lru_cache(maxsize=4)
def _fits(spark, folder):
    return {}


def _window_models(spark, folder, targets):
    """The models of windows; a query fits those it reads, in the same passes, and no others."""
    known, rows = _fits(spark, folder), _window_parts(spark, folder)["train"]
    missing = [t for t in targets if t not in known]
    together = tr.BoostedFits(rows, missing)
    known |= {t: tr.train(rows, t, together=together) for t in missing}
    return {t: known[t] for t in targets}


def _window_model(spark, folder, target):
    return _window_models(spark, folder, [target])[target]


@query("m2_class_weights", LEADS_SQL + """
SELECT rating AS class, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight FROM leads WHERE rating IS NOT NULL GROUP BY rating""")
def class_weights(spark, folder):
    weights = tr.class_weights(base(spark, folder).where(F.col(v.RATING_RESULT).isNotNull()), v.RATING_RESULT)
    return tidy(spark.createDataFrame(list(weights.items()), "class string, weight double"))


PREPARED_SQL = LEADS_SQL + """, known AS (SELECT * FROM leads WHERE rating IS NOT NULL),
c AS (SELECT CAST(min(created) + (max(created) - min(created)) * 0.70 AS DATE) AS a, CAST(min(created) + (max(created) - min(created)) * 0.85 AS DATE) AS b FROM known),
p AS (SELECT *, CASE WHEN created < a THEN 'train' WHEN created < b THEN 'valid' ELSE 'test' END AS part FROM known, c WHERE rating IN ('H', 'A', 'B')),
heat AS (SELECT coalesce(city, '未知') AS hc, coalesce(car, '未知') AS hk, count(*) AS heat FROM p WHERE part = 'train' GROUP BY ALL)
"""


@query("m12_prepared_parts", PREPARED_SQL + """
SELECT part, count(*) AS n, CAST(sum(coalesce(heat, 0)) AS BIGINT) AS heat FROM p LEFT JOIN heat ON hc = coalesce(city, '未知') AND hk = coalesce(car, '未知') GROUP BY part""")
def prepared_parts(spark, folder):
    out = None
    for part, rows in _prepared(spark, folder).tables().items():
        row = rows.agg(F.count("*").alias("n"), F.sum("城市车型热度").alias("heat")).select(F.lit(part).alias("part"), "n", "heat")
        out = row if out is None else out.unionByName(row)
    return tidy(out)


@query("s14_prepared_store", PREPARED_SQL + "SELECT part, count(*) AS n FROM p GROUP BY part")
def prepared_store(spark, folder):
    prep = _prepared(spark, folder)
    key = prep_key(spark, f"{folder}/orders.parquet", prep.target, v.CONTRACT_VERSION, "auto", "phone_or_lead", "hab", "full", 42)
    store = PrepStore(spark, f"{ensure_shared_folder(spark)}/prepared")
    if store.load(key) is None:
        store.save(key, prep.tables(), prep.info)
    found = store.load(key)
    out = None
    for part in ("train", "valid", "test"):
        row = found[part].agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("m1_m4_binary_model")
def binary_model(spark, folder):
    scored = _window_model(spark, folder, WINDOW_TARGETS[14]).probabilities(_window_parts(spark, folder)["test"])
    return tidy(scored.select(lead_id(), F.col("试驾标签_14天").alias("actual"), "p_0", "p_1"))


@query("s16_saved_model")
def saved_model(spark, folder):
    model, _ = _multiclass(spark, folder)
    path = f"{ensure_shared_folder(spark)}/models/multiclass"
    model.save(spark, path, metric="macro_f1")
    back = tr.LeadModel.load(spark, path)
    return tidy(back.probabilities(_prepared(spark, folder).test).select(lead_id(), "p_H", "p_A", "p_B"))


@query("m3_m5_leaderboard")
def model_leaderboard(spark, folder):
    prep = _prepared(spark, folder)
    models = {f: tr.train(prep.train, prep.target, f) for f in tr.choose_families()}
    board = tr.leaderboard(models, prep.test)
    picked = tr.pick_baseline(board, "rf")
    return tidy(board.withColumn("is_baseline", F.col("model") == picked["baseline_model_name"]))


@query("m7_feature_importance")
def feature_importance(spark, folder):
    model, _ = _multiclass(spark, folder)
    table = tr.importance_table(spark, model.importances())
    return tidy(table.withColumn("dimension", tr.dimension_of(F.col("feature"))))


@query("m7_permutation_importance")
def permutation_importance(spark, folder):
    model, _ = _multiclass(spark, folder)
    loss = tr.permutation_importance(model, _prepared(spark, folder).test, v.LEAD_ID)
    return tr.importance_table(spark, loss)


@query("m7_dimension_contribution")
def dimension_contribution(spark, folder):
    model, _ = _multiclass(spark, folder)
    return tidy(tr.dimension_contribution(tr.importance_table(spark, model.importances())))


@query("m8_m9_window_models")
def window_models(spark, folder):
    return tidy(tr.window_metrics(_window_models(spark, folder, ALL_TARGETS), _window_parts(spark, folder)["test"]))


@query("e2_top_lists_of_model")
def top_lists_of_model(spark, folder):
    model, _ = _multiclass(spark, folder)
    path = f"{ensure_shared_folder(spark)}/top/{folder.rstrip('/').rsplit('/', 1)[-1]}"
    test = _prepared(spark, folder).test
    lists = scoring.write_top_lists(test, model, path, "H", ks=(50, 100, test.count() + 1))
    return tidy(lists[100].select("rank", F.col(v.LEAD_ID).alias("id"), "predicted_proba", "actual_label"))


@query("e7_model_report")
def report_of_model(spark, folder):
    model, _ = _multiclass(spark, folder)
    scored = hand_over(model.predict(_prepared(spark, folder).test).select(
        v.LEAD_ID, "p_H", (F.col(model.label) == "H").cast("int").alias("y")), "report")
    report = validation.model_report(
        spark, f"{ensure_shared_folder(spark)}/reports", "multiclass", {"classes": model.classes},
        rk.top_k_metrics(scored, "y", "p_H", v.LEAD_ID, (50, 100)), model.importances(), rk.quantile_bins(scored, "y", "p_H", "p_H"))
    return tidy(spark.createDataFrame(report["stratified_metrics"], "bin int, count bigint, actual_rate double, predicted_rate double, positive_count bigint"))


@query("m10_two_stage_model")
def two_stage_model(spark, folder):
    out = _two_stage(spark, folder).predict(_prepared(spark, folder).test)
    return tidy(out.select(lead_id(), F.col(v.PREDICTED).alias("predicted"), "p_H", "p_A", "p_B"))


@query("m11_multiclass_policy")
def multiclass_policy(spark, folder):
    model, rule = _multiclass(spark, folder)
    return tidy(model.predict(_prepared(spark, folder).test, rule=rule).select(lead_id(), F.col(v.PREDICTED).alias("predicted")))


def _scored(spark, folder, mode):
    """Each mode fits the models that it scores with."""
    if mode == "simple":
        models = {"model": _window_model(spark, folder, WINDOW_TARGETS[14])}
    else:
        used = {"drive": WINDOW_TARGETS} | ({"order": ORDER_TARGETS} if mode == "advanced" else {})
        fitted = _window_models(spark, folder, [t for targets in used.values() for t in targets.values()])
        models = {kind: {n: fitted[t] for n, t in targets.items()} for kind, targets in used.items()}
    return scoring.score(_stored(spark, folder), mode, models)


def _short(df):
    return tidy(df.select(lead_id(), F.col("评级").alias("rating"), F.col("阶段").alias("stage"), F.col("分值").alias("score")))


@query("m13_score_simple")
def score_simple(spark, folder):
    return _short(_scored(spark, folder, "simple"))


@query("m14_score_medium")
def score_medium(spark, folder):
    return _short(_scored(spark, folder, "medium"))


@query("m15_score_advanced")
def score_advanced(spark, folder):
    return _short(_scored(spark, folder, "advanced"))


@query("m16_scored_stages", LEADS_SQL + """
SELECT CASE WHEN ordered IS NOT NULL OR coalesce(paid = '已支付', false) THEN 'O' WHEN driven IS NOT NULL THEN '试驾后' ELSE '试驾前' END AS stage, count(*) AS n FROM leads GROUP BY stage""")
def scored_stages(spark, folder):
    return _scored(spark, folder, "advanced").groupBy(F.col("阶段").alias("stage")).agg(F.count("*").alias("n"))


@query("m17_validation")
def model_validation(spark, folder):
    prep = _prepared(spark, folder)
    result = validation.validate(
        _stored(spark, folder), prep.target, prep.info, prep.heat, _two_stage(spark, folder), _multiclass(spark, folder))
    return tidy(result["comparison"].select("model_name", "role", "accuracy", "macro_f1", "b_recall", "delta_vs_baseline_macro_f1"))


@query("m19_data_job", LEADS_SQL + "," + BEHAVIOR_SQL + """, c AS (SELECT CAST(min(created) + (max(created) - min(created)) * 0.8 AS DATE) AS d FROM leads)
SELECT CASE WHEN created < d THEN 'train' ELSE 'test' END AS split, left(phone, 3) || '****' || right(phone, 4) AS phone, count(*) AS n
FROM leads LEFT JOIN behavior ON phone = log_phone, c GROUP BY ALL""")
def whole_data_job(spark, folder):
    out, _ = data_job.run_all(base(spark, folder), behavior_log(spark, folder), v.RATING_RESULT)
    return tidy(out.groupBy("split", F.col(v.PHONE).alias("phone")).agg(F.count("*").alias("n")))


@query("m20_order_stage", LEADS_SQL + """, d AS (SELECT CAST(coalesce(date_diff('day', CAST(driven AS DATE), CAST(ordered AS DATE)) BETWEEN 0 AND 14, false) AS BIGINT) AS label
FROM leads WHERE driven IS NOT NULL), s AS (SELECT label, count(*) AS n FROM d GROUP BY label)
SELECT label, split, n FROM (SELECT label, 'test' AS split, CAST(CAST(n * 0.2::DOUBLE AS INTEGER) AS BIGINT) AS n FROM s UNION ALL
SELECT label, 'train', n - CAST(CAST(n * 0.2::DOUBLE AS INTEGER) AS BIGINT) FROM s)""")
def order_stage(spark, folder):
    out, _ = data_job.order_stage(leads(spark, folder, "lines", "place"))
    return tidy(out.groupBy(F.col("下订标签_14天").alias("label"), "split").agg(F.count("*").alias("n")))


# --- what SQL can say about fitted models, beside their real output -----------------------


TEST_IDS = PREPARED_SQL + "SELECT id, TRUE AS fine FROM p WHERE part = 'test'"


def _shares(columns):
    """All between 0 and 1, and 1 together."""
    total = sum((F.col(c) for c in columns), F.lit(0.0))
    inside = F.forall(F.array(*columns), lambda p: (p >= 0) & (p <= 1))
    return F.coalesce(inside & (F.abs(total - 1) < 1e-9), F.lit(False))


@query("m1_m4_probabilities", LEADS_SQL + "SELECT id, TRUE AS fine FROM leads WHERE created >= TIMESTAMP '1999-01-01'")
def binary_probabilities(spark, folder):
    scored = _window_model(spark, folder, WINDOW_TARGETS[14]).probabilities(_window_parts(spark, folder)["test"])
    return scored.select(F.col(v.LEAD_ID).alias("id"), _shares(["p_0", "p_1"]).alias("fine"))


@query("m8_m9_probabilities", LEADS_SQL + "SELECT id, TRUE AS fine FROM leads WHERE created >= TIMESTAMP '1999-01-01'")
def window_probabilities(spark, folder):
    models = {f"__p{i}": model for i, model in enumerate(_window_models(spark, folder, ALL_TARGETS).values())}
    out = tr.add_positives(_window_parts(spark, folder)["test"], models)
    inside = F.forall(F.array(*models), lambda p: (p >= 0) & (p <= 1))
    return out.select(F.col(v.LEAD_ID).alias("id"), F.coalesce(inside, F.lit(False)).alias("fine"))


@query("m10_two_stage_rows", TEST_IDS)
def two_stage_rows(spark, folder):
    """Probabilities are shares and the prediction follows from them and the threshold."""
    model = _two_stage(spark, folder)
    out = model.predict(_prepared(spark, folder).test)
    rest = F.when(F.col("p_A") >= F.col("p_B"), "A").otherwise("B")
    wanted = F.when(F.col("p_H") >= model.threshold["h_threshold"], "H").otherwise(rest)
    return out.select(F.col(v.LEAD_ID).alias("id"), (_shares(["p_H", "p_A", "p_B"]) & (F.col(v.PREDICTED) == wanted)).alias("fine"))


@query("m11_multiclass_rows", TEST_IDS)
def multiclass_rows(spark, folder):
    """Probabilities are shares and the prediction of the plain rule is the largest of them."""
    model, _ = _multiclass(spark, folder)
    out = model.predict(_prepared(spark, folder).test, rule={"strategy": "argmax"})
    largest = F.greatest("p_H", "p_A", "p_B")
    chosen = F.element_at(F.create_map(*[x for c in "HAB" for x in (F.lit(c), F.col(f"p_{c}"))]), F.col(v.PREDICTED))
    return out.select(F.col(v.LEAD_ID).alias("id"), (_shares(["p_H", "p_A", "p_B"]) & (chosen == largest)).alias("fine"))


@query("s16_reloaded_model", TEST_IDS)
def reloaded_model(spark, folder):
    """A model that is saved and loaded gives the same probabilities."""
    model, _ = _multiclass(spark, folder)
    path = f"{ensure_shared_folder(spark)}/models/reloaded"
    model.save(spark, path)
    out = tr.LeadModel.load(spark, path).probabilities(model.probabilities(_prepared(spark, folder).test), "again_")
    same = [F.col(f"p_{c}") == F.col(f"again_{c}") for c in "HAB"]
    return out.select(F.col(v.LEAD_ID).alias("id"), (same[0] & same[1] & same[2]).alias("fine"))


@query("m3_m5_one_baseline", """
SELECT CAST(4 AS BIGINT) AS models, CAST(1 AS BIGINT) AS baselines, TRUE AS best FROM (SELECT count(*) FROM orders)""")
def one_baseline(spark, folder):
    """Every family stands on the leaderboard, and the one baseline is a model of the family asked for."""
    board = model_leaderboard(spark, folder)
    mine = F.col("is_baseline") & (F.col("model") == "RandomForest")
    return board.agg(F.count("*").alias("models"), F.count_if("is_baseline").alias("baselines"), (F.count_if(mine) == 1).alias("best"))


@query("m7_importance_shares", "SELECT CAST(1.0 AS DOUBLE) AS total, TRUE AS every FROM (SELECT count(*) FROM orders)")
def importance_shares(spark, folder):
    """The importances of a forest add up to 1, with one row per feature."""
    model, _ = _multiclass(spark, folder)
    table = tr.importance_table(spark, model.importances())
    return table.agg(
        F.round(F.sum("importance"), 6).alias("total"),
        ((F.count("*") == len(model.features)) & (F.count_distinct("feature") == len(model.features))).alias("every"))


@query("m17_baseline_delta", "SELECT CAST(1 AS BIGINT) AS baselines, CAST(0.0 AS DOUBLE) AS delta FROM (SELECT count(*) FROM orders)")
def baseline_delta(spark, folder):
    rows = model_validation(spark, folder).where("role = 'baseline'")
    return rows.agg(F.count("*").alias("baselines"), F.round(F.max(F.abs("delta_vs_baseline_macro_f1")), 6).alias("delta"))


@query("m13_m15_fixed_ratings", LEADS_SQL + """, s AS (SELECT id, (ordered IS NOT NULL OR coalesce(paid = '已支付', false)) AS is_ordered FROM leads)
SELECT id, is_ordered AS simple, is_ordered AS medium, is_ordered AS advanced FROM s""")
def fixed_ratings(spark, folder):
    """Ordered leads, and no others, are rated O in each mode."""
    out = None
    for mode in ("simple", "medium", "advanced"):
        rows = _scored(spark, folder, mode).select(F.col(v.LEAD_ID).alias("id"), (F.col("评级") == "O").alias(mode))
        out = rows if out is None else out.join(rows, "id")
    return out
