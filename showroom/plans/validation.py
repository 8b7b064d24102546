"""Validation job: isolate the test rows, replay the preparation, compare models, write tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.ratings import apply_policy
from showroom.functions.scorecard import add_scorecard, score_probabilities
from showroom.operators import business as bz, contract as ct, features as ft, policy as po, splits as sp
from showroom.plans.training import LeadModel, TwoStage
from showroom.session import hand_over
from showroom.sources.stores import write_sidecar
from showroom.sources.writers import write_parquet

PROBABILITIES = {c: f"p_{c}" for c in v.HAB_ORDER}


def replay(df: DataFrame, target: str, info: dict, heat: DataFrame | None) -> DataFrame:
    """Label policy, screening and features as they were fitted."""
    rule = info["label_policy"]
    rows = po.keep_effective(po.apply_policy(df, target, rule), target, rule)
    rows = ct.replay_screening(rows, info["raw_schema_report"])
    return ct.replay_screening(ft.transform(rows, heat), info["post_feature_screening_report"])


def model_report(
    spark: SparkSession, path: str, name: str, metrics: dict, top_k: DataFrame, importances: dict[str, float] | None = None,
    bins: DataFrame | None = None,
) -> dict:
    """Report record of one model: metrics, top-k rows, the 20 largest importances, bins. All parts are short."""
    rows = lambda d: [r.asDict() for r in d.collect()]
    report = {"model_name": name, "model_metrics": metrics, "topk_metrics": {f"top_{r['k']}": r for r in rows(top_k)}}
    if importances is not None:
        report["feature_importance"] = [{"feature": f, "importance": x} for f, x in list(importances.items())[:20]]
    if bins is not None:
        report["stratified_metrics"] = rows(bins)
    write_sidecar(spark, f"{path}/{name}_report", report)
    return report


def judged_by_model(df: DataFrame, model: LeadModel, rule: dict | None = None) -> DataFrame:
    out = model.probabilities(df)
    return out.withColumn(v.PREDICTED, apply_policy({c: F.col(f"p_{c}") for c in model.classes}, rule))


def judged_by_scorecard(df: DataFrame) -> DataFrame:
    out = add_scorecard(df)
    return out.withColumns(score_probabilities(F.col("总分")))


def compare(
    df: DataFrame, target: str, two_stage: TwoStage | None = None, baseline: tuple[LeadModel, dict] | None = None,
    scorecard: bool = True, lead_id: str = v.LEAD_ID,
) -> dict[str, dict[str, DataFrame]]:
    """Evaluation tables of every model on the same prepared rows, keyed by role."""
    judged = {}
    if two_stage:
        judged["two_stage"] = ("two_stage_pipeline", two_stage.predict(df))
    if baseline:
        judged["baseline"] = (f"multiclass_{baseline[0].family}", judged_by_model(df, *baseline))
    if scorecard:
        judged["scorecard"] = ("scorecard_5d_trimmed", judged_by_scorecard(df))
    out = {}
    for role, (name, rows) in judged.items():
        # Ten tables read these rows: score them once.
        rows = hand_over(rows, f"judged-{role}")
        out[role] = bz.comparator_bundle(rows, name, role, target, PROBABILITIES, lead_id)
        if role == "scorecard":
            coverage = rows.agg(F.avg("字段覆盖率").alias("c")).scalar()
            out[role]["comparison_row"] = out[role]["comparison_row"].withColumn("scorecard_coverage_mean", coverage)
    return out


def validate(
    df: DataFrame, target: str, info: dict, heat: DataFrame | None, two_stage: TwoStage | None = None,
    baseline: tuple[LeadModel, dict] | None = None, recorded_ids: DataFrame | None = None, output: str | None = None,
    lead_id: str = v.LEAD_ID,
) -> dict:
    """The whole validation. Returns the tables per role, the comparison and the recommendation."""
    unseen = sp.isolate_test(df, info["split_info"], recorded_ids)
    ready = hand_over(replay(po.drop_unknown(unseen, target), target, info, heat), "unseen")
    bundles = compare(ready, target, two_stage, baseline, lead_id=lead_id)
    comparison = hand_over(bz.compare_models([b["comparison_row"] for b in bundles.values()]), "comparison")
    result = {"bundles": bundles, "comparison": comparison, "recommended": bz.recommend(comparison)}
    if output:
        for role, tables in bundles.items():
            for name, t in tables.items():
                write_parquet(t, f"{output}/{role}/{name}")
        write_parquet(comparison, f"{output}/model_comparison")
        write_parquet(result["recommended"], f"{output}/recommended")
    return result
