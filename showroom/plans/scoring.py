"""Scoring jobs: simple, medium and advanced ratings from fitted models."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import named
from showroom.functions.ratings import add_rating
from showroom.functions.status import is_driven
from showroom.operators import contract as ct, features as ft
from showroom.operators.ranking import K_VALUES, resolve_score, top_list
from showroom.plans.training import LeadModel, add_positives
from showroom.session import hand_over
from showroom.sources.writers import write_delimited

log = logging.getLogger(__name__)
WINDOWS = (7, 14, 21)
DEFAULT_PROBABILITY = 0.5
DRIVE, ORDER = "试驾标签", "下订标签"


def _feature_rows(df: DataFrame, heat: DataFrame | None) -> DataFrame:
    """Fitted features are replayed, never refitted; a scored table without a heat gets none."""
    if heat is not None:
        return ft.transform(df, heat)
    out = ft.numbers(ft.time_parts(df))
    new = ft.interaction_columns(out)
    return out.withColumns(new) if new else out


def _add_probabilities(df: DataFrame, models: dict[str, LeadModel | None], when_missing: float | None = None) -> DataFrame:
    """Positive probabilities of models by the names of their columns; no model gives 0, missing features give the default."""
    fixed, usable = {}, {}
    for name, model in models.items():
        lacking = [c for c in model.features if c not in df.columns] if model is not None else []
        if model is None:
            fixed[name] = F.lit(0.0)
        elif lacking and when_missing is not None:
            log.warning("%s lacks %d features; the probability is set to %s", name, len(lacking), when_missing)
            fixed[name] = F.lit(when_missing)
        else:
            usable[name] = model
    out = add_positives(df, usable)
    return out.withColumns(fixed) if fixed else out


def score_simple(df: DataFrame, model: LeadModel, heat: DataFrame | None = None, thresholds: dict | None = None) -> DataFrame:
    out = _add_probabilities(_feature_rows(df, heat), {"__p14": model})
    return add_rating(out, "simple", {14: F.col("__p14")}, thresholds=thresholds).drop("__p14")


def score_medium(
    df: DataFrame, models: dict[int, LeadModel], heat: DataFrame | None = None, thresholds: dict | None = None
) -> DataFrame:
    out = _add_probabilities(_feature_rows(df, heat), {f"__p{n}": models.get(n) for n in WINDOWS})
    drive = {n: F.col(f"__p{n}") for n in WINDOWS}
    return add_rating(out, "medium", drive, thresholds=thresholds).drop(*[f"__p{n}" for n in WINDOWS])


def score_advanced(
    df: DataFrame, drive_models: dict[int, LeadModel], order_models: dict[int, LeadModel], heat: DataFrame | None = None,
    order_heat: DataFrame | None = None, thresholds: dict | None = None,
) -> DataFrame:
    """Driven rows are scored by the order models, the others by the drive models; the unused
    probabilities are 0. Each row passes through one branch only; both read the rows from one stored table."""
    marked = hand_over(df.withColumn("__driven", is_driven(df)), "to-score")

    def branch(rows: DataFrame, models: dict[int, LeadModel], used: str, unused: str, fitted, default) -> DataFrame:
        out = _add_probabilities(_feature_rows(rows, fitted), {f"__{used}{n}": models.get(n) for n in WINDOWS}, default)
        return out.withColumns({f"__{unused}{n}": F.lit(0.0) for n in WINDOWS})

    before = branch(marked.where(~F.col("__driven")), drive_models, "d", "o", heat, None)
    after = branch(marked.where(F.col("__driven")), order_models, "o", "d", order_heat if order_heat is not None else heat, DEFAULT_PROBABILITY)
    both = before.unionByName(after, allowMissingColumns=True)
    drive = {n: F.col(f"__d{n}") for n in WINDOWS}
    order = {n: F.col(f"__o{n}") for n in WINDOWS}
    rated = add_rating(both, "advanced", drive, order, thresholds)
    return rated.drop("__driven", *[f"__{k}{n}" for k in "do" for n in WINDOWS])


RESULT_COLUMNS = ["评级", "阶段", "分值"] + [f"{k}概率_{n}天" for k in ("试驾", "下订") for n in WINDOWS]


def score(
    df: DataFrame, mode: str, models: dict, lead_id: str = v.LEAD_ID, include_original: bool = False,
    thresholds: dict | None = None, output: str | None = None,
) -> DataFrame:
    """Scoring entry. ``models``: ``model`` (simple), ``drive`` / ``order`` per window, ``heat``."""
    heat = models.get("heat")
    if mode == "simple":
        out = score_simple(df, models["model"], heat, thresholds)
    elif mode == "medium":
        out = score_medium(df, models["drive"], heat, thresholds)
    elif mode == "advanced":
        out = score_advanced(df, models["drive"], models["order"], heat, models.get("order_heat"), thresholds)
    else:
        raise ValueError(f"unknown mode: {mode}")
    keep = df.columns if include_original else ([lead_id] if lead_id in df.columns else [])
    out = out.select(*[named(c) for c in keep], *[named(c) for c in RESULT_COLUMNS if c in out.columns])
    if output:
        write_delimited(out, output)
    return out


def write_top_lists(
    df: DataFrame, model: LeadModel, output: str, target_class: str | None = None, lead_id: str = v.LEAD_ID,
    ks: Sequence[int] = K_VALUES,
) -> dict[int, DataFrame]:
    """One list per k as text, with the true label where it is known. A k above the row count is
    left out; it is an error when none remains."""
    columns = {c: f"p_{c}" for c in model.classes}
    score_column = resolve_score(columns, target_class)
    label = model.label if model.label in df.columns else None
    keep = [lead_id, score_column] + ([label] if label else [])
    scored = hand_over(model.probabilities(df).select(*[named(c) for c in keep]), "scored")
    rows = scored.count()
    usable = [k for k in ks if k <= rows]
    if not usable:
        raise ValueError(f"no k of {list(ks)} fits {rows} rows")
    lists = {k: top_list(scored, score_column, lead_id, label, k) for k in usable}
    for k, best in lists.items():
        write_delimited(best, f"{output}_top{k}.csv")
    return lists


def scoring_frame(df: DataFrame, target: str, heat: DataFrame | None = None, keep_labels: bool = True) -> DataFrame:
    """Features replayed and excluded columns removed; label-like columns stay for evaluation."""
    return ct.scoring_projection(_feature_rows(df, heat), ct.excluded_columns(target), keep_labels)
