"""The data job: merge → profile → clean → de-identify → split, and the order-stage dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from showroom import vocab as v
from showroom.functions.labels import order_date_labels
from showroom.functions.status import is_driven
from showroom.operators import behavior as bh, cleaning as cg, contract as ct, deidentify as di, profiling as pf, splits as sp
from showroom.session import hand_over
from showroom.sources.writers import write_parquet

STEPS = ("merge", "profile", "clean", "deidentify", "split")


def run_step(step: str, df: DataFrame, **options) -> tuple[DataFrame, object]:
    """One step alone: the table after it, and what it reports."""
    if step == "merge":
        log = options.get("log")
        if log is None:
            raise ValueError("merge needs a behaviour log")
        merged = bh.merge_leads(df, log, options.get("phone"))
        return merged, bh.match_statistics(merged)
    if step == "profile":
        return df, pf.full_profile(df, options.get("target"))
    if step == "clean":
        # Several column-pruned passes follow; they read a table instead of repeating the join.
        return cg.clean(hand_over(df, "merged"), **options.get("cleaning", {}))
    if step == "deidentify":
        return di.deidentify(df)
    if step == "split":
        return sp.auto_split(df, options.get("target"), options.get("lead_id", v.LEAD_ID), options.get("time", v.CREATED))
    raise ValueError(f"unknown step: {step}")


def run_all(
    leads: DataFrame, log: DataFrame | None = None, target: str | None = None, skip: Sequence[str] = (),
    output: str | None = None, **options,
) -> tuple[DataFrame, dict]:
    """Chain of steps in one session. A failing step stops the job. Nothing is written between the
    steps; the split labels the rows and the writer partitions by it."""
    unknown = [s for s in skip if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    df, reports = leads, {}
    for step in STEPS:
        if step in skip or (step == "merge" and log is None):
            continue
        df, reports[step] = run_step(step, df, log=log, target=target, **options)
    if output:
        write_parquet(df, output, by=[sp.SPLIT] if sp.SPLIT in df.columns else None)
    return df, reports


def order_stage(
    df: DataFrame, keep: Sequence[str] = (), split: str | None = "random", target: str = "下订标签_14天", cutoff=None,
    lead_id: str = v.LEAD_ID, test_ratio: float = 0.2, deidentify: bool = True,
) -> tuple[DataFrame, dict]:
    """Driven leads → order labels → split → order-stage projection → masks.

    The split comes before the ids are dropped, because it is ordered by the id.
    """
    rows = order_date_labels(df.where(is_driven(df)))
    if split == "random":
        rows = sp.random_split(rows, target, lead_id, test_ratio)
    elif split == "time":
        rows = sp.time_split(rows, cutoff)
    rows = ct.order_stage_projection(rows, list(keep))
    touched: list[str] = []
    if deidentify:
        rows, touched = di.deidentify_order_stage(rows)
    return rows, {"touched": touched, "columns": rows.columns}
