"""Label policy learned on the training part and replayed elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import named

MAX_CLASSES = 1000


def ordered_labels(labels, order: list[str] = v.OHAB_ORDER, extras: bool = True) -> list[str]:
    found = {str(x) for x in labels if x is not None}
    known = [x for x in order if x in found]
    return known + (sorted(found - set(order)) if extras else [])


def class_counts(df: DataFrame, label: str) -> dict[str, int]:
    """Rows per class; null is not a class. A column with too many values is not a label."""
    rows = (
        df.where(named(label).isNotNull()).groupBy(named(label).cast("string").alias("label"))
        .agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    return {r["label"]: r["n"] for r in rows}


def build_policy(
    train: DataFrame, target: str, mode: str = "ohab", o_merge_threshold: int = 50, merge_target: str = "H"
) -> dict:
    """Class counts come to the driver, one row per class."""
    counts = class_counts(train, target)
    raw = ordered_labels(counts)
    o_count = counts.get("O", 0)
    merged = mode != "hab" and 0 < o_count < o_merge_threshold
    mapping = {"O": merge_target} if merged else {}
    kept = {mapping.get(x, x) for x in counts}
    effective = ordered_labels(kept, v.HAB_ORDER, extras=False) if mode == "hab" else ordered_labels(kept)
    return {
        "target_label": target, "label_mode": mode, "raw_classes": raw, "effective_classes": effective,
        "excluded_classes": [x for x in raw if x not in effective], "o_count_train": o_count,
        "o_merge_threshold": o_merge_threshold, "merge_target": merge_target, "merged": merged,
        "mapping": mapping,
    }


def apply_policy(df: DataFrame, target: str, policy: dict) -> DataFrame:
    mapping = policy.get("mapping") or {}
    if not mapping or target not in df.columns:
        return df
    value: Column = named(target)
    for old, new in mapping.items():
        value = F.when(named(target) == old, new).otherwise(value)
    return df.withColumn(target, value)


def keep_effective(df: DataFrame, target: str, policy: dict) -> DataFrame:
    classes = policy.get("effective_classes") or []
    if target not in df.columns or not classes:
        return df
    return df.where(named(target).isin(classes))


def drop_unknown(df: DataFrame, target: str) -> DataFrame:
    return df.where(named(target).isNotNull() & (named(target) != v.UNKNOWN_LABEL))


def stage_one_label(target: Column) -> Column:
    return F.when(target.cast("string") == "H", "H").otherwise(v.NOT_H)


def stage_two_rows(df: DataFrame, target: str, name: str = "stage2_label") -> DataFrame:
    return df.where(named(target).cast("string") != "H").withColumn(name, named(target).cast("string"))
