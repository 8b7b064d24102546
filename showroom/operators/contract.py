"""Schema contract: canonical names, leakage-safe projections, feature alignment, screening."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import is_blank, named

EXPRESSIONS_PER_PASS = 200


@dataclass
class ContractReport:
    version: str = v.CONTRACT_VERSION
    applied_aliases: dict[str, str] = field(default_factory=dict)
    filled_aliases: dict[str, str] = field(default_factory=dict)
    dropped_aliases: list[str] = field(default_factory=list)
    canonical_columns: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)


def apply_alias_contract(
    df: DataFrame, aliases: dict[str, str] | None = None, report_fills: bool = True
) -> tuple[DataFrame, ContractReport]:
    """Fold alias columns into canonical ones.

    All aliases of one canonical column are resolved in a single projection: the canonical value
    wins, blanks are filled from the aliases in contract order. Which aliases really filled a cell
    is counted in one aggregation, and only when two columns compete.
    """
    aliases = v.ALIASES if aliases is None else aliases
    report = ContractReport()
    sources: dict[str, list[str]] = {}
    for alias, canonical in aliases.items():
        if alias in df.columns and alias != canonical:
            sources.setdefault(canonical, []).append(alias)

    expressions, fills, gone = {}, {}, set()
    for canonical, found in sources.items():
        keep = canonical if canonical in df.columns else found[0]
        if keep != canonical:
            report.applied_aliases[keep] = canonical
        value, missing = named(keep), is_blank(df, keep)
        for alias in found:
            gone.add(alias)
            if alias == keep:
                continue
            takes = missing & ~is_blank(df, alias)
            fills[alias] = (canonical, takes)
            value = F.when(takes, named(alias).cast(df.schema[keep].dataType)).otherwise(value)
            missing = missing & is_blank(df, alias)
            report.dropped_aliases.append(alias)
        expressions[canonical] = value

    if fills and report_fills:
        counts = df.agg(*[F.max(t.cast("int")).alias(a) for a, (_, t) in fills.items()]).first()
        report.filled_aliases = {a: c for a, (c, _) in fills.items() if counts[a] == 1}

    projection, done = [], set()
    for name in df.columns:
        canonical = aliases.get(name, name)
        if name in gone and report.applied_aliases.get(name) != canonical:
            continue
        if canonical in done:
            continue
        done.add(canonical)
        projection.append(expressions.get(canonical, named(name)).alias(canonical))
    out = df.select(*projection)
    report.canonical_columns = sorted(out.columns)
    return out, report


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; found {df.columns[:10]}")
    return df


def normal_name(name: str) -> str:
    if name in v.EXACT_NAMES:
        return v.EXACT_NAMES[name]
    return re.sub(r"_+", "_", re.sub(r"[（）()/]", "_", name)).strip("_")


def changed_names(columns: list[str]) -> dict[str, str]:
    return {c: normal_name(c) for c in columns if normal_name(c) != c}


def normalise_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(changed_names(df.columns))


# --- leakage ------------------------------------------------------------------------


def sibling_labels(target: str) -> list[str]:
    group = next((g for g in v.LABEL_GROUPS if target in g), [target])
    return [label for label in group if label != target]


def excluded_columns(target: str) -> list[str]:
    """Id, leakage and sibling-label columns; never the target."""
    names = dict.fromkeys(v.ID_COLUMNS + v.LEAKAGE_COLUMNS + sibling_labels(target))
    names.pop(target, None)
    return list(names)


def resolve_target(df: DataFrame, target: str) -> str:
    """The two names of the rating target stand in for each other."""
    twins = {v.RATING_RESULT: v.RATING_BEFORE_DRIVE, v.RATING_BEFORE_DRIVE: v.RATING_RESULT}
    if target in df.columns or target not in twins:
        return target
    return twins[target] if twins[target] in df.columns else target


def remaining_leaks(columns: list[str], target: str) -> list[str]:
    return [label for label in sibling_labels(target) if label in columns]


def training_projection(df: DataFrame, target: str) -> DataFrame:
    target = resolve_target(df, target)
    out = df.drop(*excluded_columns(target))
    leaks = remaining_leaks(out.columns, target)
    if leaks:
        raise ValueError(f"sibling labels left in the training table: {leaks}")
    return out


def order_stage_projection(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return df.drop(*[c for c in v.ORDER_STAGE_LEAKAGE + v.ORDER_STAGE_IDS if c not in keep])


def feature_columns(columns: list[str], target: str) -> list[str]:
    excluded = set(excluded_columns(target)) | {target}
    return [c for c in columns if c not in excluded]


def scoring_projection(df: DataFrame, excluded: list[str], keep_labels: bool = True) -> DataFrame:
    """Drop excluded columns; label-like columns may stay for later evaluation."""
    is_label = lambda c: keep_labels and any(m in c for m in v.LABEL_MARKERS)
    return df.drop(*[c for c in excluded if c in df.columns and not is_label(c)])


def align_to_features(
    df: DataFrame, features: list[str], label: str | None = None, name: str = "data"
) -> DataFrame:
    """Exactly the trained features, in trained order; a missing one is an error."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {len(missing)} trained features, e.g. {missing[:10]}")
    if label is not None and label not in df.columns:
        raise ValueError(f"{name} lacks the label {label}")
    return df.select(*[named(f) for f in features], *([named(label)] if label else []))


def leakage_residual(df: DataFrame, target: str | None = None) -> list[str]:
    known = set(excluded_columns(target)) if target else set(v.LEAKAGE_COLUMNS)
    return sorted(known & set(df.columns))


# --- screening ----------------------------------------------------------------------


def column_facts(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Null share, and whether the non-null values are all equal, for every column.

    Bounded result: three numbers per column, at most EXPRESSIONS_PER_PASS columns per pass.
    """
    facts: dict[str, dict] = {}
    for start in range(0, len(columns), EXPRESSIONS_PER_PASS):
        batch = columns[start : start + EXPRESSIONS_PER_PASS]
        row = df.agg(
            F.count("*").alias("rows"),
            *[F.count(named(c)).alias(f"n{i}") for i, c in enumerate(batch)],
            *[(F.min(named(c)) == F.max(named(c))).alias(f"s{i}") for i, c in enumerate(batch)],
        ).first()
        for i, c in enumerate(batch):
            filled = row[f"n{i}"]
            facts[c] = {
                "rows": row["rows"],
                "nulls": row["rows"] - filled,
                "null_share": (row["rows"] - filled) / row["rows"] if row["rows"] else 0.0,
                "single_value": filled == 0 or bool(row[f"s{i}"]),
            }
    return facts


def screen_raw(
    df: DataFrame, target: str, high_missing: float = 0.95, indicator_missing: float = 0.70
) -> tuple[DataFrame, dict]:
    """Drop weak and nearly empty columns; mark the semantic ones that are mostly empty."""
    columns = [c for c in df.columns if c != target]
    facts = column_facts(df, [c for c in columns if c not in v.WEAK_COLUMNS])
    marks = [
        c + v.INDICATOR_SUFFIX for c in facts
        if c in v.SEMANTIC_COLUMNS and facts[c]["null_share"] >= indicator_missing
        and c + v.INDICATOR_SUFFIX not in df.columns
    ]
    report = {
        "dropped_high_missing": [c for c in facts if facts[c]["null_share"] > high_missing],
        "dropped_weak_semantic": [c for c in columns if c in v.WEAK_COLUMNS],
        "added_missing_indicators": marks,
    }
    added = {m: named(m.removesuffix(v.INDICATOR_SUFFIX)).isNull().cast("int") for m in marks}
    out = df.withColumns(added) if added else df
    return out.drop(*report["dropped_high_missing"], *report["dropped_weak_semantic"]), report


def screen_features(df: DataFrame, target: str, high_missing: float = 0.95) -> tuple[DataFrame, dict]:
    """After feature building: drop nearly empty and constant columns."""
    facts = column_facts(df, [c for c in df.columns if c != target])
    empty = [c for c in facts if facts[c]["null_share"] > high_missing]
    constant = [c for c in facts if c not in empty and facts[c]["single_value"]]
    return df.drop(*empty, *constant), {"dropped_high_missing": empty, "dropped_constant": constant}


def screen_all(
    df: DataFrame, target: str, high_missing: float = 0.95, indicator_missing: float = 0.70
) -> tuple[DataFrame, dict]:
    raw_df, raw = screen_raw(df, target, high_missing, indicator_missing)
    out, post = screen_features(raw_df, target, high_missing)
    return out, {
        "raw_schema_report": raw,
        "post_feature_screening_report": post,
        "dropped_high_missing": sorted({*raw["dropped_high_missing"], *post["dropped_high_missing"]}),
        "dropped_constant": post["dropped_constant"],
        "dropped_weak_semantic": raw["dropped_weak_semantic"],
        "added_missing_indicators": raw["added_missing_indicators"],
    }


def replay_screening(df: DataFrame, report: dict) -> DataFrame:
    """Apply a saved report, nested or flat, to another table. Indicators are built before their
    source may be dropped, so that every table gets the columns the training table got."""
    nested = [report[k] for k in ("raw_schema_report", "post_feature_screening_report") if report.get(k)]
    for part in nested or [report]:
        marks = {
            m: named(m.removesuffix(v.INDICATOR_SUFFIX)).isNull().cast("int")
            for m in part.get("added_missing_indicators", [])
            if m.removesuffix(v.INDICATOR_SUFFIX) in df.columns and m not in df.columns
        }
        df = df.withColumns(marks) if marks else df
        df = df.drop(*[
            c for key in ("dropped_high_missing", "dropped_constant", "dropped_weak_semantic")
            for c in part.get(key, [])
        ])
    return df
