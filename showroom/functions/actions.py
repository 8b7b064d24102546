"""Reason phrases and the action record of a lead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import contains_any, lookup, named, number_or_zero, truthy


def _conditions(df: DataFrame) -> dict[str, Column]:
    """Feature that names the phrase -> condition, in phrase order."""
    num = lambda c: number_or_zero(df, c)
    special = {
        "接通率": num("接通率") >= 0.5,
        "首触响应时长_小时": (num("首触响应时长_小时") > 0) & (num("首触响应时长_小时") <= 1),
        "历史到店次数": num("历史到店次数") > 0,
        "历史试驾次数": num("历史试驾次数") > 0,
        "未接通次数": num("未接通次数") > num("接通次数"),
        "通话次数": (num("有效通话") == 0) & (num("通话次数") > 0),
    }
    return {f: special.get(f, truthy(df, f)) for f in v.REASON_PHRASES}


def reason_candidates(df: DataFrame) -> Column:
    phrases = F.array(*[F.when(c, v.REASON_PHRASES[f]) for f, c in _conditions(df).items()])
    return F.filter(phrases, lambda p: p.isNotNull())


def prioritise(reasons: Column, label: Column, limit: int = 3) -> Column:
    """Phrases that fit the label first, then the rest; a fallback when there is none."""

    def first(words: list[str]) -> Column:
        return F.concat(
            F.filter(reasons, lambda r: contains_any(r, words)),
            F.filter(reasons, lambda r: ~contains_any(r, words)),
        )

    ordered = F.when(label == "H", first(v.REASON_FIRST_WORDS["H"]))
    ordered = ordered.when(label == "B", first(v.REASON_FIRST_WORDS["B"])).otherwise(reasons)
    fallback = F.array(lookup(v.REASON_FALLBACK, label, F.lit(v.REASON_FALLBACK_OTHER)))
    return F.when(F.size(reasons) == 0, fallback).otherwise(F.slice(ordered, 1, limit))


def sop_text(label: Column) -> Column:
    return lookup(v.SOP_TEXT, label, F.lit(v.SOP_OTHER))


def level_name(label: Column) -> Column:
    return lookup(v.LEVEL_NAME, label, label)


def lead_actions(
    df: DataFrame,
    label: str = v.PREDICTED,
    probabilities: dict[str, Column] | None = None,
    lead_id: str = v.LEAD_ID,
) -> DataFrame:
    """One action record per lead: rating, texts, up to three reasons, probabilities."""
    probabilities = probabilities or {}
    out = df.withColumn("__found", reason_candidates(df))
    out = out.withColumn("__reasons", prioritise(F.col("__found"), named(label)))
    reason = lambda i: F.coalesce(F.get("__reasons", F.lit(i)), F.lit(""))
    return out.select(
        named(lead_id).alias(v.LEAD_ID),
        named(label).alias("预测HAB"),
        level_name(named(label)).alias("等级说明"),
        sop_text(named(label)).alias("建议SOP"),
        *[reason(i).alias(f"原因{i + 1}") for i in range(3)],
        *[
            F.coalesce(probabilities.get(k, F.lit(0.0)), F.lit(0.0)).alias(f"概率_{k}")
            for k in v.HAB_ORDER
        ],
    )
