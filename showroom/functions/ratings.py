"""Ratings from probabilities: O/H/A/B/C/N rules, scores, H/A/B rules and decision policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import half_even, lookup, named
from showroom.functions.status import is_driven, is_invalid, is_ordered

DEFAULT_THRESHOLDS = {"H": 0.5, "A": 0.5, "B": 0.5}


def _with_terminal(ordered: Column, invalid: Column, otherwise: Column) -> Column:
    return F.when(ordered, "O").when(invalid, "N").otherwise(otherwise)


def rating_simple(p: Column, ordered: Column, invalid: Column, threshold: float = 0.5) -> Column:
    grade = (
        F.when(p >= threshold, "H")
        .when(p >= threshold * 0.7, "A")
        .when(p >= threshold * 0.3, "B")
        .otherwise("C")
    )
    return _with_terminal(ordered, invalid, grade)


def _by_windows(p7: Column, p14: Column, p21: Column, t: dict[str, float]) -> Column:
    return (
        F.when(p7 >= t["H"], "H").when(p14 >= t["A"], "A").when(p21 >= t["B"], "B").otherwise("C")
    )


def rating_medium(
    p7: Column, p14: Column, p21: Column, ordered: Column, invalid: Column,
    thresholds: dict[str, float] | None = None,
) -> Column:
    return _with_terminal(ordered, invalid, _by_windows(p7, p14, p21, thresholds or DEFAULT_THRESHOLDS))


def rating_advanced(
    drive: tuple[Column, Column, Column], order: tuple[Column, Column, Column],
    ordered: Column, driven: Column, invalid: Column,
    thresholds: dict[str, float] | None = None,
) -> Column:
    t = thresholds or DEFAULT_THRESHOLDS
    grade = F.when(driven, _by_windows(*order, t)).otherwise(_by_windows(*drive, t))
    return _with_terminal(ordered, invalid, grade)


def stage(ordered: Column, invalid: Column, driven: Column | None = None) -> Column:
    after = F.lit(v.STAGE_BEFORE)
    if driven is not None:
        after = F.when(driven, v.STAGE_AFTER).otherwise(v.STAGE_BEFORE)
    return F.when(ordered, v.STAGE_ORDERED).when(invalid, v.STAGE_INVALID).otherwise(after)


def score(
    rating: Column, p7: Column, p14: Column, p21: Column, default_p14: float = 0.5
) -> Column:
    """Weighted score 0..100. A 14-day probability of 0 counts as ``default_p14``; this
    quirk belongs to the rule and can be switched off with 0."""
    total = v.SCORE_WEIGHT_7 + v.SCORE_WEIGHT_14 + v.SCORE_WEIGHT_21
    above_zero = lambda p, other: F.when(p > 0, p).otherwise(F.lit(other))
    raw = (
        above_zero(p7, 0.0) * v.SCORE_WEIGHT_7
        + above_zero(p14, default_p14) * v.SCORE_WEIGHT_14
        + above_zero(p21, 0.0) * v.SCORE_WEIGHT_21
    )
    return (
        F.when(rating == "O", 100.0)
        .when(rating == "N", 0.0)
        .otherwise(half_even(raw / total * 100, 2))
    )


def add_rating(
    df: DataFrame,
    mode: str,
    drive: dict[int, Column],
    order: dict[int, Column] | None = None,
    thresholds: dict[str, float] | None = None,
    with_score: bool = True,
    with_probability: bool = True,
) -> DataFrame:
    """Append 评级, 阶段, 分值 and the probabilities. ``mode`` is simple, medium or advanced."""
    t = {**DEFAULT_THRESHOLDS, **(thresholds or {})}
    needed = {"simple": [14], "medium": [7, 14, 21], "advanced": [7, 14, 21]}
    if mode not in needed:
        raise ValueError(f"unknown mode: {mode}")
    if any(n not in drive for n in needed[mode]):
        raise ValueError(f"mode {mode} needs drive probabilities for {needed[mode]}")
    if mode == "advanced" and any(n not in (order or {}) for n in (7, 14, 21)):
        raise ValueError("mode advanced needs order probabilities for 7, 14 and 21 days")

    base = df.withColumns(
        {"__ordered": is_ordered(df), "__invalid": is_invalid(df), "__driven": is_driven(df)}
    )
    ordered, invalid, driven = F.col("__ordered"), F.col("__invalid"), F.col("__driven")
    zero = F.lit(0.0)
    if mode == "simple":
        grade = rating_simple(drive[14], ordered, invalid, t["H"])
        where = stage(ordered, invalid)
        points = score(grade, zero, drive[14], zero)
    elif mode == "medium":
        windows = (drive[7], drive[14], drive[21])
        grade = rating_medium(*windows, ordered, invalid, t)
        where = stage(ordered, invalid)
        points = score(grade, *windows)
    else:
        before = (drive[7], drive[14], drive[21])
        after = (order[7], order[14], order[21])
        grade = rating_advanced(before, after, ordered, driven, invalid, t)
        where = stage(ordered, invalid, driven)
        points = F.when(driven, score(grade, *after)).otherwise(score(grade, *before))

    columns = {"评级": grade, "阶段": where}
    if with_score:
        columns["分值"] = points
    if with_probability:
        columns |= {f"试驾概率_{n}天": drive[n] for n in needed[mode]}
        if mode == "advanced":
            columns |= {f"下订概率_{n}天": order[n] for n in (7, 14, 21)}
    return base.withColumns(columns).drop("__ordered", "__invalid", "__driven")


def rating_distribution(df: DataFrame, rating: str = "评级", order: list[str] | None = None) -> DataFrame:
    """Rows per rating, absent ratings with 0, in one aggregation."""
    order = order or v.RATING_ORDER
    counts = df.agg(*[F.count_if(named(rating) == r).alias(r) for r in order])
    pairs = ", ".join(f"'{r}', `{r}`" for r in order)
    return counts.selectExpr(f"stack({len(order)}, {pairs}) as (rating, n)")


# --- H/A/B/N from three windows ----------------------------------------------------

def percent(p: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", p * 100)


def hab_rating(p7: Column, p14: Column, p21: Column, threshold: float = 0.5) -> Column:
    return (
        F.when(p7 >= threshold, "H").when(p14 >= threshold, "A").when(p21 >= threshold, "B").otherwise("N")
    )


def hab_columns(p7: Column, p14: Column, p21: Column, threshold: float = 0.5) -> dict[str, Column]:
    """Rating, confidence, explanation and days until the next contact."""
    rating = hab_rating(p7, p14, p21, threshold)
    highest = F.greatest(p7, p14, p21)
    text = v.HAB_TEXT
    explanation = (
        F.when(rating == "H", F.concat(F.lit(text["H"] + "（P(7天试驾)="), percent(p7), F.lit("）")))
        .when(rating == "A", F.concat(F.lit(text["A"] + "（P(14天试驾)="), percent(p14),
                                      F.lit("，P(7天试驾)="), percent(p7), F.lit("）")))
        .when(rating == "B", F.concat(F.lit(text["B"] + "（P(21天试驾)="), percent(p21),
                                      F.lit("，P(14天试驾)="), percent(p14), F.lit("）")))
        .otherwise(F.lit(f"{text['N']}（所有时间窗口概率均低于阈值{threshold:.0%}）"))
    )
    return {
        "rating": rating,
        "confidence": F.when(rating == "N", highest).otherwise(F.least(highest, F.lit(1.0))),
        "explanation": explanation,
        "next_contact_days": next_contact_days(rating),
    }


def next_contact_days(rating: Column, order_stage: bool = False) -> Column:
    return lookup(v.NEXT_CONTACT_DAYS_ORDER_STAGE if order_stage else v.NEXT_CONTACT_DAYS, rating)


def factor_lists(contributions: Column) -> dict[str, Column]:
    """``contributions`` is an array of (name, value). Among the 3 largest by size the positive
    ones, among the 5 largest the negative ones, as ``name: percent``."""
    by_size = F.transform(
        F.array_sort(
            F.transform(
                contributions,
                lambda c, i: F.struct(
                    (-F.abs(c["value"])).alias("size"), i.alias("at"), c["name"].alias("name"),
                    c["value"].alias("value"),
                ),
            )
        ),
        lambda c: F.struct(c["name"].alias("name"), c["value"].alias("value")),
    )
    text = lambda c: F.concat(c["name"], F.lit(": "), percent(c["value"]))
    return {
        "positive_factors": F.transform(
            F.filter(F.slice(by_size, 1, 3), lambda c: c["value"] > 0), text),
        "risk_factors": F.transform(
            F.filter(F.slice(by_size, 1, 5), lambda c: c["value"] < 0), text),
    }


# --- class-probability rules ---------------------------------------------------------

ENGINE_THRESHOLDS = {"H": 0.5, "A": 0.4, "B": 0.3}


def engine_columns(h: Column, a: Column, b: Column, thresholds: dict[str, float] | None = None) -> dict[str, Column]:
    t = {**ENGINE_THRESHOLDS, **(thresholds or {})}
    rating = F.when(h >= t["H"], "H").when(a >= t["A"], "A").when(b >= t["B"], "B").otherwise("N")
    explain = F.lit(v.HAB_TEXT["N"])
    for label, p in (("B", b), ("A", a), ("H", h)):
        line = F.concat(F.lit(f"{v.HAB_TEXT[label]}（P({label})="), percent(p), F.lit("）"))
        explain = F.when(rating == label, line).otherwise(explain)
    return {"rating": rating, "explanation": explain}


def argmax_label(probabilities: dict[str, Column]) -> Column:
    """Class with the highest probability; the first class wins a tie."""
    best = F.greatest(*probabilities.values()) if len(probabilities) > 1 else next(iter(probabilities.values()))
    choice = F.lit(None).cast("string")
    for label in reversed(list(probabilities)):
        choice = F.when(probabilities[label] == best, label).otherwise(choice)
    return choice


def apply_policy(probabilities: dict[str, Column], policy: dict | None = None) -> Column:
    """H by its threshold, then B by its threshold, then A; otherwise the highest class."""
    policy = policy or {}
    if policy.get("strategy") != "hab_threshold":
        return argmax_label(probabilities)
    zero = F.lit(0.0)
    rest = F.lit("A") if "A" in probabilities else argmax_label(probabilities)
    return (
        F.when(probabilities.get("H", zero) >= float(policy.get("h_threshold", 0.50)), "H")
        .when(probabilities.get("B", zero) >= float(policy.get("b_threshold", 0.30)), "B")
        .otherwise(rest)
    )


def combine_stages(h: Column, a: Column, b: Column, threshold: float) -> dict[str, Column]:
    """Stage one says H or not; stage two shares the rest between A and B."""
    h, a, b = (F.coalesce(x.cast("double"), F.lit(0.0)) for x in (h, a, b))
    return {
        v.PREDICTED: F.when(h >= threshold, "H").when(a >= b, "A").otherwise("B"),
        "p_H": h,
        "p_A": (1.0 - h) * a,
        "p_B": (1.0 - h) * b,
    }
