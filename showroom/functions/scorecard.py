"""Five-dimension scorecard and its pseudo-probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import add_all, any_of, clip_ratio, half_even, number_or_zero, present, truthy

H_FROM, A_FROM = 75.0, 60.0


def _share(condition: Column) -> Column:
    return condition.cast("double")


def dimension_scores(df: DataFrame) -> dict[str, Column]:
    num = lambda c: number_or_zero(df, c)
    has = lambda c: _share(present(df, c))
    yes = lambda c: _share(truthy(df, c))
    any_channel = _share(any_of([present(df, c) for c in v.CHANNEL_COLUMNS]))
    basic = (
        0.30 * any_channel + 0.25 * has("首触意向车型") + 0.20 * has("所在城市")
        + 0.15 * has("预算区间") + 0.10 * has("线索类型")
    )
    profile = (
        0.30 * has("客户性别")
        + 0.35 * clip_ratio(num("历史到店次数") + num("历史试驾次数"), 2)
        + 0.35 * clip_ratio(num("历史订单次数"), 1)
    )
    behavior = (
        0.15 * clip_ratio(num("通话次数"), 4) + 0.20 * clip_ratio(num("通话总时长"), 900)
        + 0.15 * clip_ratio(num("平均通话时长_派生"), 300) + 0.15 * yes("是否接通")
        + 0.15 * yes("有效通话") + 0.20 * clip_ratio(num("跟进总次数") + num("接通次数"), 5)
    )
    response = F.least(F.greatest(1.0 - num("首触响应时长_小时") / 72.0, F.lit(0.0)), F.lit(1.0))
    timing = (
        0.45 * response + 0.25 * yes("首触线索是否及时外呼") + 0.15 * yes("响应及时性")
        + 0.15 * yes("首触线索当天是否联通实体卡外呼")
    )
    intent_fields = v.SCORECARD["意图特征"][1]
    intent = clip_ratio(add_all([yes(c) for c in intent_fields]), len(intent_fields))
    raw = {"基础特征": basic, "画像特征": profile, "行为特征": behavior, "时序特征": timing, "意图特征": intent}
    return {name: half_even(value * 100, 4) for name, value in raw.items()}


def field_coverage(df: DataFrame) -> Column:
    fields = [f for _, names in v.SCORECARD.values() for f in names]
    return half_even(add_all([_share(present(df, f)) for f in fields]) / len(fields), 4)


def label_of(total: Column) -> Column:
    return F.when(total >= H_FROM, "H").when(total >= A_FROM, "A").otherwise("B")


def add_scorecard(df: DataFrame, label: str = v.PREDICTED) -> DataFrame:
    scores = {f"{name}得分": value for name, value in dimension_scores(df).items()}
    total = half_even(add_all([F.col(f"{n}得分") * w for n, (w, _) in v.SCORECARD.items()]), 4)
    return (
        df.withColumns({**scores, "字段覆盖率": field_coverage(df)})
        .withColumn("总分", total)
        .withColumn(label, label_of(F.col("总分")))
    )


def score_probabilities(total: Column) -> dict[str, Column]:
    """Total score -> normalised H/A/B shares."""
    unit = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    s = F.least(F.greatest(total.cast("double"), F.lit(0.0)), F.lit(100.0))
    h = unit((s - 60.0) / 40.0)
    a = unit(1.0 - F.abs(s - 67.5) / 22.5) + 0.05
    b = unit((75.0 - s) / 35.0)
    both = h + a + b
    return {"p_H": h / both, "p_A": a / both, "p_B": b / both}
