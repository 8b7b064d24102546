"""Model features: time parts, numbers, interactions, and the fitted city-by-car heat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.session import stored_lookup
from showroom.functions.cells import (
    add_all, any_of, as_time, flag, hours_between, is_blank, is_text, is_time, named, number, sure,
)

EFFECTIVE_CALL_SECONDS = 60


def time_parts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Weekday (Monday = 0), hour and weekend flag of every time column."""
    new = {}
    for c in columns or v.TIME_COLUMNS:
        if c in df.columns:
            t = as_time(df, c) if (is_text(df, c) or is_time(df, c)) else F.lit(None).cast("timestamp")
            new |= {
                f"{c}_day_of_week": F.weekday(t),
                f"{c}_hour": F.hour(t),
                f"{c}_is_weekend": flag(F.weekday(t).isin(5, 6)),
            }
    return df.withColumns(new) if new else df


def numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Listed columns as numbers; text that is not a number becomes NULL."""
    new = {c: number(df, c) for c in columns or v.NUMERIC_COLUMNS if c in df.columns and is_text(df, c)}
    return df.withColumns(new) if new else df


def response_band(hours: Column) -> Column:
    """Right-closed bands of the response hours. Missing hours count as -1, which lies outside
    every band; outside rows carry the text ``nan``."""
    h = F.coalesce(hours, F.lit(-1.0))
    band = F.when(h <= -1, v.RESPONSE_OUTSIDE)
    for edge, name in v.RESPONSE_BANDS:
        band = band.when(h <= edge, name)
    return band.otherwise(v.RESPONSE_LAST_BAND)


def _or_unknown(name: str) -> Column:
    return F.coalesce(named(name).cast("string"), F.lit(v.UNKNOWN))


def fit_heat(df: DataFrame, city: str = v.CITY, car: str = v.CAR) -> DataFrame:
    """Training rows per (city, car)."""
    return df.groupBy(_or_unknown(city).alias("heat_city"), _or_unknown(car).alias("heat_car")).agg(
        F.count("*").alias("heat"))


def add_heat(df: DataFrame, heat: DataFrame, city: str = v.CITY, car: str = v.CAR, name: str = "城市车型热度") -> DataFrame:
    """Fitted heat of the row's pair, 0 for a pair not seen."""
    table = heat.select(F.col("heat_city").alias("__city"), F.col("heat_car").alias("__car"), F.col("heat").alias("__heat"))
    joined = df.join(
        table, (_or_unknown(city) == F.col("__city")) & (_or_unknown(car) == F.col("__car")), "left")
    return joined.withColumn(name, F.coalesce(F.col("__heat"), F.lit(0))).drop("__city", "__car", "__heat")


def interaction_columns(df: DataFrame) -> dict[str, Column]:
    """All interactions of one row; each is made only if its inputs exist."""
    has = lambda *names: all(n in df.columns for n in names)
    new: dict[str, Column] = {}
    if has(v.FIRST_TOUCH, v.CREATED):
        hours = hours_between(as_time(df, v.CREATED), as_time(df, v.FIRST_TOUCH))
        new |= {"首触响应时长_小时": hours, "响应及时性": response_band(hours)}
    if has("一级渠道名称", "二级渠道名称"):
        new["渠道组合"] = F.concat_ws("_", _or_unknown("一级渠道名称"), _or_unknown("二级渠道名称"))
    if has("通话次数", "通话总时长"):
        calls, seconds = number(df, "通话次数"), number(df, "通话总时长")
        new["平均通话时长_派生"] = F.coalesce(F.try_divide(seconds, calls), F.lit(0.0))
        new["有效通话"] = flag((calls > 0) & (seconds > EFFECTIVE_CALL_SECONDS))
    semantic = [c for c in v.SEMANTIC_COLUMNS if c in df.columns]
    if semantic:
        filled = [named(c).isNotNull() & (named(c).cast("string") != "") for c in semantic]
        new["AI语义标签可用"] = flag(any_of([sure(f) for f in filled]))
        new["语义标签命中数"] = add_all([flag(F.trim(named(c).cast("string")) == "是") for c in semantic])
    detail = next((c for c in (v.FOLLOWUPS, v.FOLLOWUPS_TECHNICAL) if c in df.columns), None)
    if detail:
        new["JSON跟进明细可用"] = flag(~is_blank(df, detail) & (F.trim(named(detail).cast("string")) != "{}"))
    return new


def transform(df: DataFrame, heat: DataFrame | None = None, time_columns: list[str] | None = None,
              numeric_columns: list[str] | None = None, interactions: bool = True) -> DataFrame:
    """Features of a table. Give the heat fitted on the training part; without it the table's own
    counts are used, as a first fit does."""
    out = numbers(time_parts(df, time_columns), numeric_columns)
    if not interactions:
        return out
    new = interaction_columns(out)
    out = out.withColumns(new) if new else out
    if v.CITY in df.columns and v.CAR in df.columns:
        out = add_heat(out, heat if heat is not None else stored_lookup(fit_heat(df)))
    return out


def fit_transform(df: DataFrame, **options) -> tuple[DataFrame, DataFrame | None]:
    heat = stored_lookup(fit_heat(df)) if v.CITY in df.columns and v.CAR in df.columns else None
    return transform(df, heat, **options), heat
