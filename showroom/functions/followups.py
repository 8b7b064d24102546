"""Thirteen features of the follow-up records held as JSON text in one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab as v
from showroom.functions.cells import contains_any, lookup, named, sure

RECORD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (v.LEVEL_FIELD, v.CALL_FIELD, v.RESULT_FIELD, v.DURATION_FIELD, v.MEMO_FIELD)
    ]
)
FEATURES = [
    "跟进总次数", "接通次数", "未接通次数", "接通率", "继续跟进次数", "最终战败", "意向级别下降",
    "提及价格", "提及试驾", "提及到店", "提及竞品", "平均通话时长_秒", "最长通话时长_秒",
]


def usable_records(parsed: Column, text: Column) -> Column:
    """Array of records from parsed JSON. A lone object is one record; an empty object, bad text,
    a blank cell and a list holding a non-object give an empty array."""
    broken = F.exists(parsed, lambda r: r.isNull())
    empty_object = text.rlike(r"^\s*\{\s*\}\s*$")
    nothing = F.array().cast(T.ArrayType(RECORD))
    return F.when(parsed.isNull() | empty_object | sure(broken), nothing).otherwise(parsed)


def with_records(df: DataFrame, column: str, name: str) -> DataFrame:
    """Append the records of a text column. The parsed value is a column of its own, because it is
    read more than once and parsing is the costly part."""
    text = named(column).cast("string")
    parsed = df.withColumn("__parsed", F.from_json(text, T.ArrayType(RECORD)))
    return parsed.withColumn(name, usable_records(F.col("__parsed"), text)).drop("__parsed")


def _filled(records: Column, field: str) -> Column:
    """Non-empty values of one field, in record order."""
    values = F.transform(records, lambda r: r.getField(field))
    return F.filter(values, lambda x: x.isNotNull() & (x != ""))


def _count_equal(values: Column, wanted: str) -> Column:
    return F.size(F.filter(values, lambda x: x == F.lit(wanted)))


def _call_seconds(records: Column) -> Column:
    """Seconds of every ``m:s`` entry with exactly two integer parts."""

    def seconds(text: Column) -> Column:
        parts = F.split(text, ":", -1)
        minute = F.trim(F.get(parts, F.lit(0))).try_cast("bigint")
        second = F.trim(F.get(parts, F.lit(1))).try_cast("bigint")
        return F.when(F.size(parts) == 2, minute * 60 + second)

    return F.filter(
        F.transform(_filled(records, v.DURATION_FIELD), seconds), lambda s: s.isNotNull()
    )


def followup_columns(records: Column) -> dict[str, Column]:
    """Feature name -> column, for an array of records."""
    levels = _filled(records, v.LEVEL_FIELD)
    calls = _filled(records, v.CALL_FIELD)
    results = _filled(records, v.RESULT_FIELD)
    seconds = _call_seconds(records)
    memo = F.array_join(_filled(records, v.MEMO_FIELD), " ")

    first = lookup(v.LEVEL_RANK, F.try_element_at(levels, F.lit(1)))
    last = lookup(v.LEVEL_RANK, F.try_element_at(levels, F.lit(-1)))
    connected = _count_equal(calls, v.CONNECTED)
    total_seconds = F.aggregate(seconds, F.lit(0).cast("bigint"), lambda a, s: a + s)
    mean_seconds = F.bround(F.try_divide(total_seconds, F.size(seconds)), 2)
    return {
        "跟进总次数": F.size(records),
        "接通次数": connected,
        "未接通次数": _count_equal(calls, v.NOT_CONNECTED),
        "接通率": F.coalesce(F.try_divide(connected, F.size(calls)), F.lit(0.0)),
        "继续跟进次数": _count_equal(results, v.CONTINUED),
        "最终战败": F.array_contains(results, v.DEFEATED),
        "意向级别下降": sure(last < first),
        "提及价格": contains_any(memo, v.PRICE_WORDS),
        "提及试驾": memo.contains(v.DRIVE_WORD),
        "提及到店": contains_any(memo, v.STORE_WORDS),
        "提及竞品": contains_any(memo, v.COMPETITOR_WORDS),
        "平均通话时长_秒": F.coalesce(mean_seconds, F.lit(0.0)),
        "最长通话时长_秒": F.coalesce(F.array_max(seconds), F.lit(0).cast("bigint")),
    }


def collision_safe_names(existing: list[str], new: list[str]) -> dict[str, str]:
    """New name -> name to use. A taken name gets ``_json``; if that is taken too, it is left out."""
    chosen = {}
    for name in new:
        if name not in existing:
            chosen[name] = name
        elif f"{name}_json" not in existing:
            chosen[name] = f"{name}_json"
    return chosen


def add_followup_features(
    df: DataFrame, column: str = v.FOLLOWUPS, drop_source: bool = False
) -> DataFrame:
    """Parse the column once and append the features under collision-safe names."""
    if column not in df.columns:
        return df
    names = collision_safe_names(df.columns, FEATURES)
    parsed = "__records"
    features = followup_columns(F.col(parsed))
    out = with_records(df, column, parsed)
    out = out.withColumns({names[f]: c for f, c in features.items() if f in names}).drop(parsed)
    return out.drop(column) if drop_source else out
