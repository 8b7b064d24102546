"""Row predicates: ordered, driven, invalid. Absent columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import any_of, contains_any, named, number, sure


def _has_words(df: DataFrame, column: str, words: list[str]) -> list[Column]:
    if column not in df.columns:
        return []
    return [contains_any(named(column).cast("string"), words)]


def is_ordered(df: DataFrame) -> Column:
    tests = [named(c).isNotNull() for c in v.ORDER_EVIDENCE_COLUMNS if c in df.columns]
    tests += [number(df, c) == 1 for c in v.ORDER_FLAG_COLUMNS if c in df.columns]
    tests += _has_words(df, "下定状态", v.BOOKING_STATUS_WORDS)
    tests += _has_words(df, "订单状态", v.ORDER_STATUS_WORDS)
    tests += _has_words(df, "意向金支付状态", v.PAID_WORDS)
    return any_of([sure(t) for t in tests])


def is_driven(df: DataFrame) -> Column:
    tests = [named(v.DRIVEN).isNotNull()] if v.DRIVEN in df.columns else []
    tests += _has_words(df, "试驾状态", v.DRIVEN_WORDS)
    return any_of([sure(t) for t in tests])


def _bad_phone(df: DataFrame, column: str) -> Column:
    phone = F.trim(named(column).cast("string"))
    return phone.isNull() | (F.length(phone) < 11) | (phone == v.EMPTY_PHONE)


def is_invalid(df: DataFrame) -> Column:
    tests = [_bad_phone(df, c) for c in v.PHONE_COLUMNS if c in df.columns]
    tests += _has_words(df, "战败原因", v.DEFEAT_WORDS)
    if v.RATING_RESULT in df.columns:
        tests.append(F.upper(named(v.RATING_RESULT).cast("string")).isin(v.INVALID_RATINGS))
    tests += _has_words(df, "客户状态", v.INVALID_CUSTOMER_WORDS)
    if "已购买竞品" in df.columns:
        tests.append(named("已购买竞品").cast("string").isin("1", "1.0", "是", "true"))
    tests += _has_words(df, "线索类型", v.INVALID_TYPE_WORDS)
    return any_of([sure(t) for t in tests])
