"""Small column helpers shared by the other modules."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def named(name: str) -> Column:
    """Column by exact name; names with dots or brackets stay intact."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), T.StringType)


def is_number(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), T.NumericType)


def is_time(df: DataFrame, name: str) -> bool:
    return isinstance(type_of(df, name), (T.TimestampType, T.TimestampNTZType, T.DateType))


def as_time(df: DataFrame, name: str) -> Column:
    """Timestamp, or NULL where the text is not a time."""
    if is_text(df, name):
        return F.try_to_timestamp(F.trim(named(name)))
    return named(name).cast("timestamp")


def micros(time: Column) -> Column:
    return F.unix_micros(time)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_DAY))


def hours_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(float(MICROS_PER_HOUR))


def number(df: DataFrame, name: str) -> Column:
    """Double, NULL where the value is not a number."""
    if isinstance(type_of(df, name), (T.BooleanType, T.NumericType)):
        return named(name).cast("double")
    return F.expr(f"try_cast(`{name}` as double)")


def number_or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(number(df, name), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_blank(df: DataFrame, name: str) -> Column:
    if is_text(df, name):
        return named(name).isNull() | (F.trim(named(name)) == "")
    return named(name).isNull()


def truthy(df: DataFrame, name: str) -> Column:
    """Boolean; absent columns are false."""
    if name not in df.columns:
        return F.lit(False)
    if isinstance(type_of(df, name), T.BooleanType):
        return sure(named(name))
    if is_number(df, name):
        return sure(named(name) > 0)
    return sure(F.trim(named(name).cast("string")).isin(vocab.TRUTHY_WORDS))


def present(df: DataFrame, name: str) -> Column:
    """Boolean; a number is present when it is not zero, a text when it is not blank."""
    if name not in df.columns:
        return F.lit(False)
    if isinstance(type_of(df, name), T.BooleanType):
        return sure(named(name))
    if is_number(df, name):
        return sure(named(name) != 0)
    return sure(F.trim(named(name).cast("string")) != "")


def clip_ratio(value: Column, denominator: float) -> Column:
    if denominator <= 0:
        return F.lit(0.0)
    return F.least(F.greatest(value / F.lit(float(denominator)), F.lit(0.0)), F.lit(1.0))


def contains_any(text: Column, words: list[str]) -> Column:
    """NULL text stays NULL; one alternation instead of one scan per word."""
    return text.rlike("|".join("\\Q" + w + "\\E" for w in words))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def add_all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def lookup(mapping: dict, key: Column, default: Column | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, default)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct value for use in other queries."""
    return df.select(F.struct("*").alias("row")).scalar()
