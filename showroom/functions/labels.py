"""Time-window labels. Three definitions exist on purpose and are kept apart:

* ``window_labels``: fractional days, negative days count as 0;
* ``drive_date_labels``: whole dates, no lower bound;
* ``order_date_labels``: whole dates, negative days count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import as_time, days_between, flag, is_text, named

ARRIVE_WINDOWS = (7, 14, 30)
DRIVE_WINDOWS = (7, 14, 21, 30)
ORDER_WINDOWS = (7, 14, 21)


def within(days: Column, limit: int) -> Column:
    return flag(days.between(0, limit))


def _time_or_null(df: DataFrame, name: str) -> Column:
    return as_time(df, name) if name in df.columns else F.lit(None).cast("timestamp")


def window_labels(
    df: DataFrame, created: str = v.CREATED, arrived: str = v.ARRIVED, driven: str = v.DRIVEN
) -> DataFrame:
    """Arrival and test-drive labels measured from creation."""
    start = _time_or_null(df, created)
    to_arrival = days_between(start, _time_or_null(df, arrived))
    to_drive = days_between(start, _time_or_null(df, driven))
    labels = {f"到店标签_{n}天": within(to_arrival, n) for n in ARRIVE_WINDOWS}
    labels |= {f"试驾标签_{n}天": within(to_drive, n) for n in DRIVE_WINDOWS}
    return df.withColumns(labels)


def outcome_labels(
    df: DataFrame, rating: str = v.RATING_RESULT, ordered: str = v.ORDERED
) -> DataFrame:
    """Deal flags and the rating target with its ``Unknown`` class."""
    columns = {}
    if rating in df.columns and v.RATING_BEFORE_DRIVE not in df.columns:
        columns[v.RATING_BEFORE_DRIVE] = F.coalesce(named(rating), F.lit(v.UNKNOWN_LABEL))
    deal = named(ordered).isNotNull().cast("int") if ordered in df.columns else F.lit(0)
    columns["成交标签"] = deal
    columns["is_final_ordered"] = deal
    return df.withColumns(columns)


def order_after_drive_labels(
    df: DataFrame, driven: str = v.DRIVEN, ordered: str = v.ORDERED
) -> DataFrame:
    """Order labels counted from the test drive; only driven and ordered leads can be 1."""
    if driven not in df.columns or ordered not in df.columns:
        return df
    days = days_between(as_time(df, driven), as_time(df, ordered))
    labels = {f"下订标签_{n}天": within(days, n) for n in ORDER_WINDOWS}
    return df.withColumns({**labels, "试驾后下订天数差": days})


def target_labels(df: DataFrame) -> DataFrame:
    return df.transform(window_labels).transform(outcome_labels).transform(order_after_drive_labels)


def _as_date(df: DataFrame, name: str) -> Column:
    return F.to_date(as_time(df, name)) if is_text(df, name) else F.to_date(named(name))


def drive_date_labels(
    df: DataFrame, created: str = v.CREATED, driven: str = v.DRIVEN
) -> DataFrame:
    """Whole-date drive labels and the class H/A/B/O/N; an early drive counts as H."""
    days = F.datediff(_as_date(df, driven), _as_date(df, created))
    labels = {f"label_{n}天内试驾": flag(days <= n) for n in ORDER_WINDOWS}
    grade = (
        F.when(days.isNull(), "N")
        .when(days <= 7, "H")
        .when(days <= 14, "A")
        .when(days <= 21, "B")
        .otherwise("O")
    )
    return df.withColumns({"试驾天数差": days, **labels, "label_OHAB": grade})


def order_date_labels(
    df: DataFrame, driven: str = v.DRIVEN, ordered: str = v.ORDERED
) -> DataFrame:
    """Whole-date order labels counted from the test drive, with the day difference."""
    days = F.datediff(_as_date(df, ordered), _as_date(df, driven))
    labels = {f"下订标签_{n}天": within(days, n) for n in ORDER_WINDOWS}
    return df.withColumns({"下订天数差": days, **labels})


def creation_time_features(df: DataFrame, created: str = v.CREATED) -> DataFrame:
    """Weekday (Monday = 1) and hour of creation."""
    if created not in df.columns:
        return df
    time = as_time(df, created)
    return df.withColumns({"线索创建星期几": F.weekday(time) + 1, "线索创建小时": F.hour(time)})
