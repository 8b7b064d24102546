"""Behaviour log: features per phone and the join to leads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.cells import any_of, named

NULL_KEY_SPREAD = 4096


def behavior_features(
    log: DataFrame,
    phone: str = v.BEHAVIOR_PHONE,
    time: str = v.BEHAVIOR_TIME,
    event: str = v.BEHAVIOR_EVENT,
    drive_words: list[str] | None = None,
    order_words: list[str] | None = None,
) -> DataFrame:
    """Five features per phone.

    The first grouping is by (phone, event): it shrinks the log before the shuffle, and the
    distinct count becomes a plain count, so a phone with very many rows costs no more.
    """
    name = named(event)
    has = lambda words: any_of([name.contains(w) for w in words])
    count, latest, drives, orders, kinds = v.BEHAVIOR_FEATURES
    per_event = log.groupBy(named(phone).cast("string").alias(phone), name.alias(event)).agg(
        F.count("*").alias("n"), F.max(named(time)).alias("latest")
    )
    when = lambda words: F.sum(
        F.when(has(words), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    )
    return per_event.groupBy(phone).agg(
        F.sum("n").alias(count),
        F.max("latest").alias(latest),
        when(drive_words or v.DRIVE_EVENT_WORDS).alias(drives),
        when(order_words or v.ORDER_EVENT_WORDS).alias(orders),
        F.count(name).alias(kinds),
    )


def find_phone_column(columns: list[str], default: str = "手机号（脱敏）") -> str:
    """First column whose name speaks of a phone."""
    return next((c for c in columns if "手机" in c or "phone" in c.lower()), default)


def spread_key(key: Column, spread_by: Column) -> Column:
    """Text join key in which missing keys are scattered instead of meeting in one partition."""
    scattered = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEY_SPREAD)).cast("string"))
    return F.coalesce(key.cast("string"), scattered)


def join_behavior(
    leads: DataFrame, features: DataFrame, phone: str | None = None, log_phone: str = v.BEHAVIOR_PHONE,
    lead_id: str | None = None,
) -> DataFrame:
    """Left join on the phone as text; leads without a phone keep NULL features."""
    phone = phone or find_phone_column(leads.columns)
    lead_id = lead_id or (v.LEAD_ID if v.LEAD_ID in leads.columns else None)
    # The id alone keeps unread columns out of the scan.
    spread_by = named(lead_id) if lead_id else F.struct("*")
    left = leads.withColumn("__key", spread_key(named(phone), spread_by))
    right = features.where(named(log_phone).isNotNull()).withColumnRenamed(log_phone, "__key")
    return left.join(right, "__key", "left").drop("__key")


def merge_leads(leads: DataFrame, log: DataFrame, phone: str | None = None, **names: str) -> DataFrame:
    log_phone = names.get("phone", v.BEHAVIOR_PHONE)
    return join_behavior(leads, behavior_features(log, **names), phone, log_phone)


def match_statistics(merged: DataFrame, feature: str = v.BEHAVIOR_FEATURES[0]) -> DataFrame:
    stats = merged.agg(F.count("*").alias("total"), F.count(named(feature)).alias("matched"))
    return stats.withColumn("match_rate", F.coalesce(F.try_divide(F.col("matched"), F.col("total")), F.lit(0.0)))


def union_parts(parts: dict[str, DataFrame], first: int | None = None) -> DataFrame:
    """UNION ALL of the data parts of one source. Parts whose name holds "query" are skipped;
    ``first`` keeps that many data parts only, as exported workbooks with summary parts need."""
    names = [n for n in parts if "query" not in n.lower()]
    names = names[:first] if first else names
    if not names:
        raise ValueError("no data part to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [parts[n] for n in names])
