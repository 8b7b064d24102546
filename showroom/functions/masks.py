"""Masking expressions for personal data and trade names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from showroom import vocab as v


def mask_phone_cell(value: Column) -> Column:
    """An 11-character value keeps its first 3 and last 4 characters."""
    text = value.cast("string")
    return F.when(
        F.length(text) == 11, F.concat(F.substring(text, 1, 3), F.lit("****"), F.right(text, F.lit(4)))
    ).otherwise(text)


def mask_phones_in_text(text: Column) -> Column:
    return F.regexp_replace(text, v.PHONE_PARTS_PATTERN, "$1****$3")


def hide_phones_in_text(text: Column) -> Column:
    return F.regexp_replace(text, v.PHONE_PATTERN, v.PHONE_FULL_MASK)


def mask_id(value: Column, null_as_mask: bool = False) -> Column:
    """Keeps the first and last 2 characters; short values become ``****``."""
    length = F.length(value)
    masked = F.when(length <= 4, F.lit("****")).otherwise(
        F.concat(F.left(value, F.lit(2)), F.repeat(F.lit("*"), length - 4), F.right(value, F.lit(2)))
    )
    return F.coalesce(masked, F.lit("****")) if null_as_mask else masked


def mask_dealer(value: Column) -> Column:
    return F.when(F.length(value) <= 4, F.lit("****")).otherwise(
        F.concat(F.left(value, F.lit(2)), F.lit("****"), F.right(value, F.lit(2)))
    )


def mask_id_card_cell(value: Column) -> Column:
    text = value.cast("string")
    return F.when(
        F.length(text) >= 15,
        F.concat(F.left(text, F.lit(4)), F.lit("*" * 10), F.right(text, F.lit(4))),
    ).otherwise(text)


def mask_id_cards_in_text(text: Column) -> Column:
    return F.regexp_replace(text, v.ID_CARD_PATTERN, "$1********$2")


def hide_plates(text: Column) -> Column:
    return F.regexp_replace(text, v.PLATE_PATTERN, v.PLATE_MASK)


def replace_words(text: Column, codes: dict[str, str]) -> Column:
    """Replace keywords by their codes, the longest keyword first."""
    for word in sorted(codes, key=len, reverse=True):
        text = F.replace(text, F.lit(word), F.lit(codes[word]))
    return text


def replace_brands(text: Column, codes: dict[str, str] | None = None) -> Column:
    return replace_words(text, v.BRAND_CODES if codes is None else codes)


def replace_cars(text: Column, codes: dict[str, str] | None = None) -> Column:
    return replace_words(text, v.CAR_CODES if codes is None else codes)
