"""Column-driven de-identification of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab as v
from showroom.functions import masks
from showroom.functions.cells import is_text, named
from showroom.operators.ordering import global_rank
from showroom.session import stored_lookup


def _names(column: str, words: list[str]) -> bool:
    return any(w in column for w in words)


def _is_phone(column: str) -> bool:
    return _names(column.lower(), v.PHONE_NAME_WORDS)


def _text_steps(column: str, brands: dict | None, cars: dict | None):
    """Masking steps of a text column. Whole-cell masks come first; ID cards are masked before
    phones so that a phone-like run inside an ID number is not cut out of it."""
    if column == v.ID_MASK_NAME_WORD or v.ID_MASK_NAME_WORD in column:
        yield masks.mask_id
    if _is_phone(column):
        yield masks.mask_phone_cell
    if _names(column, v.ID_CARD_NAME_WORDS):
        yield masks.mask_id_card_cell
    if _names(column, v.PHONE_TEXT_NAME_WORDS):
        yield masks.mask_id_cards_in_text
        yield masks.mask_phones_in_text
    if column in v.CAR_COLUMNS or _names(column, v.CAR_NAME_WORDS) or "json" in column.lower():
        yield lambda c: masks.replace_cars(c, cars)
    if column in v.BRAND_COLUMNS or _names(column, v.BRAND_NAME_WORDS):
        yield lambda c: masks.replace_brands(c, brands)


def masking_plan(
    df: DataFrame, brands: dict | None = None, cars: dict | None = None
) -> dict[str, Column]:
    """Column -> masked expression, only for the columns that need one."""
    plan = {}
    for f in df.schema:
        value = named(f.name)
        if isinstance(f.dataType, T.StringType):
            steps = list(_text_steps(f.name, brands, cars))
            for step in steps:
                value = step(value)
            if steps:
                plan[f.name] = value
        elif isinstance(f.dataType, T.IntegralType) and _is_phone(f.name):
            plan[f.name] = masks.mask_phone_cell(value)
    return plan


def deidentify(
    df: DataFrame, brands: dict | None = None, cars: dict | None = None
) -> tuple[DataFrame, list[str]]:
    """General plan: brands, cars, ids, phones, ID cards. Returns the touched columns too."""
    plan = masking_plan(df, brands, cars)
    return (df.withColumns(plan) if plan else df), list(plan)


def _letters(index: Column) -> Column:
    """0 -> A, 25 -> Z, 26 -> AA, 701 -> ZZ, 702 -> AAA."""
    letter = lambda n: F.chr(F.lit(65) + n)
    one = letter(index)
    i2 = index - 26
    two = F.concat(letter(F.floor(i2 / 26)), letter(i2 % 26))
    i3 = i2 - 26 * 26
    three = F.concat(letter(F.floor(i3 / 676)), letter(F.floor(i3 / 26) % 26), letter(i3 % 26))
    i4 = i3 - 26**3
    four = F.concat(F.lit("Z"), i4.cast("string"))
    return F.when(index < 26, one).when(i2 < 676, two).when(i3 < 26**3, three).otherwise(four)


def pseudonyms(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    """Code table (value, code) over the distinct non-null values of the columns, by sorted value."""
    values = None
    for c in columns:
        part = df.select(named(c).alias("value")).where(F.col("value").isNotNull() & (F.col("value") != ""))
        values = part if values is None else values.unionByName(part)
    ranked = global_rank(values.distinct(), [F.col("value").asc()], name="position")
    return ranked.select("value", F.concat(F.lit(prefix), _letters(F.col("position") - 1)).alias("code"))


def apply_pseudonyms(df: DataFrame, columns: list[str], codes: DataFrame) -> DataFrame:
    """Replace every listed column by its code."""
    order = df.columns
    codes = stored_lookup(codes)
    for c in columns:
        table = codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        df = df.join(table, named(c) == F.col("__value"), "left")
        df = df.withColumn(c, F.coalesce(F.col("__code"), named(c))).drop("__value", "__code")
    return df.select(*[named(c) for c in order])


def deidentify_order_stage(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Order-stage plan: listed brand and car columns, city and province pseudonyms, dealer codes,
    plates and phones inside follow-up text."""
    plan = {}
    for c in [c for c in df.columns if is_text(df, c)]:
        value, steps = named(c), 0
        if c in v.DEALER_COLUMNS:
            value, steps = masks.mask_dealer(value), steps + 1
        if c in v.BRAND_COLUMNS:
            value, steps = masks.replace_brands(value), steps + 1
        if c in v.CAR_COLUMNS:
            value, steps = masks.replace_cars(value), steps + 1
        if "跟进" in c or "记录" in c or "json" in c.lower():
            value, steps = masks.hide_phones_in_text(masks.hide_plates(value)), steps + 1
        if steps:
            plan[c] = value
    out = df.withColumns(plan) if plan else df
    touched = list(plan)
    for columns, prefix in ((v.CITY_COLUMNS, v.CITY_PREFIX), (v.PROVINCE_COLUMNS, v.PROVINCE_PREFIX)):
        found = [c for c in columns if c in df.columns and is_text(df, c)]
        if found:
            out = apply_pseudonyms(out, found, pseudonyms(df, found, prefix))
            touched += found
    return out, touched
