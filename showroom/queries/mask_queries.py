"""De-identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import masks
from showroom.operators import deidentify as di
from showroom.plans.lead_view import LEADS_SQL, base, leads, table
from showroom.queries.registry import lead_id, query, tidy

BRAND_SQL = "text"
for _word in sorted(v.BRAND_CODES, key=len, reverse=True):
    BRAND_SQL = f"replace({BRAND_SQL}, '{_word}', '{v.BRAND_CODES[_word]}')"
CAR_SQL = "text"
for _word in sorted(v.CAR_CODES, key=len, reverse=True):
    CAR_SQL = f"replace({CAR_SQL}, '{_word}', '{v.CAR_CODES[_word]}')"


@query("d1_phone_cells", LEADS_SQL + """
SELECT id, CASE WHEN length(phone) = 11 THEN left(phone, 3) || '****' || right(phone, 4) ELSE phone END AS phone,
       CASE WHEN length(CAST(n AS VARCHAR)) = 11 THEN left(CAST(n AS VARCHAR), 3) || '****' || right(CAST(n AS VARCHAR), 4)
            ELSE CAST(n AS VARCHAR) END AS number
FROM (SELECT id, phone, CASE WHEN id % 2 = 0 THEN CAST(phone AS BIGINT) ELSE id END AS n FROM leads)""")
def phone_cells(spark, folder):
    k = F.col(v.LEAD_ID)
    n = F.when(k % 2 == 0, F.col(v.PHONE).cast("bigint")).otherwise(k)
    return tidy(base(spark, folder).select(lead_id(), masks.mask_phone_cell(F.col(v.PHONE)).alias("phone"), masks.mask_phone_cell(n).alias("number")))


def memo(spark, folder, *extra):
    """Document texts with personal data and trade names appended."""
    k = F.col("doc_id")
    tail = F.concat(
        F.lit(" 客户13"), F.lpad((k * 7919 % 1000000000).cast("string"), 9, "0"), F.lit(" 证 110101199003"),
        F.lpad((k % 1000000).cast("string"), 6, "0"), F.lit("X 车牌粤B"), F.lpad((k % 100000).cast("string"), 5, "1"),
        F.lit(" 广汽丰田与广汽本地 铂智3X铂智C-HR"))
    return table(spark, folder, "documents").select("doc_id", F.concat("text", tail).alias("text"), *extra)


MEMO_SQL = """
WITH memo AS (SELECT doc_id, text || ' 客户13' || lpad(CAST(doc_id * 7919 % 1000000000 AS VARCHAR), 9, '0') || ' 证 110101199003'
  || lpad(CAST(doc_id % 1000000 AS VARCHAR), 6, '0') || 'X 车牌粤B' || lpad(CAST(doc_id % 100000 AS VARCHAR), 5, '1')
  || ' 广汽丰田与广汽本地 铂智3X铂智C-HR' AS text FROM documents)
"""


@query("d2_phones_in_text", MEMO_SQL + r"SELECT doc_id, regexp_replace(text, '(1[3-9][0-9])([0-9]{4})([0-9]{4})', '\1****\3', 'g') AS text FROM memo")
def phones_in_text(spark, folder):
    return memo(spark, folder).withColumn("text", masks.mask_phones_in_text(F.col("text")))


@query("d3_phones_hidden", MEMO_SQL + "SELECT doc_id, regexp_replace(text, '1[3-9][0-9]{9}', '手机***********', 'g') AS text FROM memo")
def phones_hidden(spark, folder):
    return memo(spark, folder).withColumn("text", masks.hide_phones_in_text(F.col("text")))


@query("d4_id_mask", """
SELECT doc_id, CASE WHEN length(s) <= 4 THEN '****' ELSE left(s, 2) || repeat('*', length(s) - 4) || right(s, 2) END AS masked
FROM (SELECT doc_id, source || CAST(doc_id AS VARCHAR) AS s FROM documents)""")
def id_mask(spark, folder):
    return table(spark, folder, "documents").select("doc_id", masks.mask_id(F.concat("source", F.col("doc_id").cast("string"))).alias("masked"))


@query("d5_dealer_mask", """
SELECT s_suppkey, CASE WHEN length(s_name) <= 4 THEN '****' ELSE left(s_name, 2) || '****' || right(s_name, 2) END AS masked FROM supplier""")
def dealer_mask(spark, folder):
    return table(spark, folder, "supplier").select("s_suppkey", masks.mask_dealer(F.col("s_name")).alias("masked"))


@query("d6_id_card_cells", LEADS_SQL + """
SELECT id, CASE WHEN length(c) >= 15 THEN left(c, 4) || '**********' || right(c, 4) ELSE c END AS masked
FROM (SELECT id, CASE WHEN id % 3 = 0 THEN phone ELSE phone || right(phone, 7) END AS c FROM leads)""")
def id_card_cells(spark, folder):
    card = F.when(F.col(v.LEAD_ID) % 3 == 0, F.col(v.PHONE)).otherwise(F.concat(v.PHONE, F.right(v.PHONE, F.lit(7))))
    return base(spark, folder).select(lead_id(), masks.mask_id_card_cell(card).alias("masked"))


@query("d7_id_cards_in_text", MEMO_SQL + r"""
SELECT doc_id, regexp_replace(text, '(\d{6})(\d{5}[\dXx]{0,3}|\d{5})([\dXx]{4})', '\1********\3', 'g') AS text FROM memo""")
def id_cards_in_text(spark, folder):
    return memo(spark, folder).withColumn("text", masks.mask_id_cards_in_text(F.col("text")))


@query("d8_plates", MEMO_SQL + f"SELECT doc_id, regexp_replace(text, '{v.PLATE_PATTERN}', '车牌***', 'g') AS text FROM memo")
def plates(spark, folder):
    return memo(spark, folder).withColumn("text", masks.hide_plates(F.col("text")))


@query("d9_brands", MEMO_SQL + f"SELECT doc_id, {BRAND_SQL} AS text FROM memo")
def brands(spark, folder):
    return memo(spark, folder).withColumn("text", masks.replace_brands(F.col("text")))


@query("d10_cars", MEMO_SQL + f"SELECT doc_id, {CAR_SQL} AS text FROM memo")
def cars(spark, folder):
    return memo(spark, folder).withColumn("text", masks.replace_cars(F.col("text")))


LETTER_SQL = "CASE WHEN i < 26 THEN chr(CAST(65 + i AS INTEGER)) ELSE chr(CAST(64 + i // 26 AS INTEGER)) || chr(CAST(65 + i % 26 AS INTEGER)) END"


@query("d11_pseudonyms", LEADS_SQL + f""", codes AS (
SELECT value, '城市' || {LETTER_SQL} AS code FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i
  FROM (SELECT city AS value FROM leads WHERE city IS NOT NULL UNION SELECT car FROM leads WHERE car IS NOT NULL)))
SELECT id, a.code AS city, b.code AS car FROM leads LEFT JOIN codes a ON a.value = city LEFT JOIN codes b ON b.value = car""")
def pseudonyms(spark, folder):
    df = leads(spark, folder, "place", "car")
    codes = di.pseudonyms(df, [v.CITY, v.CAR], v.CITY_PREFIX)
    return di.apply_pseudonyms(df, [v.CITY, v.CAR], codes).select(lead_id(), F.col(v.CITY).alias("city"), F.col(v.CAR).alias("car"))


def sensitive(spark, folder):
    """Leads with a memo column, a customer id and a dealer code."""
    k = F.col(v.LEAD_ID)
    return leads(spark, folder, "place").select(
        k, v.PHONE, v.CITY, "一级渠道名称",
        F.concat(F.lit("CUST"), k.cast("string")).alias("客户ID"),
        F.concat(F.lit("D"), k.cast("string")).alias("经销店代码"),
        F.concat(F.lit("广汽丰田 "), v.PHONE, F.lit(" 粤B12345 雷凌")).alias("非首触跟进记录"))


@query("d12_deidentified_table", LEADS_SQL + """
SELECT id, left(phone, 3) || '****' || right(phone, 4) AS phone, channel1 AS channel,
       'CU' || repeat('*', length(CAST(id AS VARCHAR))) || right('CUST' || id, 2) AS customer,
       '品牌A ' || left(phone, 3) || '****' || right(phone, 4) || ' 粤B12345 车型C' AS memo, CAST(5 AS BIGINT) AS touched
FROM leads""")
def deidentified_table(spark, folder):
    out, touched = di.deidentify(sensitive(spark, folder))
    return tidy(out.select(
        lead_id(), F.col(v.PHONE).alias("phone"), F.col("一级渠道名称").alias("channel"), F.col("客户ID").alias("customer"),
        F.col("非首触跟进记录").alias("memo"), F.lit(len(touched)).alias("touched")))


@query("d12_order_stage_table", LEADS_SQL + f""", codes AS (
SELECT value, '城市' || {LETTER_SQL} AS code FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i
  FROM (SELECT DISTINCT city AS value FROM leads WHERE city IS NOT NULL)))
SELECT id, phone, code AS city, CASE WHEN length('D' || id) <= 4 THEN '****' ELSE left('D' || id, 2) || '****' || right('D' || id, 2) END AS dealer,
       '品牌A 手机*********** 车牌*** 车型C' AS memo FROM leads LEFT JOIN codes ON value = city""")
def order_stage_table(spark, folder):
    out, _ = di.deidentify_order_stage(sensitive(spark, folder))
    return tidy(out.select(
        lead_id(), F.col(v.PHONE).alias("phone"), F.col(v.CITY).alias("city"), F.col("经销店代码").alias("dealer"), F.col("非首触跟进记录").alias("memo")))
