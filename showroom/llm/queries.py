"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.llm import conversation_trie, decontaminate, hard_negatives, jaccard_join, language_id, line_dedup, mixing, near_dedup, quality, secrets, token_files, topk_search, url_filter
from showroom.llm.shared import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


@query("op1_benchmark_decontamination", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
i AS (
  SELECT item_id, least(10, len(ws)) AS n, unnest([array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ')
    FOR p IN range(1, len(ws) - least(10, len(ws)) + 2)]) AS win FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM i),
d AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS p,
    unnest([array_to_string(ws[q:q + n - 1], ' ') FOR q IN range(1, len(ws) - n + 2)]) AS win
  FROM w CROSS JOIN sizes WHERE len(ws) >= n),
h AS (SELECT DISTINCT doc_id, p, n, item_id FROM d JOIN i USING (n, win)),
hits AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, folder, "benchmark"))
    hit = F.col("contamination")
    return marked.select(
        "doc_id", hit.n_words.alias("n_words"), hit.n_hit.alias("n_hit"), F.size(hit["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(hit["items"])), 256).alias("items_sha256"), (hit.n_hit > 0).alias("contaminated"))


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    read = token_files.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[p:p + 4], ' ') FOR p IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar(table(spark, folder, "documents"))


@query("op7_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('0' || chr(31) || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
f AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - 3 * CAST(coalesce(sum(source_size) OVER b, 0) AS BIGINT) AS remains,
    CAST(sum(w) OVER () AS BIGINT) - CAST(coalesce(sum(w) OVER b, 0) AS BIGINT) AS weight FROM w
  WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(max(remains / weight) FILTER (remains / weight * w <= 3 * source_size), 0.0) AS level FROM f),
t AS (SELECT source, source_size, least(w * level, CAST(3 * source_size AS DOUBLE)) AS target FROM f, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS epochs FROM t),
g AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, floor(e.target) - e.epochs * e.source_size AS rest,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM g""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    found = mixing.mix(docs)
    mix = F.col("mix")
    return found.select("doc_id", *[mix[c].alias(c) for c in ("size", "source_size", "target", "taken")])


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = language_id.train(docs.where(~held_out), key=F.col("doc_id"))
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


@query("op10_secret_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs, key=F.col("doc_id")))
    of = F.col("secrets")
    return found.select(
        "doc_id", *[of[c].alias(c) for c in ("n_assign", "n_access", "n_hex", "n_markov")],
        F.sha2(of["base"], 256).alias("base_sha256"), of["spans"].alias("spans"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    judged = quality.judge(docs, table(spark, folder, "labels"))
    of = F.col("quality")
    return judged.select(
        "doc_id", of["document"].alias("document_score"), of["host"].alias("host_rate"), of["path"].alias("path_rate"),
        of["score"].alias("score"), of["kept"].alias("keep"))


@query("op2_line_dedup", r"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
c AS (
  SELECT line FROM (SELECT DISTINCT source, unnest([trim(x) FOR x IN ls]) AS line FROM d WHERE source IS NOT NULL)
  WHERE line <> '' GROUP BY line HAVING count(*) >= 10),
k AS (SELECT list(line) AS cs FROM c),
r AS (SELECT doc_id, ls, [x FOR x IN ls IF NOT coalesce(list_contains(cs, trim(x)), false)] AS kept FROM d, k)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(ls) - len(kept), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256 FROM r""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    clean = line_dedup.without_boilerplate(docs)
    of = F.col("lines")
    return clean.select("doc_id", of["n_lines"].alias("n_lines"), of["n_removed"].alias("n_removed"), F.sha2(F.coalesce(of["text"], F.lit("")), 256).alias("text_sha256"))


#: The rules of the query, as given.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/")]


@query("op3_url_filter")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, URL_RULES)
    return judged.select("page_id", *[F.col("url_verdict")[c].alias(c) for c in ("host", "path", "rule", "verdict")])


@query("op6_exact_topk_search", r"""
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op11_conversation_trie", r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, role || chr(0) || text AS said, length(text) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT c, c - c % 100 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM t)),
own AS (
  SELECT c.c, 0 AS part, t.i, said, chars FROM c JOIN t ON t.c = c.b AND t.i <= c.h
  UNION ALL SELECT c.c, 1, t.i, said, chars FROM c JOIN t ON t.c = c.c AND t.i > c.h),
s AS (SELECT c, list(md5(said) ORDER BY part, i) AS ds, list(chars ORDER BY part, i) AS ls FROM own GROUP BY c),
r AS (SELECT c.c, coalesce(ds, []) AS ds, coalesce(ls, []) AS ls FROM c LEFT JOIN s ON s.c = c.c),
m AS (SELECT c, d, ds[1:d] AS p, CASE WHEN d > 0 THEN ls[d] ELSE 0 END AS chars, len(ds) = d AS ends FROM (SELECT *, unnest(range(0, len(ds) + 1)) AS d FROM r)),
n AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
a AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON n.p = k.p),
u AS (
  SELECT q AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT n_children, n_convs, chars, unnest([p[1:e] FOR e IN range(0, d + 1)]) AS q FROM a) GROUP BY q)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, f.conv_id AS parent_conv_id, CAST(a.n_convs AS BIGINT) AS n_convs, CAST(a.n_children AS BIGINT) AS n_children,
  CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM a JOIN u ON u.p = a.p LEFT JOIN a f ON a.d > 0 AND f.d = a.d - 1 AND f.p = a.p[1:a.d - 1]""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    said = conversation_trie.sequences(table(spark, folder, "conversations"))
    said = written(said, "conversations")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    heads = said.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    rebuilt = said.withColumn("h", h).withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base", "left").select(
        "conv_id", F.expr("concat(coalesce(slice(head, 1, h), slice(turns, 1, 0)), slice(turns, h + 1, greatest(size(turns) - h, 0)))").alias("turns"))
    return conversation_trie.trie(rebuilt)


@query("op12_hard_negatives", r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
a AS (SELECT DISTINCT vec_id, label, e FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label, c.label AS other, c.vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, label, vec_id AS positive_id, score AS positive_score FROM s WHERE other = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.other <> p.label AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    vectors = vectors.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op13_minhash_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN [array_to_string(ws[p:p + 2], ' ') FOR p IN range(1, len(ws) - 1)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id, doc_id = min(r.c) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))
