"""Target statistics of text columns: shares without the row's own fold in training, and of all training rows afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.plans import target_statistics as ts
from showroom.queries.closed_form_queries import SPLIT_SQL, rated
from showroom.queries.registry import lead_id, query, tidy

COLUMNS = {v.CITY: "city", v.CAR: "car", "一级渠道名称": "channel1", "客户是否同意加微信": "add_wechat"}
CLASSES = ("H", "A", "B")
FOLD_SQL = f"CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % {ts.FOLDS}"


def _share(c: str) -> str:
    overall = f"coalesce((w.n{c} - coalesce(g.n{c}, 0)) / nullif(w.n - coalesce(g.n, 0), 0), 1 / {len(CLASSES)})"
    return (f"round((coalesce(t.n{c}, 0) - coalesce(o.n{c}, 0) + {ts.STRENGTH} * {overall}) / (coalesce(t.n, 0) - coalesce(o.n, 0) + {ts.STRENGTH}), 6) AS "
            f'"share_{c}"')


COUNTS = ", ".join(["count(*) AS n", *[f"count(*) FILTER (rating = '{c}') AS n{c}" for c in CLASSES]])
STATISTICS_SQL = SPLIT_SQL + f""", f AS MATERIALIZED (SELECT id, part, rating, {FOLD_SQL} AS fold, unnest(range({len(COLUMNS)})) AS i,
  unnest([{', '.join(f"coalesce({c}, '')" for c in COLUMNS.values())}]) AS val FROM r),
t AS (SELECT i, val, {COUNTS} FROM f WHERE part = 'train' GROUP BY ALL),
o AS (SELECT i, val, fold, {COUNTS} FROM f WHERE part = 'train' GROUP BY ALL),
g AS (SELECT fold, {COUNTS} FROM f WHERE part = 'train' AND i = 0 GROUP BY ALL), w AS (SELECT {COUNTS} FROM f WHERE part = 'train' AND i = 0)
SELECT f.id, part, f.fold, [{', '.join(repr(c) for c in COLUMNS)}][f.i + 1] AS feature, coalesce(t.n, 0) - coalesce(o.n, 0) AS n, {', '.join(_share(c) for c in CLASSES)}
FROM f CROSS JOIN w LEFT JOIN t ON t.i = f.i AND t.val = f.val LEFT JOIN o ON part = 'train' AND o.i = f.i AND o.val = f.val AND o.fold = f.fold
  LEFT JOIN g ON part = 'train' AND g.fold = f.fold"""


@query("m1_target_statistics", STATISTICS_SQL)
def target_statistics(spark, folder):
    """Fold, rows behind the shares, and shares by class for every rated lead and text column."""
    prep = rated(spark, folder, tuple(COLUMNS))
    found = ts.fit(prep.train, prep.target, list(COLUMNS), CLASSES, [v.LEAD_ID])
    parts = None
    for name, rows in (("train", prep.train), ("valid", prep.valid), ("test", prep.test)):
        rows = found.encode(rows, training=name == "train", counts="__c").withColumn("part", F.lit(name))
        parts = rows if parts is None else parts.unionByName(rows)
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"__c{i}").alias("n"), *[F.col(x).alias(f"share_{y}") for x, y in zip(found.names(i), CLASSES, strict=True)])
        for i, c in enumerate(COLUMNS)]))
    return tidy(parts.select(lead_id(), "part", ts.fold_of([v.LEAD_ID]).alias("fold"), cells.alias("x")).select("id", "part", "fold", "x.*"))
