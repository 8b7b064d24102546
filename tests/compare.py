"""Runs registered queries in Spark and their SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value).lower())
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else f"{value + 0.0:.6f}")
    if isinstance(value, (list, tuple)):
        return (3, repr([_plain(x) for x in value]))
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return (2, f"{float(value):.6f}")
    return (4, str(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def engine(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name, query, sql):
    began = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - began
    if sql is None:
        return None, f"rows={len(got)} (no SQL)", took
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}", took
    kinds = {}
    for f in df.schema:
        kinds[f.name] = f.dataType.simpleString()
    sql_kinds = {d[0]: str(d[1]) for d in result.description}
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        off = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{len(a)} vs {len(b)} rows; columns {sorted(names)}; first differences {off}", took
    loose = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {n: (k, sql_kinds[n]) for n, k in kinds.items() if loose.get(k) != sql_kinds[n]}
    return True, f"rows={len(a)}" + (f" types {odd}" if odd else ""), took


def main(folder, only):
    import __spark_entry__ as entry
    from showroom import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = engine(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            ok, text, took = compare(spark, con, folder, name, query, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            ok, text, took = False, f"{type(error).__name__}: {str(error)[:900]}", 0.0
        bad += ok is False
        print(f"{'ok ' if ok else ('-- ' if ok is None else 'BAD')} {name:34s} {took:6.2f}s {text}", flush=True)
    print(f"{len(queries)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
