"""Target statistics against plain sums, and models that learn from them."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from showroom.plans import target_statistics as ts, training as tr

SCHEMA = "id bigint, label string, city string, car string"
CLASSES = ["H", "A", "B"]


def rows_of(seed, n, labels="HAB"):
    pick = random.Random(seed)
    return [(i, pick.choice(labels), pick.choice(["x", "y", None, ""]), f"car{pick.randint(0, 30)}") for i in range(n)]


def fold(i):
    return int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % ts.FOLDS


def plain(train, value, column, out=None):
    """Rows behind the shares, and the shares; ``out`` is the fold left out."""
    rows = [r for r in train if r[1] in CLASSES and (out is None or fold(r[0]) != out)]
    same = [r for r in rows if (r[column] or "") == (value or "")]
    overall = [sum(r[1] == c for r in rows) / len(rows) if rows else 1 / len(CLASSES) for c in CLASSES]
    return len(same), [(sum(r[1] == c for r in same) + ts.STRENGTH * p) / (len(same) + ts.STRENGTH) for c, p in zip(CLASSES, overall)]


def encoded(found, df, training):
    names = [n for i in range(2) for n in (f"c{i}", *found.names(i))]
    return {r["id"]: [r[n] for n in names] for r in found.encode(df, training, counts="c").collect()}


def test_shares_equal_plain_ones(spark, make, tmp_path):
    train = [*rows_of(1, 150), (500, None, "x", "car1"), (501, "other", "x", "car1")]
    new = [*rows_of(2, 20), (900, "H", "never seen", None)]
    found = ts.fit(make(train, SCHEMA), "label", ["city", "car"], CLASSES, ["id"])
    got = encoded(found, make(train[:150], SCHEMA), True)
    for row in train[:150]:
        want = [x for c in (2, 3) for n, shares in [plain(train, row[c], c, fold(row[0]))] for x in (n, *shares)]
        assert got[row[0]] == pytest.approx(want)
    found.save(spark, str(tmp_path / "s"))
    for again in (found, ts.TargetStatistics.load(spark, str(tmp_path / "s"))):
        got = encoded(again, make(new, SCHEMA), False)
        for row in new:
            assert got[row[0]] == pytest.approx([x for c in (2, 3) for n, shares in [plain(train, row[c], c)] for x in (n, *shares)])


def test_no_row_sees_its_own_label(make):
    train = rows_of(3, 60)
    before = encoded(ts.fit(make(train, SCHEMA), "label", ["city", "car"], CLASSES, ["id"]), make(train, SCHEMA), True)
    for i in (0, 7, 31):
        turned = [(r[0], {"H": "A", "A": "B", "B": "H"}[r[1]], *r[2:]) if r[0] == i else r for r in train]
        after = encoded(ts.fit(make(turned, SCHEMA), "label", ["city", "car"], CLASSES, ["id"]), make(turned, SCHEMA), True)
        assert after[i] == before[i]
        assert any(after[r[0]] != before[r[0]] for r in train if fold(r[0]) != fold(i))


def test_odd_rows(make):
    one = make([(1, "H", None, "a")], SCHEMA)
    found = ts.fit(one, "label", ["city", "car"], CLASSES, ["id"])
    assert encoded(found, one, True)[1] == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3] * 2)
    none = ts.fit(one.where("id > 1"), "label", ["city", "car"], CLASSES, ["id"])
    assert encoded(none, one, False)[1] == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3] * 2)
    assert encoded(found, one.where("id > 1"), False) == {}
    assert ts.fit(one, "label", ["city"], ["0", "1"], ["id"]).names(0) == ["__s0_1"]
    with pytest.raises(ValueError, match="no text"):
        ts.fit(one, "label", [], CLASSES, ["id"])


def test_hot_value_keeps_every_row(spark):
    """A third of the rows has one value; with broadcasts off, all rows are kept and a value is one row of the table."""
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 2 == 0, "H").otherwise("A").alias("label"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("city"))
    found = ts.fit(df, "label", ["city"], ["H", "A"], ["id"])
    assert found.table.count() == 2001
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = found.encode(df, True, counts="c")
        assert out.count() == 3000 and out.where("city = 'hot'").agg(F.max("c0")).first()[0] < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("family", ["GBT", "LogisticRegression"])
def test_five_hundred_values_stay_apart(spark, make, tmp_path, family):
    """The label depends on the value alone, at random; few slots could not tell the values apart."""
    says = {i: random.Random(i).choice("01") for i in range(500)}
    rows = [(i, says[i % 500], f"car{i % 500}") for i in range(20_000)]
    df = make(rows, "id bigint, label string, car string")
    model = tr.train(df.drop("id"), "label", family, size={"iterations": 4})
    assert (model.statistics is not None) == (family == "GBT")
    model.save(spark, str(tmp_path / "m"))
    seen = tr.LeadModel.load(spark, str(tmp_path / "m")).predict(df.where("id < 500"))
    right = seen.where(F.col(tr.v.PREDICTED) == F.col("label")).count()
    assert right == 500 if family == "GBT" else right > 400
    assert list(model.importances()) == ["car"]
    with pytest.raises(ValueError, match="unknown encoding"):
        tr.train(df.drop("id"), "label", family, encoding="numbers")
