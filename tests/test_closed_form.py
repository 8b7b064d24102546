"""The closed-form family against its formulas, and judgements side by side."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from showroom.operators import business as bz
from showroom.plans import training as tr

SCHEMA = "id bigint, label string, city string, calls int, score double"


def rows_of(seed, n):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        label = pick.choice("HAB")
        city = pick.choice(["x", "y", None, "", label])
        out.append((i, label, city, pick.choice([None, 1, 2, 3, 50]), pick.choice([None, float("nan"), 0.0, 1.5])))
    return out


def quantile(values, q):
    at = q * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)


def plain(train, row, classes, bins=10):
    """Probabilities from counts."""
    columns = {3: "n", 4: "n", 2: "t"}
    borders = {}
    for c, kind in columns.items():
        if kind == "n":
            values = sorted(float(r[c]) for r in train if r[c] is not None and not math.isnan(r[c]))
            borders[c] = sorted({quantile(values, i / bins) for i in range(1, bins)})

    def code(r, c):
        if columns[c] == "t":
            return r[c] or ""
        return "" if r[c] is None or math.isnan(r[c]) else str(sum(r[c] > b for b in borders[c]))

    sizes = Counter(r[1] for r in train)
    total = {k: math.log(1 / len(classes)) for k in classes}
    for c in columns:
        counts = Counter((code(r, c), r[1]) for r in train)
        values = len({code(r, c) for r in train})
        for k in classes:
            total[k] += math.log((counts[code(row, c), k] + 1) / (sizes[k] + values + 1))
    weights = {k: math.exp(t - max(total.values())) for k, t in total.items()}
    return [weights[k] / sum(weights.values()) for k in classes]


def test_probabilities_equal_plain_ones(spark, make, tmp_path):
    train, test = rows_of(1, 200), [*rows_of(2, 40), (900, "H", "never seen", 1000, -3.0)]
    model = tr.train(make(train, SCHEMA).drop("id"), "label", "NaiveBayes")
    assert sorted(model.features) == ["calls", "city", "score"]
    got = {r["id"]: r for r in model.predict(make(test, SCHEMA)).collect()}
    for row in test:
        p = [got[row[0]][f"p_{c}"] for c in model.classes]
        assert p == pytest.approx(plain(train, row, model.classes), abs=1e-7)
        assert p[model.classes.index(got[row[0]][tr.v.PREDICTED])] == max(p)
    shares = model.importances()
    assert sum(shares.values()) == pytest.approx(1) and next(iter(shares)) == "city"
    model.save(spark, str(tmp_path / "m"))
    back = tr.LeadModel.load(spark, str(tmp_path / "m"))
    again = {r["id"]: r for r in back.predict(make(test, SCHEMA)).collect()}
    for i, r in got.items():
        assert [again[i][f"p_{c}"] for c in model.classes] == [r[f"p_{c}"] for c in model.classes]


def test_odd_training_rows(make):
    rows = [(1, "a", None, None, None), (2, "b", None, None, None), (3, None, "x", 1, 1.0)]
    model = tr.train(make(rows, SCHEMA).drop("id"), "label", "NaiveBayes")
    p = model.probabilities(make(rows, SCHEMA)).first()
    assert p["p_a"] == p["p_b"] == 0.5
    with pytest.raises(ValueError, match="one class"):
        tr.train(make(rows[:1], SCHEMA).drop("id"), "label", "NaiveBayes")
    assert model.probabilities(make([], SCHEMA)).count() == 0


def test_side_by_side_is_one_projection(spark, make):
    df = make([(1, "H", "H"), (2, None, None), (3, "A", None)], "id bigint, one string, other string")
    out = bz.side_by_side(df, {"one_says": F.col("one"), "other_says": F.col("other")}, "id")
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "H", "H", True), (2, None, None, True), (3, "A", None, False)]
    assert "Exchange" not in bz.side_by_side(df, {"a": F.col("one")}, "id")._jdf.queryExecution().executedPlan().toString()
