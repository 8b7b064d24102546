"""Boosted trees: those of Spark ML where the borders agree, the same for several labels together as for one, and no look-up or pass twice."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from showroom.plans import boosting as bo, training as tr

SIZE = {"iterations": 3, "depth": 3}
SCHEMA = "`线索唯一ID` int, a int, b int, c double, city string, y int, z int"


def rows_of(n, seed=1):
    pick, out = random.Random(seed), []
    for i in range(n):
        a, b, c, city = pick.randint(0, 20), pick.randint(0, 6), pick.randint(0, 29) / 4, f"city{pick.randint(0, 9)}"
        chance = 1 / (1 + np.exp(-(a - 10) / 3 - (b - 3) * (c - 3.5)))
        out.append((i, a, b, c, city, int(pick.random() < chance), int(pick.random() < (0.1 if city < "city5" else 0.4))))
    return out


def shares(df, model, name="p"):
    return {r[0]: r[1] for r in model.positive(df, name).select("线索唯一ID", name).collect()}


@pytest.mark.parametrize("balance", [True, False])
def test_trees_are_those_of_spark_ml(make, balance):
    df = make(rows_of(1500), SCHEMA).repartition(3)
    model = tr.train(df, "y", excluded=["线索唯一ID", "city", "z"], balance=balance, size={"iterations": 4})
    weights = tr.class_weights(df, "y") if balance else {"0": 1.0, "1": 1.0}
    ready = VectorAssembler(inputCols=["a", "b", "c"], outputCol="x").transform(df).withColumns({"w": tr._by_class("y", weights), "i": F.col("y").cast("double")})
    plain = GBTClassifier(featuresCol="x", labelCol="i", weightCol="w", maxIter=4, maxDepth=5, seed=42).fit(ready)
    want = {r[0]: r[1] for r in plain.transform(ready).select("线索唯一ID", vector_to_array("probability")[1]).collect()}
    assert shares(df, model) == pytest.approx(want, abs=1e-9)
    assert model.heads[0].featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-9)
    assert [t.numNodes for t in model.heads[0].trees] == [t.numNodes for t in plain.trees]


def test_together_as_alone(make, monkeypatch):
    df = make(rows_of(1200), SCHEMA).repartition(2)
    passes, boost = [], bo.boost
    monkeypatch.setattr(tr.boosting, "boost", lambda rows, heads, *rest: passes.append(len(heads)) or boost(rows, heads, *rest))
    labelled = df.withColumns({"试驾标签_7天": F.col("y"), "试驾标签_14天": F.col("a") % 2}).drop("y", "z")
    fits = tr.BoostedFits(labelled, ["试驾标签_7天", "试驾标签_14天"], SIZE)
    rows = fits.df
    models = {t: tr.train(rows, t, size=SIZE, together=fits) for t in fits.labels}
    assert passes == [2]
    alone = {t: tr.train(rows, t, size=SIZE) for t in fits.labels}
    assert passes == [2, 1, 1]
    for t in fits.labels:
        assert shares(rows, models[t]) == pytest.approx(shares(rows, alone[t]), abs=1e-9)
    both = tr.add_positives(rows, {"p0": models["试驾标签_7天"], "p1": models["试驾标签_14天"]})
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # one text column, two models
    got = {r[0]: (r[1], r[2]) for r in both.select("线索唯一ID", "p0", "p1").collect()}
    first, second = (shares(rows, models[t]) for t in fits.labels)
    assert all(got[i] == (first[i], second[i]) for i in got) and len(got) == 1200


def test_labels_that_lack_rows_and_several_classes(make):
    df = make(rows_of(600), SCHEMA)
    partly = df.withColumns({"u": F.when(F.col("a") < 9, F.col("y")), "k": F.element_at(F.array(*map(F.lit, "HAB")), F.col("b") % 3 + 1)})
    found = tr.train_boosted(partly, {"u": ["b", "c", "city"], "z": ["b", "c", "city"]}, size=SIZE)
    alone = tr.train(partly.where("u IS NOT NULL"), "u", excluded=["线索唯一ID", "a", "y", "z", "k"], size=SIZE)
    assert shares(df, found["u"]) == pytest.approx(shares(df, alone), abs=1e-9)
    heads = tr.train(partly, "k", excluded=["线索唯一ID", "u", "y", "z"], size=SIZE)
    assert len(heads.heads) == 3
    right = heads.predict(partly).where(F.col(tr.v.PREDICTED) == F.col("k")).count()
    assert right > 550


def test_many_blocks_and_tasks_give_one_result(make, monkeypatch):
    df = make(rows_of(900), SCHEMA).repartition(4)
    names = {"excluded": ["线索唯一ID", "z"], "size": SIZE}
    want = shares(df, tr.train(df, "y", **names))
    for name, value in (("BLOCK", 64), ("OF_TASK", 10), ("TO_DRIVER", 1), ("CELLS", 40)):
        monkeypatch.setattr(bo, name, value)
    assert shares(df, tr.train(df, "y", **names)) == pytest.approx(want, abs=1e-9)


def test_borders():
    few = bo.merged_points(np.array([3.0, 1.0, 3.0, 2.0]), np.array([1.0, 0.0, 1.0, 5.0]))
    assert [p.tolist() for p in few] == [[2.0, 3.0], [5.0, 2.0]] and bo.borders_of(*few) == [2.5]
    values = np.random.default_rng(0).normal(size=50_000)
    points, weights = bo.merged_points(values, np.ones(50_000))
    assert len(points) <= bo.POINTS and weights.sum() == 50_000
    ranks = np.searchsorted(np.sort(values), bo.borders_of(points, weights)) / 50_000
    assert ranks == pytest.approx(np.arange(1, 32) / 32, abs=0.002)
