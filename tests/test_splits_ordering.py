import random
from collections import Counter
from datetime import datetime as dt, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.operators import ordering as od, splits as sp


def test_global_rank_with_a_hot_value(spark):
    df = spark.range(3000, numPartitions=7).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("s"), (F.col("id") % 2).alias("g"))
    df = df.persist()
    rows = df.collect()
    got = {r["id"]: r["rank"] for r in od.global_rank(df, [F.desc("s"), F.asc("id")], ["g"]).collect()}
    for g in (0, 1):
        expected = sorted((r for r in rows if r["g"] == g), key=lambda r: (-r["s"], r["id"]))
        assert [got[r["id"]] for r in expected] == list(range(1, len(expected) + 1))


def test_running_totals_span_slices(spark):
    df = spark.range(500, numPartitions=5).select("id", (F.col("id") % 7).alias("w"))
    out = {r["id"]: r["t"] for r in od.running_totals(df, [F.asc("id")], {"t": F.col("w")}).collect()}
    assert all(out[i] == sum(j % 7 for j in range(i)) for i in range(0, 500, 37))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles(make, seed):
    rng = random.Random(seed)
    a = [rng.choice([1.0, 2.0, rng.random() * 10]) for _ in range(rng.randint(1, 60))]
    b = [rng.gauss(0, 5) for _ in a]
    df = make([(x, y if i % 4 else None) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    ps = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]
    got = {(r["column"], r["p"]): r["quantile"] for r in od.exact_quantiles(df, ["a", "b"], ps).collect()}
    kept = [y for i, y in enumerate(b) if i % 4]
    for p in ps:
        assert got["a", p] == pytest.approx(np.quantile(a, p))
        if kept:
            assert got["b", p] == pytest.approx(np.quantile(kept, p))


def classes(make, sizes):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    return make(rows, "`线索唯一ID` string, t string")


def sizes_of(df, key="t"):
    return {(r[key], r["split"]): r["count"] for r in df.groupBy(key, "split").count().collect()}


def test_three_way_bounds(make):
    df = classes(make, {"one": 1, "two": 2, "three": 3, "ten": 10, "many": 101})
    got = sizes_of(sp.stratified_split(df, "t", v.LEAD_ID, sp.three_way_sizes((0.7, 0.15, 0.15))))
    expected = {}
    for c, n in (("one", 1), ("two", 2), ("three", 3), ("ten", 10), ("many", 101)):
        train = max(1, round(n * 0.7)) if n >= 3 else max(1, n - 2)
        valid = min(train + max(1, round(n * 0.15)), n - 1) if n >= 3 else min(n, train + 1)
        for part, k in (("train", train), ("valid", valid - train), ("test", n - valid)):
            if k:
                expected[c, part] = k
    assert got == expected


def test_random_split_is_reproducible_and_complete(spark):
    df = spark.range(2000, numPartitions=3).select(F.col("id").alias(v.LEAD_ID), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise("x").alias("t"))
    one = sp.random_split(df, "t", seed=5)
    two = sp.random_split(df.repartition(11), "t", seed=5)
    assert one.exceptAll(two).count() == 0 and one.count() == df.where("t IS NOT NULL").count()
    counts = sizes_of(one)
    n = df.where("t = 'hot'").count()
    assert counts["hot", "test"] == round(n * 0.2)
    other = sp.random_split(df, "t", seed=6)
    assert one.exceptAll(other).count() > 0
    assert sizes_of(sp.random_split(df, None).withColumn("t", F.lit("a")))["a", "test"] == 400


def test_floor_and_nearest(make):
    df = classes(make, {"a": 8, "b": 4})
    assert sizes_of(sp.random_split(df, "t", test_ratio=0.2))["a", "test"] == 2
    assert sizes_of(sp.random_split(df, "t", test_ratio=0.2, rounding="floor"))["a", "test"] == 1
    assert ("b", "test") not in sizes_of(sp.random_split(df, "t", test_ratio=0.2, rounding="floor"))


def test_group_keys(make):
    df = make([("L1", "13800000000"), ("L2", ""), ("L3", None), ("L4", " 13900000000 "), ("L5", "nan")], "`线索唯一ID` string, `手机号_脱敏` string")
    assert [r[0] for r in df.select(sp.group_key(df)).collect()] == [
        "phone::13800000000", "lead::L2", "lead::L3", "phone::13900000000", "lead::L5"]


def grouped(make, n=120):
    start = dt(2026, 3, 1)
    rows = [(f"L{i}", "hot" if i % 3 == 0 else (f"1380000{i // 2:04d}" if i % 7 else ""), start + timedelta(hours=2 * i), "HABO"[i % 4]) for i in range(n)]
    return make(rows, "`线索唯一ID` string, `手机号_脱敏` string, `线索创建时间` timestamp, `线索评级_试驾前` string")


def test_grouped_split_keeps_groups_together(make):
    df = grouped(make)
    rows, assigned = sp.group_split(df, "线索评级_试驾前", keep_key=True)
    assert rows.count() == 120
    assert rows.groupBy("split_group_key").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert "split_group_key" not in sp.group_split(df, "线索评级_试驾前")[0].columns
    mark = sp.group_fingerprint(assigned)
    assert len(mark["group_key_fingerprint"]) == 16 and sum(mark["group_counts"].values()) == assigned.count()
    again = sp.group_fingerprint(sp.group_split(df.repartition(5), "线索评级_试驾前")[1])
    assert again == mark and mark["group_counts"]["test"] > 0


def test_dominant_label_ties(make):
    df = make([("g", "B"), ("g", "A"), ("h", "B"), ("h", "B"), ("h", "A"), ("i", None), ("i", "A")], "g string, t string")
    got = {r["g"]: r["t"] for r in sp.dominant_label(df, "g", "t").collect()}
    assert got == {"g": "A", "h": "B", "i": "A"}


def test_smart_split(make):
    df = grouped(make, 200)
    rows, info = sp.smart_split(df, "线索评级_试驾前")
    assert info["mode"] == "oot" and info["span_days"] == 16
    assert (info["train_end"], info["valid_end"]) == ("2026-03-12", "2026-03-15")
    assert rows.where("split = 'train'").agg(F.max(v.CREATED)).first()[0] < dt(2026, 3, 12)
    short, info = sp.smart_split(grouped(make, 60), "线索评级_试驾前")
    assert info["mode"] == "random" and set(info["group_counts"]) == {"train", "valid", "test"}
    with pytest.raises(ValueError):
        sp.smart_split(df, "线索评级_试驾前", split_mode="manual_oot")
    ids = sp.test_ids(short)
    unseen = sp.isolate_test(grouped(make, 60), {"mode": "random", "id_column": v.LEAD_ID}, ids)
    assert unseen.count() == ids.count() > 0


def test_time_splits(make):
    df = grouped(make, 100).withColumn(v.CREATED, F.when(F.col(v.LEAD_ID) != "L5", F.col(v.CREATED)))
    out = sp.time_split(df, "2026-03-05")
    assert Counter(r["split"] for r in out.collect()) == {"train": 47, "test": 52}
    with pytest.raises(ValueError, match="empty"):
        sp.require_parts(sp.time_split(df, "2030-01-01"), ("train", "test"))
    three = sp.parts(sp.time_split_three(df, "2026-03-03", "2026-03-06"))
    assert sum(x.count() for x in three.values()) == 99
    sp.check_disjoint(three["train"], three["test"])
    with pytest.raises(ValueError):
        sp.check_disjoint(three["train"], three["train"])
    auto, info = sp.auto_split(df, None, min_days=5)
    assert info["mode"] == "oot" and auto.count() == 99
    assert sp.auto_split(df, None, min_days=30)[1]["mode"] == "random"


def test_time_quantile(make):
    import pandas as pd

    df = grouped(make, 37)
    times = pd.Series([r[0] for r in df.select(v.CREATED).collect()])
    assert sp.time_quantile(df) == times.quantile(0.8).to_pydatetime()
    full, driven = sp.unified_split(df.withColumn(v.DRIVEN, F.when(F.col(v.LEAD_ID) < "L2", F.col(v.CREATED))))
    assert full.count() == 37 and driven.count() == full.where(f"`{v.DRIVEN}` IS NOT NULL").count()


def test_holdout(make):
    got = sizes_of(sp.holdout_split(classes(make, {"a": 10, "b": 20}), "t"))
    assert got == {("a", "train"): 8, ("a", "test"): 1, ("b", "train"): 16, ("b", "test"): 3}
    assert sp.holdout_split(classes(make, {"a": 10}), "t", stratify=False).where("split = 'test'").count() == 2


def test_ranks_and_quantiles(spark):
    df = spark.range(4000, numPartitions=5).select(
        "id", F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.hash("id") % 1000).cast("double")).alias("x"), (F.rand(3) * 10).alias("z"),
        F.exp(F.randn(5) * 20).alias("wide"), F.when(F.col("id") < 7, F.col("id").cast("double")).alias("few"), F.lit(2.5).alias("one"),
        F.lit(None).cast("double").alias("none")).persist()
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    columns = ["x", "z", "wide", "few", "one"]
    got = {(r[0], r[1]): r[2] for r in od.exact_quantiles(df, [*columns, "none"], ps).collect()}
    for c in columns:
        values = [r[0] for r in df.where(f"{c} IS NOT NULL").select(c).collect()]
        assert all(got[c, p] == pytest.approx(np.quantile(values, p)) for p in ps)
    assert len(got) == 7 * len(columns)
    odd = spark.createDataFrame([(x,) for x in (float("-inf"), 1.0, 2.0, float("inf"), None)], "x double")
    assert sorted(r[2] for r in od.exact_quantiles(odd, ["x"], [1 / 3, 2 / 3]).collect()) == pytest.approx([1.0, 2.0])
    ranks = {r["id"]: r["rank"] for r in od.global_rank(df, [F.desc("x"), F.asc("id")]).collect()}
    rows = sorted(df.select("id", "x").collect(), key=lambda r: (-r.x, r.id))
    assert ranks == {r.id: i + 1 for i, r in enumerate(rows)}

