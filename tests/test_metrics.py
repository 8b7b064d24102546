import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.operators import business as bz, classes as cl, ranking as rk


def scored(make, n, seed=1, levels=None):
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 1), rng.choice(levels) if levels else rng.random()) for i in range(n)]
    return rows, make(rows, "id long, y int, s double")


def ranked(rows):
    return sorted(rows, key=lambda r: (-r[2], r[0]))


def test_top_list_order(make):
    df = make([(101, "A", 0.2), (102, "H", 0.9), (103, "B", 0.6)], "`线索唯一ID` int, label string, p_H double")
    top = rk.top_list(df, "p_H", label="label", k=2).collect()
    assert [(r["rank"], r[v.LEAD_ID], r["actual_label"]) for r in top] == [(1, 102, "H"), (2, 103, "B")]
    assert rk.hit_count(rk.top_list(df, "p_H", label="label", k=2), "H").first()[0] == 1
    assert rk.hit_count(rk.top_list(df, "p_H", label="label", k=2)).first()[0] is None
    with pytest.raises(ValueError):
        rk.resolve_score({"H": "a", "A": "b", "B": "c"}, None)
    with pytest.raises(ValueError):
        rk.resolve_score({"H": "a"}, "X")
    assert rk.resolve_score({"0": "a", "1": "b"}, None) == "b"


@pytest.mark.parametrize("n", [7, 10, 23, 105])
def test_deciles_with_ties(make, n):
    rows, df = scored(make, n, n, [0.1, 0.1, 0.5, 0.9])
    got = {r["decile"]: r for r in rk.decile_lift(df, "y", "s", "id").collect()}
    order, size = ranked(rows), n // 10
    base = np.mean([r[1] for r in rows])
    for i in range(10):
        end = (i + 1) * size if i < 9 else n
        part = order[i * size:end]
        if not part:
            assert i + 1 not in got
            continue
        row = got[i + 1]
        assert (row["count"], row["hit_count"]) == (len(part), sum(r[1] for r in part))
        assert row["cumulative_hit_rate"] == pytest.approx(np.mean([r[1] for r in order[:end]]))
        assert row["lift"] == pytest.approx(row["hit_rate"] / base if base else 0.0)


def test_top_k(make):
    rows, df = scored(make, 60, 4)
    got = {r["k"]: r for r in rk.top_k_metrics(df, "y", "s", "id", (5, 20, 100)).collect()}
    assert set(got) == {5, 20}
    total = sum(r[1] for r in rows)
    for k in (5, 20):
        hits = sum(r[1] for r in ranked(rows)[:k])
        assert got[k]["hit_count"] == hits and got[k]["recall"] == pytest.approx(hits / total)
        assert got[k]["lift"] == pytest.approx((hits / k) / (total / 60))


def test_compare_rankings(make):
    rows, df = scored(make, 50, 8)
    df = df.withColumn("rival", F.col("id").cast("double"))
    got = rk.compare_rankings(df, "y", "s", "rival", "id", (10, 60)).collect()
    assert len(got) == 1
    mine = {r[0] for r in ranked(rows)[:10]}
    rival = set(range(40, 50))
    assert got[0]["overlap_count"] == len(mine & rival)
    assert got[0]["baseline_hits"] == sum(r[1] for r in rows if r[0] in rival)


@pytest.mark.parametrize("levels", [None, [0.1, 0.5, 0.5, 0.9], [0.5]])
def test_auc_counts_ties_half(make, levels):
    rows, df = scored(make, 80, 3, levels)
    pos, neg = [r[2] for r in rows if r[1]], [r[2] for r in rows if not r[1]]
    expected = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert rk.auc(df, "y", "s").first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("levels", [None, [0.0, 0.0, 0.0, 0.4, 0.8]])
def test_quantile_bins_match_pandas(make, levels):
    import pandas as pd

    rows, df = scored(make, 97, 5, levels)
    bins = pd.qcut([r[2] for r in rows], q=10, labels=False, duplicates="drop")
    got = {r["bin"]: (r["count"], r["positive_count"]) for r in rk.quantile_bins(df, "y", "s", "s").collect()}
    expected = {b + 1: (int((bins == b).sum()), sum(r[1] for r, x in zip(rows, bins) if x == b)) for b in set(bins)}
    assert got == expected
    summary = rk.bin_summary(rk.quantile_bins(df, "y", "s", "s")).first()
    assert summary["total_samples"] == 97


def test_class_ranking_and_thresholds(make):
    df = make([(1, "H", .8, .1, .1), (2, "A", .2, .7, .1), (3, "B", .1, .1, .8), (4, "B", .1, .2, .7)], "id int, y string, p_H double, p_A double, p_B double")
    out = {(r["class"], r["top_ratio"]): r for r in rk.class_ranking(df, "y", {"H": "p_H", "A": "p_A", "B": "p_B"}, "id", (0.5,)).collect()}
    assert out["B", 0.5]["lift"] == 2.0 and out["B", 0.5]["hit_rate"] == 1.0 and out["B", 0.5]["top_n"] == 2
    report = {r["threshold"]: r for r in cl.threshold_report(df, "y", "p_B", "B", [0.5, 0.9]).collect()}
    assert report[0.5]["precision"] == report[0.5]["recall"] == 1.0
    assert report[0.9]["predicted_positive"] == 0 and report[0.9]["f1"] == 0.0


def test_zero_division(make):
    df = make([("H", "H"), ("A", "A"), ("B", "A"), ("B", "A")], "y string, p string")
    rows = {r["class"]: r for r in cl.classification_report(df, "y", "p").collect()}
    assert rows["B"]["precision"] == rows["B"]["recall"] == 0.0 and rows["B"]["support"] == 2
    assert rows["accuracy"]["f1"] == 0.5
    matrix = cl.confusion_matrix(df, "y", "p").collect()
    assert [(r["actual"], r["pred_H"], r["pred_A"], r["pred_B"]) for r in matrix] == [("H", 1, 0, 0), ("A", 0, 1, 0), ("B", 0, 2, 0)]


def brute_scores(pairs):
    labels = sorted({x for p in pairs for x in p})
    count = lambda f: sum(1 for p in pairs if f(*p))
    recalls, f1 = [], []
    for c in labels:
        tp, sup, pred = count(lambda a, b: a == b == c), count(lambda a, b: a == c), count(lambda a, b: b == c)
        if sup:
            recalls.append(tp / sup)
        f1.append(2 * tp / (sup + pred) if sup + pred else 0.0)
    return np.mean(recalls), np.mean(f1)


def test_class_metrics_with_a_class_never_true(make):
    pairs = [("H", "A"), ("H", "H"), ("A", "A"), ("A", "B"), ("H", "B")]
    row = cl.class_metrics(make(pairs, "y string, p string"), "y", "p").first()
    ba, mf = brute_scores(pairs)
    assert row["balanced_accuracy"] == pytest.approx(ba) and row["macro_f1"] == pytest.approx(mf)
    t, p = np.array([[x == c for c in "HAB"] for x, _ in pairs]) * 1.0, np.array([[x == c for c in "HAB"] for _, x in pairs]) * 1.0
    cov = lambda a, b: ((a - a.mean(0)) * (b - b.mean(0))).sum()
    assert row["mcc"] == pytest.approx(cov(t, p) / np.sqrt(cov(t, t) * cov(p, p)))


def test_policy_search_matches_brute_force(make):
    rng = random.Random(2)
    rows = []
    for _ in range(80):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((rng.choice("HAB"), a / (a + b + c), b / (a + b + c), c / (a + b + c)))
    df = make(rows, "y string, p_H double, p_A double, p_B double")
    best, choice = None, None
    for h in v.H_THRESHOLDS:
        for b in v.B_THRESHOLDS:
            pairs = [(y, "H" if ph >= h else "B" if pb >= b else "A") for y, ph, _, pb in rows]
            ba, mf = brute_scores(pairs)
            said = [p for _, p in pairs]
            recall = sum(y == p == "B" for y, p in pairs) / sum(y == "B" for y, _ in pairs)
            score = (float(said.count("B") / len(said) >= 0.03), round(ba, 12), round(recall, 12), round(mf, 12))
            if best is None or score > best:
                best, choice = score, (h, b)
    found = cl.optimise_hab_policy(df, "y", {"H": "p_H", "A": "p_A", "B": "p_B"})
    assert (found["h_threshold"], found["b_threshold"]) == choice
    assert cl.optimise_hab_policy(df, "y", {"H": "p_H"}) == {"strategy": "argmax"}
    assert cl.optimise_hab_policy(df.limit(0), "y", {"H": "p_H", "A": "p_A", "B": "p_B"}) == {"strategy": "argmax"}


def test_h_threshold(make):
    df = make([("H", .7, .5, .5), ("H", .62, .5, .5), ("A", .55, .8, .2), ("B", .2, .1, .9)], "y string, h double, a double, b double")
    found = cl.tune_h_threshold(df, "y", "h", "a", "b", thresholds=(0.5, 0.6, 0.7))
    assert found["h_threshold"] == 0.6 and found["metrics"]["balanced_accuracy"] > 0.8
    assert cl.tune_h_threshold(df.limit(0), "y", "h", "a", "b")["h_threshold"] == 0.5


def test_buckets_and_kpis(make):
    df = make([("H", 1, 1), ("H", 1, 0), ("A", 0, 0), ("B", 0, 0)], "`预测标签` string, `到店标签_14天` int, `试驾标签_14天` int")
    kpi = bz.business_kpis(df).first()
    assert kpi["h_arrive_lift"] == 2.0 and kpi["ha_arrive_capture"] == 1.0 and kpi["ha_drive_capture"] == 1.0 and kpi["b_bucket_share"] == 0.25
    assert kpi["arrive_monotonic"] is False and kpi["client_layering_message"] == v.LAYERED_NONE
    buckets = bz.bucket_summary(df)
    assert {r["bucket"]: r["sample_ratio"] for r in buckets.collect()} == {"H": 0.5, "A": 0.25, "B": 0.25}
    assert bz.monotonicity(buckets).first()["message"] == v.MONOTONIC_NO
    steps = make([("H", 1), ("A", 1), ("A", 0), ("B", 0)], "`预测标签` string, `试驾标签_14天` int")
    assert bz.monotonicity(bz.bucket_summary(steps)).first()["passed"] is True
    assert bz.business_kpis(steps).first()["client_layering_message"] == v.LAYERED_ONE
    assert bz.business_kpis(steps).first()["arrive_monotonic"] is None
    assert bz.monotonicity(bz.bucket_summary(steps.where("`预测标签` != 'B'"))).first()["message"] == v.MONOTONIC_MISSING


def test_recommendation(make):
    table = make([("two_stage", "two_stage", .3589, .40, .1), ("base", "baseline", .3557, .45, .1), ("card", "scorecard", .20, .9, .9)],
                 "model_name string, role string, macro_f1 double, balanced_accuracy double, b_recall double")
    assert bz.recommend(table).first()["role"] == "baseline"
    assert bz.recommend(table, tolerance=0.0).first()["role"] == "two_stage"


def test_comparison_deltas(make):
    df = make([("H", "H", "A"), ("A", "A", "A"), ("B", "B", "B")], "y string, good string, bad string")
    rows = [bz.comparison_row(df, n, r, "y", c) for n, r, c in (("g", "two_stage", "good"), ("b", "baseline", "bad"))]
    out = {r["role"]: r for r in bz.compare_models(rows).collect()}
    assert out["baseline"]["delta_vs_baseline_accuracy"] == 0.0
    assert out["two_stage"]["delta_vs_baseline_accuracy"] == pytest.approx(1 / 3)
    alone = bz.compare_models(rows[:1]).first()
    assert alone["delta_vs_baseline_accuracy"] is None


def test_derivation(make):
    df = make([(.9, .9, .9, 1, 1, 1), (.1, .9, .9, 0, 0, 1), (.1, .1, .9, 0, 0, 0)], "a double, b double, c double, d7 int, d14 int, d21 int")
    rows = {r["rating"]: r for r in bz.validate_derivation(df, "a", "b", "c", {7: "d7", 14: "d14", 21: "d21"}).collect()}
    assert rows["H"]["rate_14d"] == 1.0 and rows["N"]["count"] == 0 and rows["N"]["rate_7d"] == 0.0 and rows["A"]["is_hierarchical"]
