import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.operators import behavior as bh, cleaning as cg, contract as ct, profiling as pf


def test_alias_only_columns_are_renamed(make):
    df = make([("S", "138", "车", "10", "是", 1)], "`客户ID(店端)` string, `手机号（脱敏）` string, `首触意向车型/意向车型` string, "
              "`预算区间(购车预算)` string, `客户是否主动询问购车权益（优惠）` string, `通话时长是否>=45秒` int")
    out, report = ct.apply_alias_contract(df)
    assert out.columns == ["客户ID_店端", "手机号_脱敏", "首触意向车型", "预算区间", "客户是否主动询问购车权益", "通话时长是否大于等于45秒"]
    assert tuple(out.first()) == ("S", "138", "车", "10", "是", 1)
    assert len(report.applied_aliases) == 6 and not report.filled_aliases


def test_competing_aliases_fill_blanks_in_order(make):
    df = make([("", "a", "b"), (None, " ", "c"), ("x", "a", "b"), (None, None, None)],
              "`非首触跟进时间` string, `非首触跟进时间_备用` string, `非首触跟进时间_备用2` string")
    out, report = ct.apply_alias_contract(df)
    assert [r[0] for r in out.collect()] == ["a", "c", "x", None]
    assert report.dropped_aliases == ["非首触跟进时间_备用", "非首触跟进时间_备用2"]
    assert set(report.filled_aliases) == {"非首触跟进时间_备用", "非首触跟进时间_备用2"}


def test_two_aliases_without_the_canonical_name(make):
    df = make([(None, "b")], "`预算区间_备用` string, `预算区间(购车预算)` string")
    out, report = ct.apply_alias_contract(df)
    assert out.columns == ["预算区间"] and out.first()[0] == "b"
    assert report.applied_aliases == {"预算区间_备用": "预算区间"}


def test_names():
    assert ct.normal_name("客户ID(店端)") == "客户ID_店端"
    assert ct.normal_name("（甲）/乙") == "甲_乙"
    assert ct.changed_names(["a", "b(c)"]) == {"b(c)": "b_c"}


def test_exclusions():
    out = ct.excluded_columns("试驾标签_14天")
    assert "试驾标签_7天" in out and "试驾标签_14天" not in out and "线索唯一ID" in out and "提及试驾" in out
    assert ct.sibling_labels("线索评级结果") == ["label_OHAB"]
    assert "p" in ct.feature_columns(["p", "线索唯一ID", "试驾标签_14天"], "试驾标签_14天")


def test_training_projection_never_keeps_siblings(make):
    df = make([(1, 0, 1, 5)], "`试驾标签_7天` int, `试驾标签_14天` int, `线索唯一ID` int, f int")
    assert ct.training_projection(df, "试驾标签_14天").columns == ["试驾标签_14天", "f"]
    assert ct.remaining_leaks(df.columns, "试驾标签_14天") == ["试驾标签_7天"]
    twin = make([("H",)], "`线索评级结果` string")
    assert ct.resolve_target(twin, "线索评级_试驾前") == "线索评级结果"


def test_alignment(make):
    df = make([(1, 2, 3)], "a int, b int, c int")
    assert ct.align_to_features(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="lacks"):
        ct.align_to_features(df, ["x", "a"])
    with pytest.raises(ValueError, match="label"):
        ct.align_to_features(df, ["a"], "y")
    with pytest.raises(ValueError):
        ct.require_columns(df, v.REQUIRED_COLUMNS)


def screening_rows(make):
    schema = ("`线索唯一ID` string, `线索评级_试驾前` string, `一级渠道名称` string, `所在城市` string, `预算区间` string, `SOP开口标签` string, "
              "`客户是否主动询问购车权益` string, `跟进内容_备用` int, `常数字段` int")
    return make([("1", "H", "a", "x", None, None, "是", 1, 7), ("2", "A", "b", "y", None, None, None, 2, 7),
                 ("3", "B", "a", "z", None, None, None, 3, 7), ("4", "H", "c", "x", None, None, None, 4, 7)], schema)


def test_screening_and_replay(make):
    df = screening_rows(make)
    out, report = ct.screen_all(df, "线索评级_试驾前")
    for gone in ("预算区间", "SOP开口标签", "跟进内容_备用", "常数字段"):
        assert gone not in out.columns
    assert "客户是否主动询问购车权益_缺失" in out.columns
    assert report["dropped_high_missing"] == ["SOP开口标签", "预算区间"]
    assert ct.replay_screening(df, report).columns == out.columns
    flat = {k: report[k] for k in ("dropped_high_missing", "dropped_constant", "dropped_weak_semantic", "added_missing_indicators")}
    assert ct.replay_screening(df, flat).columns == out.columns


def test_behaviour_features_match_brute_force(make):
    log = [("1", "2026-01-01", "testDriveX"), ("1", "2026-01-03", "看试驾"), ("1", "2026-01-02", "submitOrder"), ("1", "2026-01-02", None),
           ("2", "2026-01-05", "去下单再支付"), (None, "2026-01-09", "page")]
    df = make(log, "`dmp_手机号` string, `dmp_事件时间` string, `dmp_事件名称` string")
    got = {r[0]: tuple(r)[1:] for r in bh.behavior_features(df).collect()}
    assert got == {"1": (4, "2026-01-03", 2, 1, 3), "2": (1, "2026-01-05", 0, 1, 1), None: (1, "2026-01-09", 0, 0, 1)}
    leads = make([(1, "1"), (2, None), (3, "9")], "id int, `手机号_脱敏` string")
    merged = {r["id"]: r["dmp_行为次数"] for r in bh.merge_leads(leads, df).collect()}
    assert merged == {1: 4, 2: None, 3: None}
    stats = bh.match_statistics(bh.merge_leads(leads, df)).first()
    assert (stats["total"], stats["matched"], round(stats["match_rate"], 4)) == (3, 1, 0.3333)


def test_phone_column_and_parts(make):
    assert bh.find_phone_column(["a", "客户手机", "phone"]) == "客户手机"
    assert bh.find_phone_column(["a"]) == "手机号（脱敏）"
    part = lambda x: make([(x,)], "a int")
    both = bh.union_parts({"p1": part(1), "Query": part(2), "p2": part(3), "p3": part(4)})
    assert sorted(r.a for r in both.collect()) == [1, 3, 4]
    first = bh.union_parts({"p1": part(1), "Query": part(2), "p2": part(3), "p3": part(4)}, first=2)
    assert sorted(r.a for r in first.collect()) == [1, 3]


def test_cleaning_chain(make):
    rows = [(i % 7, 1, None if i % 3 else 2, "c" if i else None, float(i % 7) if i % 7 else 500.0) for i in range(40)]
    df = make(rows, "k int, same int, empty int, almost string, x double")
    out, log = cg.clean(df)
    assert log.dropped_columns == [{"column": "empty", "reason": "high_missing"}, {"column": "same", "reason": "constant"}]
    assert "almost" in out.columns and out.count() == log.rows_after == 8 and log.dropped_rows == 32
    assert log.outliers == {"x": 2} or log.outliers == {"x": 1}
    untouched, quiet = cg.clean(df, missing=False, constant=False, duplicates=False, outliers=False, skew=False, cardinality=False)
    assert untouched.columns == df.columns and quiet.dropped_rows == 0


def test_outliers_use_interpolated_quartiles(make):
    import numpy as np

    values = [1.0, 2.0, 2.5, 3.0, 7.0, 100.0, -50.0, 4.0]
    df = make([(x,) for x in values], "x double")
    q1, q3 = np.percentile(values, [25, 75])
    row = cg.outliers_iqr(df).first()
    assert row["lower"] == pytest.approx(q1 - 1.5 * (q3 - q1)) and row["upper"] == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert row["outliers"] == sum(x < row["lower"] or x > row["upper"] for x in values)
    z = abs((np.array(values) - np.mean(values)) / np.std(values)) > 1.5
    assert cg.outliers_zscore(df).first()["outliers"] == z.sum()
    assert cg.outliers_zscore(make([(1.0,), (1.0,)], "x double")).count() == 0


def test_skew_and_cardinality(make):
    df = make([(float(i) ** 4, str(i), "a" if i else None) for i in range(120)], "x double, many string, few string")
    assert [(r["column"], r["suggestion"]) for r in cg.skewed_columns(df).collect()] == [("x", "log")]
    assert [(r["column"], r["distinct_values"]) for r in cg.high_cardinality(df).collect()] == [("many", 120)]
    assert cg.skewed_columns(df.limit(5)).count() == 0


def test_duplicates_are_counted_exactly(make):
    df = make([(1, None), (1, None), (1, None), (2, "a"), (3, "a"), (3, "a")], "a int, b string")
    assert tuple(pf.duplicate_summary(df).first()) == (6, 2, 3)
    assert tuple(pf.duplicate_summary(df.limit(0)).first()) == (0, 2, 0)


def test_suggestions_and_target(make):
    df = make([("H" if i < 95 else "A", None if i % 2 else "v", 1, str(i)) for i in range(110)], "`评级` string, half string, same int, many string")
    found = {r["rule"]: r["n"] for r in pf.cleaning_suggestions(df).collect()}
    assert found == {"medium_missing": 1, "constant": 2, "high_cardinality": 1}
    target = pf.target_summary(df).first()
    assert target["target"] == "评级" and target["imbalance_ratio"] == 6.33 and target["is_imbalanced"] is False
    assert pf.find_target(["x", "My_Label"]) == "My_Label" and pf.find_target(["x"]) is None


def test_top_values_and_full_profile(make):
    df = make([("a",)] * 3 + [("b",)] * 3 + [("c",)] + [(None,)] * 9, "t string")
    top = pf.top_values(df, k=2).orderBy("position").collect()
    assert [(r["value"], r["n"]) for r in top] == [("a", 3), ("b", 3)]
    sections = {r["section"] for r in pf.full_profile(df).collect()}
    assert sections == {"basic", "missing", "columns", "top_values"}
    assert pf.quality_report(df).where(F.col("kind") == "missing_count").first()["value"] == 9.0
