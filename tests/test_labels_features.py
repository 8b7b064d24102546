from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import labels as lb
from showroom.operators import features as ft, policy as po


def lead(created, arrived=None, driven=None, ordered=None):
    return (created, arrived, driven, ordered)


SCHEMA = "`线索创建时间` string, `到店时间` string, `试驾时间` string, `下订时间` string"


def test_fractional_windows_have_a_lower_bound(make):
    rows = [
        lead("2026-03-01 12:00:00", driven="2026-03-08 12:00:00"),
        lead("2026-03-01 12:00:00", driven="2026-03-08 12:00:01"),
        lead("2026-03-01 12:00:00", driven="2026-02-20 00:00:00"),
        lead("2026-03-01 12:00:00"),
        lead("bad", driven="2026-03-02 00:00:00"),
    ]
    out = lb.window_labels(make(rows, SCHEMA)).select("试驾标签_7天", "试驾标签_14天", "到店标签_7天").collect()
    assert [tuple(r) for r in out] == [(1, 1, 0), (0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_date_labels_differ_on_negative_days(make):
    rows = [
        lead("2026-03-10 23:00:00", driven="2026-03-01", ordered="2026-02-01"),
        lead("2026-03-01 23:00:00", driven="2026-03-09", ordered="2026-03-16"),
        lead("2026-03-01 23:00:00", driven="2026-04-09", ordered="2026-04-09"),
        lead("2026-03-01 00:00:00"),
    ]
    df = make(rows, SCHEMA)
    drive = lb.drive_date_labels(df).select("label_7天内试驾", "label_14天内试驾", "label_OHAB").collect()
    assert [tuple(r) for r in drive] == [(1, 1, "H"), (0, 1, "A"), (0, 0, "O"), (0, 0, "N")]
    order = lb.order_date_labels(df).select("下订标签_7天", "下订天数差").collect()
    assert [tuple(r) for r in order] == [(0, -28), (1, 7), (1, 0), (0, None)]


def test_outcomes_and_order_after_drive(make):
    df = make([("H", "2026-01-01", "2026-01-08"), (None, None, "2026-01-02"), ("O", "2026-01-01", None)],
              "`线索评级结果` string, `试驾时间` string, `下订时间` string")
    out = lb.order_after_drive_labels(lb.outcome_labels(df))
    got = out.select("线索评级_试驾前", "成交标签", "下订标签_7天", "试驾后下订天数差").collect()
    assert [tuple(r) for r in got] == [("H", 1, 1, 7.0), ("Unknown", 1, 0, None), ("O", 0, 0, None)]


def test_creation_features(make):
    out = lb.creation_time_features(make([("2026-03-01 00:10:03",), ("x",)], "`线索创建时间` string"))
    assert [tuple(r)[1:] for r in out.collect()] == [(7, 0), (None, None)]


def test_response_bands(make):
    hours = [-5.0, -1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 4.0, 24.0, 24.1, None]
    out = make([(h,) for h in hours], "h double").select(ft.response_band(F.col("h")).alias("b")).collect()
    assert [r.b for r in out] == ["nan", "nan", "未知", "未知", "即时", "即时", "快速", "快速", "正常", "延迟", "nan"]


def interaction_rows(make):
    schema = ("`线索创建时间` string, `首触时间` string, `一级渠道名称` string, `二级渠道名称` string, `所在城市` string, `首触意向车型` string, "
              "`通话次数` int, `通话总时长` int, `平均通话时长` double, `非首触跟进记录` string")
    train = make([
        ("2026-03-01 00:00:00", "2026-03-01 01:00:00", "A", "a", "上海", "车1", 2, 120, 999.0, '{"items":[1]}'),
        ("2026-03-01 00:00:00", None, "A", None, "上海", "车1", 0, 0, 999.0, ""),
        ("2026-03-01 00:00:00", "2026-03-02 01:00:00", None, "b", "北京", None, 1, 61, 999.0, "{}"),
    ], schema)
    new = make([("2026-03-01 00:00:00", "x", "A", "a", "上海", "车1", 1, 60, 999.0, "[]"),
                ("2026-03-01 00:00:00", "x", "A", "a", "广州", "车1", None, 60, 999.0, None)], schema)
    return train, new


def test_fitted_features_are_replayed(make):
    train, new = interaction_rows(make)
    fitted, heat = ft.fit_transform(train)
    rows = fitted.orderBy(F.desc("通话次数")).collect()
    assert sorted(r["城市车型热度"] for r in rows) == [1, 2, 2]
    first = rows[0]
    assert (first["平均通话时长"], first["平均通话时长_派生"], first["有效通话"], first["JSON跟进明细可用"]) == (999.0, 60.0, 1, 1)
    assert {r["渠道组合"] for r in rows} == {"A_a", "A_未知", "未知_b"}
    assert sorted(r["有效通话"] for r in rows) == [0, 1, 1] and sum(r["JSON跟进明细可用"] for r in rows) == 1
    scored = {r["所在城市"]: r for r in ft.transform(new, heat).collect()}
    assert (scored["上海"]["城市车型热度"], scored["广州"]["城市车型热度"]) == (2, 0)
    assert scored["广州"]["平均通话时长_派生"] == 0.0 and scored["上海"]["响应及时性"] == "nan"
    assert scored["上海"]["有效通话"] == 0


def test_semantic_columns(make):
    df = make([("是", " 是 "), ("", None), ("否", "")], "`客户是否同意加微信` string, `客户是否主动询问购车权益` string")
    out = df.select(*[c.alias(n) for n, c in ft.interaction_columns(df).items()]).collect()
    assert [(r["AI语义标签可用"], r["语义标签命中数"]) for r in out] == [(1, 2), (0, 0), (1, 0)]


def test_time_parts_and_numbers(make):
    df = make([("2026-03-01 05:00:00", "1.5"), (None, "x")], "`首触时间` string, `通话次数` string")
    out = ft.numbers(ft.time_parts(df)).collect()
    assert [(r["首触时间_day_of_week"], r["首触时间_hour"], r["首触时间_is_weekend"], r["通话次数"]) for r in out] == [
        (6, 5, 1, 1.5), (None, None, 0, None)]


def test_label_policy(make):
    rows = [("O",)] + [("H",)] * 3 + [("A",)] * 2 + [("B",)] + [(None,)]
    df = make(rows, "t string")
    rule = po.build_policy(df, "t", o_merge_threshold=2)
    assert rule["merged"] and rule["mapping"] == {"O": "H"} and rule["effective_classes"] == ["H", "A", "B"]
    assert po.apply_policy(df, "t", rule).where("t = 'H'").count() == 4
    hab = po.build_policy(df, "t", mode="hab")
    assert hab["effective_classes"] == ["H", "A", "B"] and hab["excluded_classes"] == ["O"]
    assert po.keep_effective(df, "t", hab).count() == 6
    assert not po.build_policy(df, "t", o_merge_threshold=1)["merged"]
    assert po.stage_two_rows(df, "t").count() == 4
    assert df.select(po.stage_one_label(F.col("t")).alias("s")).distinct().count() == 2


def test_typed_times_need_no_parsing(make):
    df = make([(dt(2026, 3, 1), dt(2026, 3, 3, 12))], "`线索创建时间` timestamp, `试驾时间` timestamp_ntz")
    assert lb.window_labels(df).first()["试驾标签_7天"] == 1
    assert v.CREATED in df.columns


@pytest.mark.parametrize("n", [7, 14, 21, 30])
def test_absent_columns_give_zero(make, n):
    assert lb.window_labels(make([("2026-03-01",)], "`线索创建时间` string")).first()[f"试驾标签_{n}天"] == 0
