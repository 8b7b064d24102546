import json

import pytest
from pyspark.sql import functions as F

from showroom.functions.followups import FEATURES, add_followup_features, collision_safe_names


def features(make, cells):
    df = make([(i, c) for i, c in enumerate(cells)], "i int, `非首触跟进记录` string")
    return [r.asDict() for r in add_followup_features(df).orderBy("i").collect()]


def record(level=None, call=None, result=None, duration=None, memo=None):
    names = ("意向级别", "通话结果", "跟进结果", "通话时长(分:秒)", "跟进备忘")
    return {n: x for n, x in zip(names, (level, call, result, duration, memo)) if x is not None}


def cell(*records):
    return json.dumps(list(records), ensure_ascii=False)


@pytest.mark.parametrize("text", [None, "", "not json", "{}", "[]", "[1]", "[null]", " "])
def test_nothing_to_read_gives_defaults(make, text):
    row = features(make, [text])[0]
    assert [row[f] for f in FEATURES] == [0, 0, 0, 0.0, 0, False, False, False, False, False, False, 0.0, 0]


def test_lone_object_is_one_record(make):
    row = features(make, [json.dumps(record("H", "已接通", "继续"), ensure_ascii=False)])[0]
    assert (row["跟进总次数"], row["接通次数"], row["继续跟进次数"]) == (1, 1, 1)


def test_several_records(make):
    row = features(make, [cell(record("H", "已接通", "继续"), record("A", "未接通", "继续"), record("B", "已接通", "战败"))])[0]
    assert (row["跟进总次数"], row["接通次数"], row["未接通次数"]) == (3, 2, 1)
    assert row["接通率"] == pytest.approx(2 / 3)
    assert row["最终战败"] and row["意向级别下降"]


@pytest.mark.parametrize("levels, dropped", [
    ("BAH", False), ("OH", True), ("H", False), ("HXB", True), (["H", "", None, "B"], True), ("XB", False), ("HX", False)])
def test_level_drop(make, levels, dropped):
    assert features(make, [cell(*[record(x) for x in levels])])[0]["意向级别下降"] is dropped


def test_durations(make):
    rows = features(make, [
        cell(*[record(duration=d) for d in ("2:30", "1:45", "0:30")]),
        cell(record(duration=""), {"通话时长(分:秒)": None}),
        cell(*[record(duration=d) for d in ("1:2:3", "x:1", "5", " 1 : 1 ", "0:00")]),
    ])
    assert [(r["平均通话时长_秒"], r["最长通话时长_秒"]) for r in rows] == [(95.0, 150), (0.0, 0), (30.5, 61)]


def test_memo_words(make):
    rows = features(make, [cell(*[record(memo=m) for m in ("问价格", "下周来店", "想试驾", "对比比亚迪")]), cell(record(memo="随便看看"))])
    names = ["提及价格", "提及试驾", "提及到店", "提及竞品"]
    assert [[r[n] for n in names] for r in rows] == [[True] * 4, [False] * 4]


def test_collisions_and_dropping(make):
    assert collision_safe_names(["a", "b", "b_json"], ["a", "b", "c"]) == {"a": "a_json", "c": "c"}
    df = make([(1, "[]")], "`跟进总次数` int, x string")
    out = add_followup_features(df, "x", drop_source=True)
    assert "x" not in out.columns and "跟进总次数_json" in out.columns
    assert add_followup_features(df, "absent").columns == df.columns


def test_text_is_parsed_once(make):
    plan = add_followup_features(make([("[]",)], "`非首触跟进记录` string").select(
        F.upper("非首触跟进记录").alias("非首触跟进记录")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
