import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions import actions as ac, masks, ratings as rt, scorecard as sc, status
from showroom.operators import deidentify as di


def one(make, value, expression):
    return make([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("mask, value, expected", [
    (masks.mask_phone_cell, "13812345678", "138****5678"), (masks.mask_phone_cell, "123", "123"), (masks.mask_phone_cell, None, None),
    (masks.mask_phones_in_text, "a13812345678b", "a138****5678b"), (masks.mask_phones_in_text, "12812345678", "12812345678"),
    (masks.hide_phones_in_text, "a13812345678b", "a手机***********b"),
    (masks.mask_id, "CUST12", "CU**12"), (masks.mask_id, "1234", "****"), (masks.mask_id, None, None),
    (lambda c: masks.mask_id(c, True), None, "****"),
    (masks.mask_dealer, "D12345", "D1****45"), (masks.mask_dealer, "D1", "****"),
    (masks.mask_id_card_cell, "110101199003071234", "1101**********1234"), (masks.mask_id_card_cell, "12", "12"),
    (masks.mask_id_cards_in_text, "证110101199003071234完", "证110101********1234完"),
    (masks.mask_id_cards_in_text, "证11010119900307123X完", "证110101********123X完"),
    (masks.mask_id_cards_in_text, "证110101900307123完", "证110101********7123完"),
    (masks.hide_plates, "车粤B12345来", "车车牌***来"),
    (masks.replace_brands, "广汽本地与广汽丰田与广汽", "区域A与品牌A与集团A"), (masks.replace_brands, None, None),
    (masks.replace_cars, "铂智3X铂智YARiS L", "车型A车型X车型K"),
])
def test_masks(make, mask, value, expected):
    assert one(make, value, mask) == expected


def test_whole_table_plan(make):
    df = make([("C12345", "13812345678", 13812345678, "x13812345678 110101199003071234 雷凌", "广汽丰田", "k")],
              "`客户ID` string, `手机号_脱敏` string, phone bigint, `首触跟进记录` string, `一级渠道名称` string, `其他` string")
    out, touched = di.deidentify(df)
    assert tuple(out.first()) == ("C1**45", "138****5678", "138****5678", "x138****5678 110101********1234 车型C", "品牌A", "k")
    assert touched == ["客户ID", "手机号_脱敏", "phone", "首触跟进记录", "一级渠道名称"]


def test_pseudonyms_run_past_z(make):
    cities = [f"c{i:04d}" for i in range(800)]
    codes = {r["value"]: r["code"] for r in di.pseudonyms(make([(c,) for c in cities], "`所在城市` string"), ["所在城市"], "城市").collect()}
    assert [codes[cities[i]] for i in (0, 25, 26, 51, 52, 701, 702)] == [
        "城市A", "城市Z", "城市AA", "城市AZ", "城市BA", "城市ZZ", "城市AAA"]
    assert len(set(codes.values())) == 800
    out, _ = di.deidentify_order_stage(make([("b", "a", "D12345"), (None, "b", "D")], "`所在城市` string, `市名称` string, `经销店代码` string"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("城市B", "城市A", "D1****45"), (None, "城市B", "****")], key=str)


def test_status_predicates(make):
    df = make([
        (None, 0, "已下单", None, None, "13800000000", None, "普通"),
        ("2026-01-01", 0, None, None, None, "13800000000", "价格", None),
        (None, 1, None, "支付成功", "客户已试驾", "", "竞品", None),
        (None, None, "", "未支付", "无", "00000000000", None, "重复线索"),
        (None, 0, None, None, None, "1380000", None, None),
    ], "`下订时间` string, `成交标签` int, `下定状态` string, `意向金支付状态` string, `试驾状态` string, phone string, `战败原因` string, `线索类型` string")
    out = df.select(status.is_ordered(df), status.is_driven(df), status.is_invalid(df)).collect()
    assert [tuple(r) for r in out] == [
        (True, False, False), (True, False, False), (True, True, True), (False, False, True), (False, False, True)]
    bare = make([(1,)], "x int")
    assert tuple(bare.select(status.is_ordered(bare), status.is_driven(bare), status.is_invalid(bare)).first()) == (False, False, False)


P = "`p7` double, `p14` double, `p21` double, `下订时间` string, `试驾时间` string, phone string"


def rate(make, rows, mode):
    p = {7: F.col("p7"), 14: F.col("p14"), 21: F.col("p21")}
    back = {7: F.col("p21"), 14: F.col("p14"), 21: F.col("p7")}
    out = rt.add_rating(make(rows, P), mode, p, back)
    return [(r["评级"], r["阶段"], r["分值"]) for r in out.collect()]


OK_PHONE = "13800000000"


def test_rating_modes(make):
    rows = [(0.9, 0.1, 0.1, None, None, OK_PHONE), (0.1, 0.35, 0.9, None, "t", OK_PHONE), (0.2, 0.2, 0.6, "t", "t", None),
            (0.2, 0.0, 0.1, None, None, None), (0.0, 0.0, 0.0, None, None, OK_PHONE)]
    assert [x[0] for x in rate(make, rows, "simple")] == ["C", "A", "O", "N", "C"]
    medium = rate(make, rows, "medium")
    assert [x[0] for x in medium] == ["H", "B", "O", "N", "C"]
    assert [x[2] for x in medium] == [pytest.approx(52.11), pytest.approx(30.53), 100.0, 0.0, pytest.approx(15.79)]
    advanced = rate(make, rows, "advanced")
    assert [x[:2] for x in advanced] == [("H", "试驾前"), ("H", "试驾后"), ("O", "O"), ("N", "无效"), ("C", "试驾前")]
    with pytest.raises(ValueError):
        rt.add_rating(make(rows, P), "medium", {14: F.col("p14")})
    with pytest.raises(ValueError):
        rt.add_rating(make(rows, P), "other", {})


def test_score_default_is_a_parameter(make):
    df = make([("C", 0.0)], "r string, p double")
    z = F.col("p")
    assert df.select(rt.score(F.col("r"), z, z, z), rt.score(F.col("r"), z, z, z, default_p14=0.0)).first()[:] == (15.79, 0.0)


def test_hab_columns_and_engine(make):
    df = make([(0.6, 0.7, 0.8), (0.4, 0.55, 0.6), (0.1, 0.2, 0.5), (0.1, 0.2, 0.3)], "a double, b double, c double")
    rows = df.select(*[x.alias(n) for n, x in rt.hab_columns(F.col("a"), F.col("b"), F.col("c")).items()]).collect()
    assert [(r["rating"], r["confidence"], r["next_contact_days"]) for r in rows] == [("H", 0.8, 3), ("A", 0.6, 7), ("B", 0.5, 14), ("N", 0.3, None)]
    assert rows[1]["explanation"] == "中意向，14天内计划试驾（P(14天试驾)=55.00%，P(7天试驾)=40.00%）"
    assert rows[3]["explanation"].endswith("阈值50%）")
    engine = make([(0.6, 0.1, 0.1), (0.2, 0.5, 0.1), (0.2, 0.1, 0.35), (0.2, 0.1, 0.1)], "h double, a double, b double")
    got = engine.select(rt.engine_columns(F.col("h"), F.col("a"), F.col("b"))["rating"].alias("r")).collect()
    assert [r.r for r in got] == ["H", "A", "B", "N"]


def test_factors(make):
    pairs = [("a", 0.5), ("b", -0.4), ("c", 0.3), ("d", 0.2), ("e", -0.1), ("f", -0.05)]
    df = make([([{"name": n, "value": x} for n, x in pairs],)], "c array<struct<name:string,value:double>>")
    out = df.select(*[x.alias(n) for n, x in rt.factor_lists(F.col("c")).items()]).first()
    assert out["positive_factors"] == ["a: 50.00%", "c: 30.00%"] and out["risk_factors"] == ["b: -40.00%", "e: -10.00%"]


def test_combine_and_policy(make):
    df = make([(0.7, 0.5, 0.5), (0.2, 0.6, 0.4), (0.05, 0.4, 0.6)], "h double, a double, b double")
    out = df.select(*[x.alias(n) for n, x in rt.combine_stages(F.col("h"), F.col("a"), F.col("b"), 0.5).items()]).collect()
    assert [r[v.PREDICTED] for r in out] == ["H", "A", "B"]
    assert out[2]["p_B"] == pytest.approx(0.57) and out[2]["p_A"] == pytest.approx(0.38)
    p = {"H": F.col("h"), "B": F.col("b")}
    rule = {"strategy": "hab_threshold", "h_threshold": 0.9, "b_threshold": 0.9}
    assert [r[0] for r in df.select(rt.apply_policy(p, rule)).collect()] == ["H", "B", "B"]


CARD = ("`一级渠道名称` string, `首触意向车型` string, `所在城市` string, `预算区间` string, `线索类型` string, `客户性别` string, `历史订单次数` int, `历史到店次数` int, "
        "`历史试驾次数` int, `通话次数` int, `通话总时长` int, `平均通话时长_派生` double, `是否接通` int, `有效通话` int, `跟进总次数` int, `接通次数` int, "
        "`首触响应时长_小时` double, `首触线索是否及时外呼` int, `首触线索当天是否联通实体卡外呼` int, `客户是否主动询问交车时间` string, `提及试驾` boolean, "
        "`客户是否主动询问购车权益` string, `客户是否主动询问金融政策` string, `客户是否同意加微信` string")


def test_scorecard(make):
    strong = ("x", "车", "市", "10", "t", "男", 1, 1, 1, 4, 900, 300.0, 1, 1, 3, 2, 0.0, 1, 1, "是", True, "是", "是", "有")
    weak = (None, "", None, None, None, None, 0, 0, 0, 0, 0, 0.0, 0, 0, 0, 0, 100.0, 0, 0, "否", False, None, "", "否")
    rows = sc.add_scorecard(make([strong, weak], CARD)).collect()
    assert [r[v.PREDICTED] for r in rows] == ["H", "B"]
    assert rows[0]["基础特征得分"] == 100.0 and rows[0]["画像特征得分"] == 100.0 and rows[0]["行为特征得分"] == 100.0
    assert rows[0]["时序特征得分"] == 85.0 and rows[0]["意图特征得分"] == pytest.approx(71.4286)
    assert rows[0]["总分"] == pytest.approx(20 + 10 + 25 + 17 + 17.8572, abs=1e-3)
    assert 0 < rows[0]["字段覆盖率"] <= 1
    shares = make([(82.0,), (66.0,), (42.0,)], "t double").select(*[x.alias(n) for n, x in sc.score_probabilities(F.col("t")).items()]).collect()
    assert all(sum(r) == pytest.approx(1.0) for r in shares)
    assert shares[0]["p_H"] > shares[0]["p_A"] > shares[0]["p_B"] and shares[2]["p_B"] > shares[2]["p_A"] > shares[2]["p_H"]


def test_missing_response_time_counts_as_fast(make):
    df = make([(None,), (72.0,), (36.0,)], "`首触响应时长_小时` double")
    assert [r["时序特征得分"] for r in sc.add_scorecard(df).collect()] == [45.0, 0.0, 22.5]


def test_actions(make):
    df = make([("L1", 1, "是", 1, "H", None), ("L2", None, None, 0, "B", 3), ("L3", None, None, 1, "A", None)],
              "`线索唯一ID` string, `提及试驾` int, `客户是否主动询问金融政策` string, `有效通话` int, `预测标签` string, `通话次数` int")
    rows = ac.lead_actions(df, probabilities={"H": F.lit(0.8)}).collect()
    assert rows[0]["预测HAB"] == "H" and rows[0]["等级说明"] == "高意向" and rows[0]["建议SOP"].startswith("24小时内")
    assert rows[0]["原因1"] == v.REASON_PHRASES["提及试驾"] and rows[0]["原因3"] == v.REASON_PHRASES["有效通话"]
    assert rows[1]["原因1"] == v.REASON_PHRASES["通话次数"] and rows[1]["原因2"] == ""
    assert rows[0]["概率_H"] == 0.8 and rows[0]["概率_B"] == 0.0
    fallback = make([("L", "X"), ("M", "A")], "`线索唯一ID` string, `预测标签` string")
    out = ac.lead_actions(fallback).collect()
    assert [r["原因1"] for r in out] == [v.REASON_FALLBACK_OTHER, v.REASON_FALLBACK["A"]]
    assert out[0]["等级说明"] == "X" and out[0]["建议SOP"] == v.SOP_OTHER


def test_bad_signals_come_first_for_b(make):
    df = make([("L", "是", True, "B")], "`线索唯一ID` string, `客户是否同意加微信` string, `最终战败` boolean, `预测标签` string")
    row = ac.lead_actions(df).first()
    assert (row["原因1"], row["原因2"]) == (v.REASON_PHRASES["最终战败"], v.REASON_PHRASES["客户是否同意加微信"])
