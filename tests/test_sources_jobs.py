import pytest
from pyspark.sql import functions as F

from showroom import vocab as v
from showroom.functions.labels import target_labels
from showroom.operators import splits as sp
from showroom.plans import data_job, scoring, training as tr, validation
from showroom.sources import readers as rd, stores as st, writers as wr


def export_line(i, rating="H", fields=46, drive="2026-03-06 10:00:00", detail="{}"):
    known = {
        "线索唯一ID": f"DIS{i}", "手机号_脱敏": "13800000000", "线索创建时间": "2026-03-01 00:10:03", "一级渠道名称": "渠道1", "所在城市": "上海市",
        "首触意向车型": "车型A", "通话次数": "2", "通话总时长": "120", "首触时间": "2026-03-01 00:40:00", "线索评级结果": rating,
        "到店时间": "2026-03-05 10:00:00", "试驾时间": drive, "下订时间": "2026-03-07 10:00:00", "非首触跟进记录": detail, "历史试驾次数": "1"}
    cells = [known.get(c, "") for c in v.LEAD_EXPORT_COLUMNS][:fields]
    return "\t".join(cells + ["x"] * (fields - len(cells)))


@pytest.fixture
def export(tmp_path):
    path = tmp_path / "leads.txt"
    path.write_text("\n".join([export_line(1), export_line(2, "O", detail='[{"意向级别":"H"},{"意向级别":"B"}]')]) + "\n", encoding="utf-8")
    return str(path)


def test_load_and_adapt(spark, export):
    assert rd.detect_format(spark, export) == rd.Format("headerless", "\t")
    df, info = rd.load_leads(spark, export)
    rows = {r[v.LEAD_ID]: r for r in df.collect()}
    assert set(rows) == {"DIS1", "DIS2"} and rows["DIS2"]["线索评级_试驾前"] == "O"
    assert rows["DIS1"]["首触跟进记录"] is None
    assert (rows["DIS1"]["试驾标签_7天"], rows["DIS1"]["到店标签_7天"], rows["DIS1"]["下订标签_7天"]) == (1, 1, 1)
    assert (rows["DIS1"]["线索创建星期几"], rows["DIS1"]["线索创建小时"]) == (7, 0)
    assert rows["DIS2"]["意向级别下降"] and rows["DIS1"]["跟进总次数"] == 0
    assert info["json_extraction_status"] == "success" and info["schema_contract"]["version"] == "v2"


@pytest.mark.parametrize("fields", [44, 46, 48])
def test_field_count_follows_the_first_line(spark, tmp_path, fields):
    path = tmp_path / "leads.txt"
    path.write_text("\n".join([export_line(1, fields=fields), export_line(2, fields=fields), "DIS3\tshort", export_line(4, fields=fields) + "\tmore"]) + "\n", encoding="utf-8")
    df = rd.read_lead_export(spark, str(path))
    assert len(df.columns) == fields and df.count() == 3
    assert {r[0] for r in df.select(v.LEAD_ID).collect()} == {"DIS1", "DIS2", "DIS3"}
    assert df.where(f"`{v.CREATED}` IS NULL").select(v.LEAD_ID).collect()[0][0] == "DIS3"
    assert df.columns[46:] == [f"_未命名列_{i}" for i in range(fields - 46)]


def test_formats_and_separators(spark, tmp_path):
    csv = tmp_path / "a.csv"
    csv.write_text("线索唯一ID,线索创建时间\n1,2026-01-01\n2,\n", encoding="utf-8")
    assert rd.detect_format(spark, str(csv)) == rd.Format("header", ",")
    assert [tuple(r) for r in rd.read_table(spark, str(csv)).collect()] == [("1", "2026-01-01"), ("2", None)]
    text = tmp_path / "b.txt"
    text.write_text("a\tb,c\n1\t2\n", encoding="utf-8")
    assert rd.infer_separator(spark, str(text)) == "\t" and rd.infer_separator(spark, "x.tsv") == "\t"
    assert rd.separator_by_count("a,b\tc,d") == ","
    assert rd.detect_format(spark, "x/y.parquet").kind == "parquet"
    with pytest.raises(ValueError):
        rd.load_leads(spark, " ")
    with pytest.raises(ValueError, match="required"):
        rd.adapt(rd.read_header(spark, str(text), "\t"))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "x|y", "z")], "i int, t string, n string")
    for codec in wr.CODECS:
        wr.write_parquet(df, str(tmp_path / codec), codec)
        assert spark.read.parquet(str(tmp_path / codec)).count() == 2
    with pytest.raises(ValueError):
        wr.write_parquet(df, str(tmp_path / "bad"), "nope")
    for name in wr.DELIMITERS:
        wr.parquet_to_delimited(spark, str(tmp_path / "zstd"), str(tmp_path / f"text-{name}"), delimiter=name, columns=["t", "i"])
        back = rd.read_header(spark, str(tmp_path / f"text-{name}"), wr.DELIMITERS[name])
        assert {tuple(r) for r in back.collect()} == {('a "b", c', "1"), ("x|y", "2")}
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("x,y\n1,2\nbad\n3,4\n")
    (source / "b.tsv").write_text("x\ty\n1\t2\n")
    (source / "c.bin").write_text("no")
    done = wr.convert_folder(spark, str(source), str(tmp_path / "out"))
    assert sorted((p.rsplit("/", 1)[-1], r["columns"]) for p, r in done.items()) == [("a.csv", 2), ("b.tsv", 2)]
    assert spark.read.parquet(str(tmp_path / "out" / "b.tsv.parquet")).count() == 1


def test_equal_names_in_folders_keep_their_rows(spark, tmp_path):
    rows = {"x.csv": 1, "x.tsv": 2, "a/x.csv": 3, "b/x.csv": 4}
    for name, n in rows.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        sep = "," if name.endswith("csv") else "\t"
        path.write_text("".join(sep.join(line) + "\n" for line in ["uv"] + ["12"] * n))
    done = wr.convert_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(r["rows"] for r in done.values()) == [1, 2, 3, 4]
    assert {name: spark.read.parquet(str(tmp_path / "out" / f"{name}.parquet")).count() for name in rows} == rows


def test_bad_lines_are_dropped(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("x,y\n1,2\n5,6,7\n3,4\nshort\n")
    assert wr.text_to_parquet(spark, str(path), str(tmp_path / "o"))["rows"] == 3
    assert wr.text_to_parquet(spark, str(path), str(tmp_path / "p"), header=False, columns=["a"], separator=",")["rows"] == 1
    with pytest.raises(ValueError):
        wr.text_to_parquet(spark, str(path), str(tmp_path / "q"), header=False)


def test_behaviour_log(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text("013800\t2026-01-01 10:00:00.123456\ttestDrive\tc\tb\tp\t1\tch\tk\tu\tios\n", encoding="utf-8")
    row = rd.read_behavior_log(spark, str(path)).first()
    assert row["dmp_手机号"] == "013800" and row["dmp_事件时间"].microsecond == 123456


def key(spark, path, **change):
    settings = dict(target_label="t", schema_version="v2", split_mode="auto", split_group_mode="phone", label_mode="hab", feature_profile="f", random_seed=1)
    return st.prep_key(spark, path, **{**settings, **change})


def test_prepared_store(spark, tmp_path):
    data = tmp_path / "d"
    wr.write_parquet(spark.range(5), str(data))
    one = key(spark, str(data))
    assert len(one) == 24 and one == key(spark, str(data)) and one != key(spark, str(data), random_seed=2) and one != key(spark, str(data), target_label="u")
    store = st.PrepStore(spark, str(tmp_path / "store"))
    assert store.load(one) is None
    store.save(one, {p: spark.range(n) for p, n in (("train", 3), ("valid", 2), ("test", 1))}, {"a": "甲"})
    found = store.load(one)
    assert found["metadata"] == {"a": "甲"} and found["train"].count() == 3
    wr.write_parquet(spark.range(6), str(data))
    assert key(spark, str(data)) != one


def modelled(spark, n=400):
    i = F.col("id")
    start = F.lit("2026-01-01").cast("timestamp")
    hour = lambda k: F.make_dt_interval(F.lit(0), (i * k % 600).cast("int"))
    df = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("L"), i).alias("线索唯一ID"), F.concat(F.lit("1380000"), F.lpad((i % 333).cast("string"), 4, "0")).alias("手机号_脱敏"),
        (start + hour(3)).alias("线索创建时间"), (start + hour(3) + F.make_dt_interval(F.lit(0), (i % 5).cast("int"))).alias("首触时间"),
        F.element_at(F.array(*[F.lit(c) for c in "HABO"]), (i % 4 + 1).cast("int")).alias("线索评级结果"),
        F.when(i % 4 == 0, "甲").when(i % 4 == 1, "乙").otherwise(F.concat(F.lit("丙"), (i % 2).cast("string"))).alias("一级渠道名称"),
        F.concat(F.lit("二"), (i % 3).cast("string")).alias("二级渠道名称"), F.concat(F.lit("城"), (i % 5).cast("string")).alias("所在城市"),
        F.concat(F.lit("车"), (i % 3).cast("string")).alias("首触意向车型"), (i % 4).cast("int").alias("通话次数"), (i % 4 * 60).alias("通话总时长"),
        F.concat(F.lit("备"), i.cast("string")).alias("预算区间"),
        F.when(i % 4 < 2, start + hour(3) + F.make_dt_interval((i % 9).cast("int"))).alias("到店时间"),
        F.when(i % 4 < 2, start + hour(3) + F.make_dt_interval((i % 25).cast("int"))).alias("试驾时间"),
        F.when(i % 12 == 0, start + hour(3) + F.make_dt_interval((i % 25 + i % 30).cast("int"))).alias("下订时间"))
    return target_labels(df)


SIZE = {"iterations": 2, "depth": 2, "trees": 3}


@pytest.fixture(scope="module")
def prep(spark):
    return tr.prepare(modelled(spark))


@pytest.fixture(scope="module")
def fitted(prep):
    return tr.train_two_stage(prep, size=SIZE), tr.train_multiclass(prep, "RandomForest", size=SIZE)


def test_preparation(prep):
    assert prep.info["split_info"]["mode"] == "oot" and prep.info["label_policy"]["effective_classes"] == ["H", "A", "B"]
    assert prep.train.columns == prep.test.columns == prep.valid.columns
    assert {r[0] for r in prep.test.select(prep.target).distinct().collect()} == {"H", "A", "B"}
    assert "城市车型热度" in prep.train.columns


def test_two_stage_and_validation(spark, prep, fitted, tmp_path):
    two, multi = fitted
    out = two.predict(prep.test)
    assert out.count() == prep.test.count() and out.where("p_H + p_A + p_B > 1.000001").count() == 0
    result = validation.validate(modelled(spark), prep.target, prep.info, prep.heat, two, multi, output=str(tmp_path / "v"))
    roles = {r["role"]: r for r in result["comparison"].collect()}
    assert set(roles) == {"two_stage", "baseline", "scorecard"} and roles["two_stage"]["accuracy"] > 0.8
    assert result["recommended"].count() == 1
    assert spark.read.parquet(str(tmp_path / "v" / "two_stage" / "lead_actions")).count() == prep.test.count()


def test_leakage_is_refused(spark, prep):
    leaky = prep.train
    with pytest.raises(ValueError, match="sibling"):
        tr.train(leaky, "试驾标签_14天", excluded=["线索唯一ID"])
    assert "提及试驾" not in tr.train(leaky, "试驾标签_14天", "LogisticRegression", size=SIZE).features


def test_model_round_trip_and_errors(spark, prep, fitted, tmp_path):
    model, rule = fitted[1]
    model.save(spark, str(tmp_path / "m"), eval_metric="f1")
    back = tr.LeadModel.load(spark, str(tmp_path / "m"))
    probabilities = lambda m: [tuple(r) for r in m.probabilities(prep.test).orderBy(v.LEAD_ID).select("p_H", "p_A", "p_B").collect()]
    assert probabilities(model) == probabilities(back)
    assert all(sum(p) == pytest.approx(1.0) for p in probabilities(back))
    with pytest.raises(ValueError, match="lacks"):
        back.probabilities(prep.test.drop("通话次数"))
    with pytest.raises(ValueError, match="classes"):
        back.class_column("X")
    with pytest.raises(FileNotFoundError):
        tr.LeadModel.load(spark, str(tmp_path / "none"))


def test_unseen_category_and_nulls(prep, fitted):
    model = fitted[1][0]
    odd = prep.test.withColumn("一级渠道名称", F.lit("新渠道")).withColumn("通话次数", F.lit(None).cast("int"))
    assert model.probabilities(odd).where("p_H IS NULL").count() == 0


def test_importance_and_dimensions(spark, prep, fitted):
    importances = fitted[1][0].importances()
    assert next(iter(importances)) in ("一级渠道名称", "渠道组合", "通话次数", "通话总时长", "平均通话时长_派生", "有效通话", "首触响应时长_小时")
    table = tr.importance_table(spark, {"一级渠道名称": 0.5, "通话次数_x": 0.3, "zzz": 0.2, "渠道组合": 0.1})
    got = {r["dimension"]: r["importance"] for r in tr.dimension_contribution(table).collect()}
    assert got["基础特征"] == pytest.approx(0.6) and got["行为特征"] == 0.3 and got["其他特征"] == 0.2 and got["意图特征"] == 0.0
    loss = tr.permutation_importance(fitted[1][0], prep.test, v.LEAD_ID, ["线索创建时间_hour"])
    assert abs(loss["线索创建时间_hour"]) < 0.5


def test_leaderboard_and_baseline(make):
    board = make([("GBT", .5), ("RandomForest", .7), ("WeightedEnsemble_L2", .9)], "model string, score_test double")
    assert tr.pick_baseline(board, "gbm")["baseline_model_name"] == "GBT"
    other = tr.pick_baseline(board, "linear")
    clash = make([("MyGBT", .9), ("GBT_2", .5)], "model string, score_test double")
    assert tr.pick_baseline(clash, "gbm")["baseline_model_name"] == "GBT_2"
    assert other["baseline_model_name"] == "RandomForest" and other["fallback_reason"]
    assert tr.choose_families(excluded=["GBT"]) == ["RandomForest", "LogisticRegression"]
    with pytest.raises(ValueError):
        tr.choose_families(included=[])


def test_top_lists_and_report(spark, prep, fitted, tmp_path):
    model = fitted[1][0]
    lists = scoring.write_top_lists(prep.test, model, str(tmp_path / "m"), "H", ks=(5, 10_000))
    assert set(lists) == {5} and rd.read_header(spark, str(tmp_path / "m_top5.csv")).count() == 5
    with pytest.raises(ValueError, match="fits"):
        scoring.write_top_lists(prep.test, model, str(tmp_path / "n"), "H", ks=(10_000,))
    with pytest.raises(ValueError, match="target_class"):
        scoring.write_top_lists(prep.test, model, str(tmp_path / "n"), ks=(5,))
    top = spark.createDataFrame([(5, 2)], "k int, hit_count int")
    report = validation.model_report(spark, str(tmp_path), "m", {"auc": 0.5}, top, {f"f{i}": 1.0 for i in range(30)})
    assert len(report["feature_importance"]) == 20 and report["topk_metrics"]["top_5"]["hit_count"] == 2
    assert st.read_sidecar(spark, str(tmp_path / "m_report"))["model_name"] == "m"


def test_multiclass_gbt_is_one_head_per_class(prep):
    model = tr.train(prep.train, prep.target, "GBT", size={"iterations": 2, "depth": 2})
    assert len(model.heads) == 3
    row = model.probabilities(prep.test).select((F.col("p_H") + F.col("p_A") + F.col("p_B")).alias("s")).first()
    assert row["s"] == pytest.approx(1.0)


def test_scoring_modes(spark, prep):
    df = modelled(spark)
    parts = sp.parts(sp.time_split(df, "2026-01-15"))
    size = {"iterations": 2, "depth": 2}
    drive, board = tr.train_window_models(parts["train"], parts["test"], [f"试驾标签_{n}天" for n in (7, 14, 21)], ks=(10,), size=size)
    order, _ = tr.train_window_models(parts["train"], parts["test"], ["下订标签_14天"], ks=(10,), size=size)
    assert board.count() == 3 and board.where("auc IS NULL").count() == 0
    models = {"model": drive["试驾标签_14天"], "drive": {n: drive[f"试驾标签_{n}天"] for n in (7, 14, 21)}, "order": {14: order["下订标签_14天"]}}
    for mode in ("simple", "medium", "advanced"):
        out = scoring.score(df, mode, models)
        assert out.count() == 400 and {"评级", "阶段", "分值"} <= set(out.columns)
    advanced = scoring.score(df, "advanced", models, include_original=True)
    assert advanced.where("`阶段` = '试驾后' AND `试驾概率_7天` != 0").count() == 0
    assert advanced.where("`阶段` = '试驾前' AND `下订概率_14天` != 0").count() == 0
    assert advanced.where("`阶段` = '试驾后' AND `下订概率_14天` > 0").count() > 0
    lacking = scoring.score(df.drop("通话次数"), "advanced", {**models, "drive": {}})
    assert lacking.where("`阶段` = '试驾后' AND `下订概率_14天` != 0.5").count() == 0
    with pytest.raises(ValueError):
        scoring.score(df, "nope", models)


def test_data_job(spark, tmp_path):
    df = modelled(spark)
    log = spark.createDataFrame([("13800000001", "2026-01-01", "testDrive")], "`dmp_手机号` string, `dmp_事件时间` string, `dmp_事件名称` string")
    out, reports = data_job.run_all(df, log, "线索评级结果", skip=(), output=str(tmp_path / "o"))
    assert set(reports) == {"merge", "profile", "clean", "deidentify", "split"}
    back = spark.read.parquet(str(tmp_path / "o"))
    assert back.count() == 400 and back.where("`手机号_脱敏` NOT LIKE '%****%'").count() == 0
    one, report = data_job.run_step("clean", df)
    assert report.rows_before == 400
    with pytest.raises(ValueError):
        data_job.run_step("nope", df)
    with pytest.raises(ValueError):
        data_job.run_all(df, skip=("nope",))
    stage, info = data_job.order_stage(df)
    assert stage.count() == df.where("`试驾时间` IS NOT NULL").count() and "线索唯一ID" not in stage.columns
    assert set(data_job.order_stage(df, split="time", cutoff="2026-01-10", keep=["线索唯一ID"])[0].columns) >= {"split", "线索唯一ID"}


def test_empty_number_and_texts_with_many_values(make):
    """A number column without values trains, and every text column has an importance of its own."""
    rows = [(i, i % 2, None, f"key{i}", f"{i % 2}-{i % 3}", float(i % 5)) for i in range(400)]
    df = make(rows, "id int, y int, empty double, many string, few string, x double")
    for family in tr.FAMILIES:
        model = tr.train(df, "y", family, excluded=["id"], size={"iterations": 3, "depth": 3, "trees": 3})
        importances = model.importances()
        assert set(importances) == {"empty", "many", "few", "x"} and sum(importances.values()) == pytest.approx(1.0)
        assert importances["few"] > 0.5 and importances["empty"] == 0
        assert model.probabilities(df).where("abs(p_0 + p_1 - 1) > 1e-9 OR p_0 IS NULL").count() == 0
