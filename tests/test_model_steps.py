"""What queries of fitted models run: no fit that they don't read, and no column moved before it is needed."""

import os

import pytest

from showroom.plans import lead_view, target_statistics as ts
from showroom.queries import model_queries as mq

FOLDER = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@tables
@pytest.mark.parametrize("mode, fits", [("simple", 1), ("medium", 3), ("advanced", 6)])
def test_a_mode_fits_the_models_it_scores_with(spark, monkeypatch, mode, fits):
    folder, fitted = f"{FOLDER}/../{os.path.basename(FOLDER)}/{'./' * fits}", []  # a path of its own: models are kept by path
    monkeypatch.setattr(mq.tr, "train", lambda rows, target, *a, **b: fitted.append(target))
    monkeypatch.setattr(mq.scoring, "score", lambda df, mode, models: models)
    mq._scored(spark, folder, mode)
    assert len(fitted) == len(set(fitted)) == fits


def test_fold_is_taken_once_a_row(make):
    rows = make([(i, "HAB"[i % 3], "x", f"car{i % 5}") for i in range(30)], "id bigint, label string, city string, car string")
    found = ts.fit(rows, "label", ["city", "car"], ["H", "A", "B"], ["id"])
    out = found.encode(rows, training=True)
    assert plan_of(out).count("md5(") == 1
    assert out.columns == [*rows.columns, *found.names(0), *found.names(1)]


@tables
def test_leads_are_derived_behind_the_joins(spark):
    plan = plan_of(lead_view.leads(spark, FOLDER, "lines", "place", "car"))
    assert "lpad(" in plan and "lpad(" not in plan[plan.index("Join"):]
