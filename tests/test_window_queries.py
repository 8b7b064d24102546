"""Queries of several windows fit all of them in the same passes, and look a text up once for all models of a row."""

import os

import pytest

from showroom.queries import model_queries as mq

FOLDER = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture
def fits(monkeypatch):
    """Number of heads of each fit; trees are small ones here."""
    seen, boost = [], mq.tr.boosting.boost
    monkeypatch.setattr(mq.tr.boosting, "boost", lambda rows, heads, count, *size: seen.append(len(heads)) or boost(rows, heads, count, 1, 1))
    return seen


def folder(mark):
    return f"{FOLDER}/../{os.path.basename(FOLDER)}/{'./' * mark}"  # a path of its own: models are kept by path


def test_stages_need_one_fit(spark, fits):
    rows = mq.scored_stages(spark, folder(11)).collect()
    assert fits == [6] and sum(r["n"] for r in rows) == mq._stored(spark, folder(11)).count()


def test_window_models_need_one_fit(spark, fits):
    rows = mq.window_models(spark, folder(12)).collect()
    assert fits == [7] and {r["target"] for r in rows} == set(mq.ALL_TARGETS)


def test_probabilities_need_one_fit_and_one_look_up_a_text(spark, fits):
    out = mq.window_probabilities(spark, folder(13))
    assert fits == [7]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 8  # text columns; 56 with a look-up for each model
    assert out.where("fine").count() == mq._window_parts(spark, folder(13))["test"].count()
