"""Every query on real tables, against an independent engine wherever it can say the same in SQL."""

import pytest

from __spark_entry__ import entry
from checks.compare import connect, difference
from checks.oracle import oracle_sql
from stayline.plans.catalog import catalog

QUERIES, SQL = catalog(), oracle_sql()
MODEL_ONLY = {
    "model_compare",
    "gbt_train",
    "gbt_class_report",
    "gbt_confusion",
    "feature_importance",
    "score_customers",
    "shap_values",
    "shap_global",
    "shap_pairs",
    "explain_customer",
}


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


def test_only_model_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == MODEL_ONLY
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, tiny, duck, name):
    assert difference(QUERIES[name](spark, tiny), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(MODEL_ONLY - {"model_compare"}))
def test_model_queries_give_rows(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0


def test_models_are_compared(spark, tiny):
    rows = QUERIES["model_compare"](spark, tiny).collect()
    assert len(rows) == 5
    assert [r["trees"] for r in rows][:4] == [None, 1, 200, 200] and rows[4]["trees"] >= 1
    assert all(0 <= r[c] <= 1 for r in rows for c in ("accuracy", "precision", "recall", "f1"))
    assert all(r["roc_auc"] > 0.5 for r in rows)


def test_nothing_is_left_unexplained(spark, tiny):
    assert QUERIES["shap_values"](spark, tiny).filter("unexplained > 1e-6").count() == 0


def test_entry(spark):
    assert 0 < entry(spark).count() <= 100
