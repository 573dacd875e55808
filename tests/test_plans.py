"""Physical plans that matter at scale."""

import pytest

from stayline.operators import explain
from stayline.operators.explore import by_contract, danger_zone
from stayline.plans import pipeline
from stayline.operators import modeling
from stayline.sources.derived import raw_subscribers, subscribers


@pytest.fixture(scope="module")
def tuned(spark, tiny):
    matrix = pipeline.training_matrix(raw_subscribers(spark, tiny))
    model, _ = modeling.train_tuned(matrix, modeling.Boosting(trees=3, depth=3))
    return model, explain.leaf_tables(spark, model.stages[-1])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_are_sorted_before_they_are_explained(spark, tiny, tuned):
    model, tables = tuned
    raw = raw_subscribers(spark, tiny)
    text = plan(pipeline.score(raw, model, tables=tables))
    # Children come after their parents: the Python step is above the sort.
    assert text.index("ArrowEvalPython") < text.index("Exchange rangepartitioning")
    assert text.count("EvalPython") == 1
    unordered = plan(pipeline.score(raw, model, tables=tables, order=False))
    assert "rangepartitioning" not in unordered


def test_counting_scores_explains_nobody(spark, tiny, tuned):
    model, tables = tuned
    scored = pipeline.score(raw_subscribers(spark, tiny), model, tables=tables)
    assert "EvalPython" not in plan(scored.groupBy("churn_prediction").count())


def test_global_importance_does_not_explode(spark, tiny, tuned):
    model, tables = tuned
    matrix = pipeline.training_matrix(raw_subscribers(spark, tiny))
    rows = pipeline.explained(pipeline.with_probability(matrix, model), model, tables)
    text = plan(explain.global_importance(rows))
    below = text[text.index("HashAggregate") :]
    assert "Generate" not in below and "Expand" not in below


def test_a_query_reads_only_its_columns(spark, tiny):
    customers = subscribers(spark, tiny)
    text = plan(danger_zone(customers.withColumn("churn", customers["contract"])))
    # Without the real label there is nothing to ask of the orders.
    assert "orders.parquet" not in text
    assert "c_acctbal" not in text
    grouped = plan(by_contract(customers))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate" in grouped
    assert "o_totalprice" not in grouped
