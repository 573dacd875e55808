from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.functions import reasons, rules
from stayline.operators import scoring


def apply(spark, rule, values, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    rows = frame.select("i", rule(F.col("p").cast(kind)).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


@pytest.mark.parametrize("kind", ["double", "decimal(5,4)"])
def test_tiers_are_right_closed(spark, kind):
    values = [0.85, 0.55, 0.30, 0.40, 0.4001, 0.65, 0.6501, None]
    expected = ["HIGH", "MEDIUM", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", None]
    assert apply(spark, rules.risk_tier, values, kind) == expected


@pytest.mark.parametrize("kind", ["double", "decimal(5,4)"])
def test_actions_are_left_closed(spark, kind):
    texts = [text for _, text in rules.ACTIONS]
    values = [0.80, 0.75, 0.7499, 0.55, 0.5499, 0.40, 0.3999, 0.20]
    expected = [texts[0], texts[0], texts[1], texts[1], texts[2], texts[2]] + [rules.NO_ACTION] * 2
    assert apply(spark, rules.recommended_action, values, kind) == expected
    assert "URGENT" in texts[0] and "No immediate action" in rules.NO_ACTION


def test_threshold_is_inclusive(spark):
    assert apply(spark, rules.decide, [0.5, 0.4999, None]) == [1, 0, 0]
    assert apply(spark, lambda p: rules.decide(p, 0.6), [0.5, 0.6]) == [0, 1]


def test_reasons_rank_by_magnitude_then_feature_order(spark):
    names = ["a", "b", "c", "d"]
    frame = spark.createDataFrame([([0.1, -0.5, 0.5, 0.0],)], "c array<double>")
    row = (
        frame.withColumn("ranked", reasons.rank_contributions("c", 4))
        .select(
            F.array(*reasons.describe("ranked", names, 4)).alias("scoring"),
            F.array(*reasons.describe("ranked", names, 2, reasons.RETENTION)).alias("retention"),
            reasons.contribution_json("c", names).alias("json"),
        )
        .first()
    )
    assert row["scoring"] == [
        "b (low risk, SHAP=-0.500)",
        "c (high risk, SHAP=+0.500)",
        "a (high risk, SHAP=+0.100)",
        "d (low risk, SHAP=+0.000)",
    ]
    assert row["retention"] == [
        "b → lower churn risk (SHAP=-0.500)",
        "c → elevated churn risk (SHAP=+0.500)",
    ]
    assert row["json"] == '{"a":0.1,"b":-0.5,"c":0.5,"d":0.0}'


def test_run_summary_and_top(spark):
    rows = [(f"C{i:02d}", Decimal(i) / 20, int(i >= 10)) for i in range(20)]
    scores = spark.createDataFrame(
        rows, "customer_id string, churn_probability decimal(5,4), churn_prediction int"
    ).withColumns({c: F.lit("x") for c in ("risk_tier", "top_reason_1", "recommended_action")})
    assert tuple(scoring.run_summary(scores).first()) == (20, 10, 50.0)
    top = scoring.top_at_risk(scores, 3)
    assert [r["customer_id"] for r in top.collect()] == ["C19", "C18", "C17"]
    assert scoring.top_at_risk(scores, 50).count() == 10
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
