"""From a probability to the published row, and the summaries of one scoring run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, percent
from stayline.functions.reasons import (
    SCORING,
    contribution_json,
    describe,
    rank_contributions,
)
from stayline.functions.rules import DECISION_THRESHOLD, decide, recommended_action, risk_tier
from stayline.schemas import MODEL_FEATURES, PROBABILITY


def assemble(scored: DataFrame, threshold: float = DECISION_THRESHOLD, top: int = 3) -> DataFrame:
    """Published columns from ``churn_probability`` and ``contributions``.

    Bands look at the raw probability; only the output is rounded.
    """
    probability = F.col("churn_probability")
    ranked_rows = scored.withColumn("ranked", rank_contributions("contributions", top))
    return ranked_rows.select(
        "customer_id",
        F.round(probability, 4).cast(PROBABILITY).alias("churn_probability"),
        decide(probability, threshold).alias("churn_prediction"),
        risk_tier(probability).alias("risk_tier"),
        *[
            reason.alias(f"top_reason_{n + 1}")
            for n, reason in enumerate(describe("ranked", MODEL_FEATURES, top, SCORING))
        ],
        contribution_json("contributions", MODEL_FEATURES).alias("shap_values_json"),
        recommended_action(probability).alias("recommended_action"),
    )


def ranked(scores: DataFrame) -> DataFrame:
    """By the published probability, so ties in four digits go by id."""
    return scores.orderBy(F.round("churn_probability", 4).desc(), "customer_id")


def run_summary(scores: DataFrame) -> DataFrame:
    churners = count_if(F.col("churn_prediction") == 1)
    return scores.agg(
        F.count("*").alias("scored"),
        churners.alias("predicted_churners"),
        percent(churners, F.count("*"), 1).alias("predicted_churn_pct"),
    )


def top_at_risk(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n most likely leavers: a bounded heap per task, no full sort."""
    return (
        scores.filter(F.col("churn_prediction") == 1)
        .orderBy(F.col("churn_probability").desc(), "customer_id")
        .limit(n)
        .select(
            "customer_id", "churn_probability", "risk_tier", "top_reason_1", "recommended_action"
        )
    )
