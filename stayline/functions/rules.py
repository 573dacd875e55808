"""Business rules on the probability, the tenure and the bill."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four actions, by the lowest probability that earns each.
ACTIONS = [
    (0.75, "URGENT: Call within 24h — offer 30% discount on annual plan"),
    (0.55, "Call this week — offer free upgrade or loyalty bonus"),
    (0.40, "Send personalised retention email with bundle offer"),
]
NO_ACTION = "No immediate action needed — monitor next month"

# The highest probability that still belongs to each tier.
LOW_UPTO, MEDIUM_UPTO = 0.40, 0.65

DECISION_THRESHOLD = 0.50


def decide(probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return F.when(probability >= F.lit(threshold), 1).otherwise(0)


def risk_tier(probability: Column) -> Column:
    """Right-closed bands; no tier without a probability."""
    return (
        F.when(probability <= F.lit(LOW_UPTO), "LOW")
        .when(probability <= F.lit(MEDIUM_UPTO), "MEDIUM")
        .when(probability.isNotNull(), "HIGH")
    )


def recommended_action(probability: Column) -> Column:
    """Left-closed bands."""
    (first, text), *rest = ACTIONS
    rule = F.when(probability >= F.lit(first), text)
    for floor, text in rest:
        rule = rule.when(probability >= F.lit(floor), text)
    return rule.otherwise(NO_ACTION)


def tenure_group(tenure: Column) -> Column:
    """Model-side bands; anything outside them, null included, counts as loyal."""
    return (
        F.when(tenure.between(0, 6), "new")
        .when(tenure.between(7, 24), "mid")
        .when(tenure.between(25, 48), "established")
        .otherwise("loyal")
    )


def tenure_bucket(tenure: Column) -> Column:
    """Exploration bands."""
    # The labels.
    return (
        F.when(tenure.between(0, 6), "0-6 months (New)")
        .when(tenure.between(7, 24), "7-24 months (Growing)")
        .when(tenure.between(25, 48), "25-48 months (Established)")
        .otherwise("49+ months (Loyal)")
    )


def tenure_band(tenure: Column) -> Column:
    """Reporting bands."""
    # The labels.
    return (
        F.when(tenure < 6, "New (< 6 mo)")
        .when(tenure < 24, "Mid (6-24 mo)")
        .otherwise("Loyal (24+ mo)")
    )


def bill_bucket(monthly: Column) -> Column:
    # The labels.
    return (
        F.when(monthly < 35, "< ₹35 (Budget)")
        .when(monthly < 65, "₹35-65 (Mid)")
        .when(monthly < 85, "₹65-85 (Premium)")
        .otherwise("₹85+ (High-end)")
    )
