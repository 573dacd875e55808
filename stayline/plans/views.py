"""The tables and the two reporting views under their SQL names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from stayline.operators.features import feature_table
from stayline.plans.reports import at_risk_view, daily_summary


def register(
    customers: DataFrame,
    predictions: DataFrame,
    features: DataFrame | None = None,
    as_of: date | None = None,
) -> None:
    """Temporary views for ``spark.sql``; nothing runs until they are queried."""
    named = {
        "customers": customers,
        "churn_features": feature_table(customers) if features is None else features,
        "churn_predictions": predictions,
        "v_at_risk_customers": at_risk_view(predictions, customers, as_of),
        "v_daily_churn_summary": daily_summary(predictions),
    }
    for name, frame in named.items():
        frame.createOrReplaceTempView(name)
