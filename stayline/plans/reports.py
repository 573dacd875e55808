"""Views and business reports over scoring runs and customers.

``as_of`` picks the run date; left out, it is today. Reports that only add things up reduce the
predictions to one row per customer first. That uses the same exchange on ``customer_id`` as the
join needs, and a customer with very many rows reaches the join as one.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, mean, percent, ratio
from stayline.functions.rules import tenure_band

CALLS_PER_DAY = 100
MIN_SEGMENT = 10
# The rates that the published column names state.
ACCEPTED, KEPT_AFTER_DISCOUNT, MONTHS = Decimal("0.30"), Decimal("0.80"), 12


def run_day(as_of: date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def of_day(predictions: DataFrame, as_of: date | None) -> DataFrame:
    return predictions.filter(F.col("run_date") == run_day(as_of))


def _per_customer(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("customer_id").agg(
        F.count("*").alias("scored"),
        F.sum("churn_prediction").alias("churners"),
        *[F.count_if(F.col("risk_tier") == t).alias(t.lower()) for t in ("HIGH", "MEDIUM", "LOW")],
    )


def _times(count: str, money: str = "monthly_charges") -> Column:
    """Exact ``count`` x ``money``, wide enough for the whole base."""
    return F.col(count).cast("decimal(18,0)") * F.col(money)


def by_probability() -> list[Column]:
    """A total order on a day's run keys, so no two rows force each other into one sort task."""
    return [F.col("churn_probability").desc(), F.col("customer_id"), F.col("model_version")]


def at_risk_view(predictions: DataFrame, customers: DataFrame, as_of: date | None = None) -> DataFrame:
    flagged = of_day(predictions, as_of).filter(F.col("churn_prediction") == 1)
    return (
        flagged.join(customers, "customer_id")
        .orderBy(*by_probability())
        .select(
            "customer_id",
            "churn_probability",
            "risk_tier",
            "top_reason_1",
            "top_reason_2",
            "top_reason_3",
            "recommended_action",
            "tenure",
            "contract",
            "monthly_charges",
            "internet_service",
            "payment_method",
            "run_date",
        )
    )


def daily_summary(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("run_date")
        .agg(
            F.count("*").alias("total_scored"),
            F.sum("churn_prediction").alias("predicted_churners"),
            mean("churn_probability", 2, 100).alias("avg_churn_prob_pct"),
            *[
                count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_risk_count")
                for t in ("HIGH", "MEDIUM", "LOW")
            ],
        )
        .orderBy(F.col("run_date").desc())
    )


def call_list(
    predictions: DataFrame,
    customers: DataFrame,
    as_of: date | None = None,
    limit: int = CALLS_PER_DAY,
) -> DataFrame:
    """The most likely leavers of the day that are on file, ranked.

    The limit comes before the rank, as a bounded heap per task, so the rank sees ``limit`` rows.
    """
    flagged = of_day(predictions, as_of).filter(F.col("churn_prediction") == 1)
    order = by_probability()
    first = flagged.join(customers, "customer_id").orderBy(*order).limit(limit)
    rank = F.row_number().over(Window.orderBy(*order)).cast("long")
    return (
        first.withColumn("priority_rank", rank)
        .select(
            "priority_rank",
            "customer_id",
            ratio(F.col("churn_probability"), F.lit(1), 1, 100).alias("churn_prob_pct"),
            "risk_tier",
            F.col("tenure").alias("months_with_us"),
            "contract",
            "monthly_charges",
            "internet_service",
            F.col("top_reason_1").alias("primary_risk_factor"),
            F.col("top_reason_2").alias("secondary_risk_factor"),
            "recommended_action",
        )
        .orderBy("priority_rank")
    )


def executive_summary(
    predictions: DataFrame, customers: DataFrame, as_of: date | None = None
) -> DataFrame:
    joined = _per_customer(of_day(predictions, as_of)).join(
        customers.select("customer_id", "monthly_charges"), "customer_id"
    )
    return joined.agg(
        F.coalesce(F.sum("scored"), F.lit(0)).alias("total_customers_scored"),
        F.sum("churners").alias("predicted_to_churn"),
        percent(F.sum("churners"), F.sum("scored")).alias("predicted_churn_rate_pct"),
        F.sum(_times("churners")).cast("decimal(18,2)").alias("monthly_revenue_at_risk"),
        F.sum("high").alias("high_risk_customers"),
        F.sum("medium").alias("medium_risk_customers"),
        F.sum("low").alias("low_risk_customers"),
    ).select(run_day(as_of).alias("report_date"), "*")


def weekly_trend(
    predictions: DataFrame, customers: DataFrame, model_version: str | None = None
) -> DataFrame:
    """Daily totals, then averages per week starting on Monday."""
    if model_version is not None:
        predictions = predictions.filter(F.col("model_version") == model_version)
    daily = (
        predictions.groupBy("customer_id", "run_date")
        .agg(F.sum("churn_prediction").alias("churners"))
        .join(customers.select("customer_id", "monthly_charges"), "customer_id")
        .groupBy("run_date")
        .agg(
            F.sum("churners").alias("daily_churners"),
            F.sum(_times("churners")).alias("daily_revenue_at_risk"),
        )
    )
    return (
        daily.groupBy(F.date_trunc("week", "run_date").cast("date").alias("week_starting"))
        .agg(
            F.count("run_date").alias("days_scored"),
            mean("daily_churners", 0).alias("avg_daily_predicted_churners"),
            mean("daily_revenue_at_risk", 2).alias("avg_daily_revenue_at_risk"),
        )
        .orderBy(F.col("week_starting").desc())
    )


def driver(reason: Column) -> Column:
    """Feature and direction of a published reason, without its figure: ``tenure (high risk)``."""
    return F.regexp_replace(reason, ", SHAP=[^)]*", "")


def top_drivers(predictions: DataFrame, as_of: date | None = None) -> DataFrame:
    """At most two rows per feature: every scored customer has a figure of its own in its reason."""
    return (
        of_day(predictions, as_of)
        .filter((F.col("churn_prediction") == 1) & F.col("top_reason_1").isNotNull())
        .groupBy(driver(F.col("top_reason_1")).alias("risk_factor"))
        .agg(
            F.count("*").alias("times_cited_as_primary"),
            mean("churn_probability", 1, 100).alias("avg_churn_prob_when_primary"),
        )
        .orderBy(F.col("times_cited_as_primary").desc(), "risk_factor")
    )


def segments(
    predictions: DataFrame,
    customers: DataFrame,
    as_of: date | None = None,
    min_segment: int = MIN_SEGMENT,
) -> DataFrame:
    joined = _per_customer(of_day(predictions, as_of)).join(
        customers.select(
            "customer_id",
            "contract",
            "internet_service",
            tenure_band(F.col("tenure")).alias("tenure_band"),
            "monthly_charges",
        ),
        "customer_id",
    )
    keys = ["contract", "internet_service", "tenure_band"]
    return (
        joined.groupBy(*keys)
        .agg(
            F.sum("scored").alias("customer_count"),
            F.sum("churners").alias("predicted_churners"),
            percent(F.sum("churners"), F.sum("scored")).alias("predicted_churn_rate_pct"),
            ratio(F.sum(_times("scored")), F.sum("scored"), 2).alias("avg_monthly_charges"),
        )
        .filter(F.col("customer_count") >= min_segment)
        .orderBy(F.col("predicted_churn_rate_pct").desc(), *keys)
    )


def retention_roi(
    predictions: DataFrame,
    customers: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """What the high tier is worth if 30 per cent accept an offer at a discount of 20 per cent."""
    high = of_day(predictions, as_of).filter(F.col("risk_tier") == "HIGH")
    total = (
        high.groupBy("customer_id")
        .agg(F.count("*").alias("scored"))
        .join(customers.select("customer_id", "monthly_charges"), "customer_id")
        .agg(
            F.coalesce(F.sum("scored"), F.lit(0)).alias("high_risk_customers"),
            F.sum(_times("scored")).cast("decimal(18,2)").alias("monthly_revenue_at_risk"),
        )
    )
    revenue = F.col("monthly_revenue_at_risk")

    def share(factor: Decimal) -> Column:
        return F.round(revenue * F.lit(factor), 2).cast("decimal(18,2)")

    return total.select(
        "high_risk_customers",
        "monthly_revenue_at_risk",
        share(ACCEPTED).alias("retained_revenue_30pct_success"),
        share(ACCEPTED * KEPT_AFTER_DISCOUNT).alias("net_retained_revenue_after_20pct_discount"),
        share(ACCEPTED * KEPT_AFTER_DISCOUNT * MONTHS).alias("annual_net_retention_value"),
    )


def model_tracking(predictions: DataFrame, customers: DataFrame) -> DataFrame:
    """Predicted against actual, per run and model version."""
    known = customers.filter(F.col("churn").isNotNull()).select("customer_id", "churn")
    says, left, stayed = F.col("churn_prediction"), F.col("churn") == "Yes", F.col("churn") == "No"
    counted = predictions.groupBy("customer_id", "run_date", "model_version").agg(
        F.count("*").alias("rows"),
        F.count_if(says == 1).alias("flagged"),
        F.count_if(says == 0).alias("cleared"),
        F.count_if(says != 1).alias("not_flagged"),
    )
    joined = counted.join(known, "customer_id")

    def rows(count: str, who: Column) -> Column:
        return F.sum(F.when(who, F.col(count)).otherwise(0))

    right = rows("flagged", left) + rows("not_flagged", ~left)
    return (
        joined.groupBy("run_date", "model_version")
        .agg(
            F.sum("rows").alias("total_predictions"),
            rows("flagged", left).alias("true_positives"),
            rows("flagged", stayed).alias("false_positives"),
            rows("cleared", stayed).alias("true_negatives"),
            rows("cleared", left).alias("false_negatives"),
            percent(right, F.sum("rows")).alias("accuracy_pct"),
        )
        .orderBy(F.col("run_date").desc(), "model_version")
    )
