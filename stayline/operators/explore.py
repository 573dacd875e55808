"""Exploratory aggregates: one grouped operator, and the few global ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, mean, percent
from stayline.functions.rules import bill_bucket, tenure_bucket


def churned() -> Column:
    return F.col("churn") == "Yes"


def churn_rate() -> Column:
    """A missing label counts as a customer, not as a churned one."""
    return percent(count_if(churned()), F.count("*")).alias("churn_rate_pct")


def churn_breakdown(
    df: DataFrame,
    name: str,
    by: Column | None = None,
    extra: list[Column] | None = None,
    order: Column | None = None,
) -> DataFrame:
    """Size, churned and churn rate per value of ``by``, highest rate first.

    ``order`` is an aggregate to sort by instead; it stays out of the result.
    """
    rank = [F.col("churn_rate_pct").desc(), F.col(name)] if order is None else [F.col("_order")]
    hidden = [] if order is None else [order.alias("_order")]
    return (
        df.groupBy((F.col(name) if by is None else by).alias(name))
        .agg(
            F.count("*").alias("total"),
            count_if(churned()).alias("churned"),
            churn_rate(),
            *(extra or []),
            *hidden,
        )
        .orderBy(*rank)
        .drop("_order")
    )


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_customers"),
        count_if(churned()).alias("churned"),
        count_if(F.col("churn") == "No").alias("retained"),
        churn_rate(),
    )


def numeric_summary(df: DataFrame) -> DataFrame:
    return df.filter(F.col("total_charges").isNotNull()).agg(
        mean("tenure", 2).alias("avg_tenure_months"),
        F.min("tenure").alias("min_tenure"),
        F.max("tenure").alias("max_tenure"),
        mean("monthly_charges", 2).alias("avg_monthly_charges"),
        F.min("monthly_charges").alias("min_monthly_charges"),
        F.max("monthly_charges").alias("max_monthly_charges"),
        mean("total_charges", 2).alias("avg_total_charges"),
    )


def by_contract(df: DataFrame) -> DataFrame:
    return churn_breakdown(
        df, "contract", extra=[mean("monthly_charges", 2).alias("avg_monthly_charges")]
    )


def by_tenure(df: DataFrame) -> DataFrame:
    return churn_breakdown(
        df,
        "tenure_group",
        tenure_bucket(F.col("tenure")),
        [mean("monthly_charges", 2).alias("avg_monthly_charges")],
        F.min("tenure"),
    )


def by_internet(df: DataFrame) -> DataFrame:
    return churn_breakdown(df, "internet_service")


def by_bill(df: DataFrame) -> DataFrame:
    return churn_breakdown(
        df,
        "bill_bucket",
        bill_bucket(F.col("monthly_charges")),
        [mean("tenure", 1).alias("avg_tenure")],
        F.min("monthly_charges"),
    )


def by_payment(df: DataFrame) -> DataFrame:
    return churn_breakdown(df, "payment_method")


def danger_zone(df: DataFrame) -> DataFrame:
    """Month-to-month fiber customers in their first year."""
    return df.filter(
        (F.col("contract") == "Month-to-month")
        & (F.col("internet_service") == "Fiber optic")
        & (F.col("tenure") < 12)
    ).agg(
        F.count("*").alias("total_danger_zone"),
        count_if(churned()).alias("actually_churned"),
        churn_rate(),
    )


def revenue_at_risk(df: DataFrame) -> DataFrame:
    lost = F.sum(F.when(churned(), F.col("monthly_charges")).otherwise(0).cast("decimal(8,2)"))
    whole = F.sum("monthly_charges")
    return df.agg(
        whole.alias("total_monthly_revenue"),
        lost.alias("revenue_at_risk"),
        percent(lost, whole).alias("pct_revenue_at_risk"),
    )


def by_senior(df: DataFrame) -> DataFrame:
    """Grouped by the flag as stored: a missing flag is a group of its own, labelled non-senior."""
    return (
        df.groupBy("senior_citizen")
        .agg(F.count("*").alias("total"), churn_rate())
        .select(
            F.when(F.col("senior_citizen") == 1, "Senior").otherwise("Non-senior").alias("segment"),
            "total",
            "churn_rate_pct",
        )
    )


def by_churn(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("total_charges").isNotNull())
        .groupBy("churn")
        .agg(
            mean("tenure", 1).alias("avg_tenure"),
            mean("monthly_charges", 2).alias("avg_monthly_charges"),
            mean("total_charges", 2).alias("avg_total_charges"),
            F.count("*").alias("customer_count"),
        )
    )
