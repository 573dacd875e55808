"""Reports from sums that are kept per run, so that a new day does not re-read history.

When a run is published, one row of mergeable sums is published beside it: a few numbers per run date and model
version. The daily summary, the weekly trend and model tracking add these rows up; publishing an old day
again replaces its row and no other. Revenue and outcomes are those of the customers at the time of
publication; ``refresh`` sums a stored run again where customers have changed since.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.numeric import mean, percent, ratio
from stayline.sources import tables, versions

SUMS = (
    "run_date date, model_version string, scored long, churners long, probability decimal(28,4), high long, medium long, low long,"
    " on_file long, churners_on_file long, revenue_at_risk decimal(38,2), with_outcome long,"
    " true_positives long, false_positives long, true_negatives long, false_negatives long, right long"
)


def run_sums(run: DataFrame, customers: DataFrame) -> DataFrame:
    """One row of sums per run date and model version. Rows of customers that are not on file count in the
    daily summary only, as in the reports over all rows."""
    known = customers.select("customer_id", "monthly_charges", "churn", F.lit(True).alias("on_file"))
    says, left, stayed = F.col("churn_prediction"), F.col("churn") == "Yes", F.col("churn") == "No"
    flagged, outcome = says == 1, F.col("churn").isNotNull()

    money = says.cast("decimal(18,0)") * F.col("monthly_charges")
    return (
        run.join(known, "customer_id", "left")
        .groupBy("run_date", "model_version")
        .agg(
            F.count("*").alias("scored"),
            F.sum("churn_prediction").alias("churners"),
            F.sum("churn_probability").cast("decimal(28,4)").alias("probability"),
            *[F.count_if(F.col("risk_tier") == t).alias(t.lower()) for t in ("HIGH", "MEDIUM", "LOW")],
            F.count_if(F.col("on_file")).alias("on_file"),
            F.coalesce(F.sum(F.when(F.col("on_file"), says)), F.lit(0)).cast("long").alias("churners_on_file"),
            F.sum(money).cast("decimal(38,2)").alias("revenue_at_risk"),
            F.count_if(outcome).alias("with_outcome"),
            F.count_if(left & flagged).alias("true_positives"),
            F.count_if(stayed & flagged).alias("false_positives"),
            F.count_if(stayed & (says == 0)).alias("true_negatives"),
            F.count_if(left & (says == 0)).alias("false_negatives"),
            F.count_if((left & flagged) | (outcome & ~left & (says != 1))).alias("right"),
        )
    )


def publish_run_with_sums(
    scores: DataFrame, customers: DataFrame, path: str, sums: str, run_date: date | None = None, model_version: str = "gbt_v1", **options
) -> None:
    """``tables.publish_run``, then the run's sums, read from what was published."""
    spark = scores.sparkSession
    day, version = tables.run_of(spark, run_date, model_version)
    tables.publish_run(scores, path, day, version, **options)
    refresh(spark, customers, path, sums, day, version)


def refresh(spark: SparkSession, customers: DataFrame, path: str, sums: str, run_date: date, model_version: str) -> None:
    """Sums one stored run again; no other run is read."""
    run = tables.read_predictions(spark, path).filter(
        (F.col("run_date") == run_date) & (F.col("model_version") == model_version)
    )
    rows = run_sums(run, customers).drop(*tables.RUN_PARTITIONS)
    versions.replace(rows.coalesce(1), sums, f"run_date={run_date}/model_version={model_version}")


def read_sums(spark: SparkSession, sums: str) -> DataFrame:
    """One row per run that has rows."""
    schema = spark.createDataFrame([], SUMS).schema
    return versions.read_current(spark, sums, schema).select(*schema.names)


def daily_summary(sums: DataFrame) -> DataFrame:
    """``reports.daily_summary`` from the sums of the runs."""
    return (
        sums.groupBy("run_date")
        .agg(
            F.sum("scored").alias("total_scored"),
            F.sum("churners").alias("predicted_churners"),
            ratio(F.sum("probability"), F.sum("scored"), 2, 100).alias("avg_churn_prob_pct"),
            *[F.sum(t).alias(f"{t}_risk_count") for t in ("high", "medium", "low")],
        )
        .orderBy(F.col("run_date").desc())
    )


def weekly_trend(sums: DataFrame, model_version: str | None = None) -> DataFrame:
    """``reports.weekly_trend`` from the sums of the runs."""
    if model_version is not None:
        sums = sums.filter(F.col("model_version") == model_version)
    by_day = sums.filter("on_file > 0").groupBy("run_date").agg(
        F.sum("churners_on_file").alias("daily_churners"), F.sum("revenue_at_risk").alias("daily_revenue_at_risk")
    )
    return (
        by_day.groupBy(F.date_trunc("week", "run_date").cast("date").alias("week_starting"))
        .agg(
            F.count("run_date").alias("days_scored"),
            mean("daily_churners", 0).alias("avg_daily_predicted_churners"),
            mean("daily_revenue_at_risk", 2).alias("avg_daily_revenue_at_risk"),
        )
        .orderBy(F.col("week_starting").desc())
    )


def model_tracking(sums: DataFrame) -> DataFrame:
    """``reports.model_tracking`` from the sums of the runs."""
    cells = ["true_positives", "false_positives", "true_negatives", "false_negatives"]
    return (
        sums.filter("with_outcome > 0")
        .groupBy("run_date", "model_version")
        .agg(
            F.sum("with_outcome").alias("total_predictions"),
            *[F.sum(c).alias(c) for c in cells],
            percent(F.sum("right"), F.sum("with_outcome")).alias("accuracy_pct"),
        )
        .orderBy(F.col("run_date").desc(), "model_version")
    )
