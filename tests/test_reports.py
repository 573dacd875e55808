from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.plans import reports, views

DAY = date(2024, 1, 10)


def make(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, run_date date, model_version string, churn_probability double"
    ).select(
        "customer_id",
        "run_date",
        "model_version",
        F.col("churn_probability").cast("decimal(5,4)").alias("churn_probability"),
        F.when(F.col("churn_probability") >= 0.5, 1).otherwise(0).alias("churn_prediction"),
        F.when(F.col("churn_probability") > 0.65, "HIGH")
        .when(F.col("churn_probability") > 0.4, "MEDIUM")
        .otherwise("LOW")
        .alias("risk_tier"),
        F.when(F.col("churn_probability") >= 0.3, "tenure").alias("top_reason_1"),
        *[F.lit(None).cast("string").alias(c) for c in ("top_reason_2", "top_reason_3")],
        F.lit("call").alias("recommended_action"),
    )


@pytest.fixture(scope="module")
def predictions(spark):
    chances = [0.9, 0.7, 0.7, 0.6, 0.1, 0.2, 0.3, 0.45, 0.5, 0.66]
    rows = [
        (f"CUST-{i + 1:04d}", DAY, "v1", p) for i, p in enumerate(chances)
    ] + [("CUST-0001", DAY - timedelta(days=1), "v1", 0.9), ("CUST-9999", DAY, "v1", 0.99)]
    return make(spark, rows).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_executive_summary(predictions, sample):
    # The customer that is not on file does not count.
    assert rows(reports.executive_summary(predictions, sample, DAY)) == [
        (DAY, 10, 6, 60.0, Decimal("441.70"), 4, 3, 3)
    ]


def test_call_list(predictions, sample):
    calls = rows(reports.call_list(predictions, sample, DAY, limit=3))
    assert [c[:3] for c in calls] == [
        (1, "CUST-0001", 90.0),
        (2, "CUST-0002", 70.0),
        (3, "CUST-0003", 70.0),
    ]
    assert reports.call_list(predictions, sample, DAY).count() == 6
    view = rows(reports.at_risk_view(predictions, sample, DAY).select("customer_id"))
    assert [v[0] for v in view] == [c[1] for c in rows(reports.call_list(predictions, sample, DAY))]


def test_call_list_ranks_only_its_limit(predictions, sample):
    plan = reports.call_list(predictions, sample, DAY)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.rindex("TakeOrderedAndProject")


def test_call_list_is_whole_though_the_first_are_not_on_file(spark, sample):
    unknown = [(f"GONE-{i:04d}", DAY, "v1", 0.99) for i in range(60)]
    known = [(f"CUST-{i:04d}", DAY, "v1", 0.5 + i / 100) for i in range(1, 11)]
    flagged = make(spark, unknown + known)
    for limit in (1, 3, 5, 20):
        calls = rows(reports.call_list(flagged, sample, DAY, limit=limit))
        assert [c[1] for c in calls] == [f"CUST-{i:04d}" for i in range(10, 0, -1)][:limit]
        assert [c[0] for c in calls] == list(range(1, min(limit, 10) + 1))


def test_a_hot_customer_is_one_row_a_run_before_the_join(spark, sample):
    """A third of all rows repeat one customer's run; the join sees one row for each run of it."""
    scored = make(
        spark,
        [("CUST-0001", DAY, "v0", 0.9)] * 5000
        + [(f"CUST-{i:04d}", DAY, f"v{v}", 0.1) for i in range(2, 11) for v in range(1111)],
    )
    tracked = reports.model_tracking(scored, sample)
    assert sum(r[2] for r in rows(tracked)) == 5000 + 9 * 1111
    for report in (tracked, reports.weekly_trend(scored, sample)):
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join Inner") :]
        assert "Aggregate [customer_id" in below


def test_drivers_leave_the_figure_out(spark):
    scored = make(spark, [(f"CUST-{i}", DAY, "v", 0.8) for i in range(6)]).withColumn(
        "top_reason_1", F.concat(F.lit("tenure (high risk, SHAP=+1."), F.substring("customer_id", 6, 1), F.lit("39)"))
    )
    assert rows(reports.top_drivers(scored, DAY)) == [("tenure (high risk)", 6, 80.0)]


def test_retention_roi(predictions, sample):
    # 85.70 + 99.65 + 79.85 + 75.40
    assert rows(reports.retention_roi(predictions, sample, DAY)) == [
        (4, Decimal("340.60"), Decimal("102.18"), Decimal("81.74"), Decimal("980.93"))
    ]


def test_no_run_gives_empty_reports(predictions, sample):
    none = date(2000, 1, 1)
    assert rows(reports.call_list(predictions, sample, none)) == []
    assert rows(reports.segments(predictions, sample, none)) == []
    assert rows(reports.executive_summary(predictions, sample, none)) == [
        (none, 0, None, None, None, None, None, None)
    ]
    assert rows(reports.retention_roi(predictions, sample, none)) == [(0, None, None, None, None)]


def test_today_is_the_default(spark, sample):
    today = spark.sql("SELECT current_date()").first()[0]
    fresh = make(spark, [("CUST-0001", today, "v1", 0.8), ("CUST-0002", DAY, "v1", 0.8)])
    assert rows(reports.executive_summary(fresh, sample))[0][:3] == (today, 1, 1)


def test_segments_need_a_minimum_size(predictions, sample):
    found = rows(reports.segments(predictions, sample, DAY, min_segment=3))
    assert found == [("Month-to-month", "Fiber optic", "New (< 6 mo)", 3, 3, 100.0, 88.4)]
    assert reports.segments(predictions, sample, DAY).count() == 0


def test_weeks_start_on_monday(spark, sample):
    days = [date(2024, 1, 7), date(2024, 1, 8), date(2024, 1, 14)]
    scored = make(spark, [(f"CUST-{i:04d}", d, "v1", 0.9) for d in days for i in (1, 2)])
    assert rows(reports.weekly_trend(scored, sample)) == [
        (date(2024, 1, 8), 2, 2.0, 185.35),
        (date(2024, 1, 1), 1, 2.0, 185.35),
    ]
    assert rows(reports.weekly_trend(scored, sample, "v2")) == []


def test_daily_summary_and_drivers(predictions):
    summary = rows(reports.daily_summary(predictions))
    assert [s[0] for s in summary] == [DAY, DAY - timedelta(days=1)]
    assert all(s[4] + s[5] + s[6] == s[1] for s in summary)
    assert rows(reports.top_drivers(predictions, DAY)) == [("tenure", 7, 72.1)]


def test_tracking_cells_add_up(predictions, sample):
    for row in rows(reports.model_tracking(predictions, sample)):
        assert row[2] == sum(row[3:7])
        assert row[7] == round((row[3] + row[5]) * 100 / row[2], 2)


def test_one_customer_with_a_third_of_all_rows(spark, predictions, sample):
    """The hot customer is one row before the join, and the figures still count every row."""
    hot = make(spark, [("CUST-0001", DAY, f"v{i}", 0.9) for i in range(500)])
    rest = make(spark, [(f"CUST-{i:04d}", DAY, f"v{v}", 0.1) for i in range(2, 11) for v in range(100)])
    both = hot.unionByName(rest)
    summary = rows(reports.executive_summary(both, sample, DAY))[0]
    assert summary[:3] == (DAY, 1400, 500) and summary[4] == Decimal("42850.00")
    assert rows(reports.retention_roi(both, sample, DAY))[0][:2] == (500, Decimal("42850.00"))
    assert sum(r[3] for r in rows(reports.segments(both, sample, DAY, 1))) == 1400


def test_sql_over_the_registered_names(spark, predictions, sample):
    views.register(sample, predictions, as_of=DAY)
    counted = spark.sql(
        """SELECT (SELECT count(*) FROM v_at_risk_customers) AS at_risk,
                  (SELECT sum(churn_encoded) FROM churn_features) AS churned,
                  (SELECT sum(total_scored) FROM v_daily_churn_summary) AS scored,
                  (SELECT count(*) FROM churn_predictions p JOIN customers USING (customer_id)) AS known"""
    )
    assert rows(counted) == [(6, 5, 12, 11)]
