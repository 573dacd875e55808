"""Reports from the sums of runs equal the reports over all rows, and read no run but the new one."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stayline.plans import daily, reports
from stayline.sources import tables
from stayline.sources.derived import predictions, subscribers


@pytest.fixture(scope="module")
def base(spark, tiny):
    customers = subscribers(spark, tiny).cache()
    scores = predictions(spark, tiny).cache()
    yield customers, scores
    # Other tests look at the plans of the same tables.
    customers.unpersist()
    scores.unpersist()


def publish(base, folder, day, version, rows=None):
    customers, scores = base
    run = scores.filter((F.col("run_date") == day) & (F.col("model_version") == version)) if rows is None else rows
    daily.publish_run_with_sums(run.drop("created_at"), customers, f"{folder}/runs", f"{folder}/sums", day, version)


def same(left, right):
    assert left.columns == right.columns
    assert [tuple(r) for r in left.collect()] == [tuple(r) for r in right.collect()]


def compare(spark, base, folder):
    customers = base[0]
    sums, runs = daily.read_sums(spark, f"{folder}/sums"), tables.read_predictions(spark, f"{folder}/runs")
    same(daily.daily_summary(sums), reports.daily_summary(runs))
    same(daily.weekly_trend(sums), reports.weekly_trend(runs, customers))
    same(daily.weekly_trend(sums, "gbt_v2"), reports.weekly_trend(runs, customers, "gbt_v2"))
    same(daily.model_tracking(sums), reports.model_tracking(runs, customers))


def test_reports_from_sums_equal_full_recomputation_also_after_a_rerun(spark, base, tmp_path):
    _, scores = base
    runs = [tuple(r) for r in scores.select("run_date", "model_version").distinct().orderBy("run_date", "model_version").limit(4).collect()]
    for day, version in runs:
        publish(base, tmp_path, day, version)
    publish(base, tmp_path, runs[0][0], "gbt_v2", scores.filter(F.col("run_date") == runs[1][0]).drop("run_date", "model_version"))
    compare(spark, base, tmp_path)
    # An old day again, with other scores, some of customers that are not on file.
    strange = spark.createDataFrame([("nobody", 0.9, 1, "HIGH")], "customer_id string, churn_probability double, churn_prediction int, risk_tier string")
    old = scores.filter(F.col("run_date") == runs[2][0]).limit(20).select(*strange.columns)
    publish(base, tmp_path, *runs[1], old.unionByName(strange))
    compare(spark, base, tmp_path)
    # A run without rows, and one of strangers only.
    publish(base, tmp_path, *runs[2], old.limit(0))
    publish(base, tmp_path, runs[0][0] + timedelta(days=30), "gbt_v9", strange)
    compare(spark, base, tmp_path)


def test_only_the_new_run_is_read(spark, base, tmp_path, monkeypatch):
    _, scores = base
    days = [r[0] for r in scores.select("run_date").distinct().orderBy("run_date").limit(3).collect()]
    one = scores.filter(F.col("run_date") == days[0]).drop("run_date", "model_version")
    for day in days:
        publish(base, tmp_path, day, "gbt_v1", one)
    seen = []
    run_sums = daily.run_sums
    monkeypatch.setattr(daily, "run_sums", lambda run, customers: seen.append(run) or run_sums(run, customers))
    publish(base, tmp_path, date(2031, 1, 1), "gbt_v1", one)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
    files = {name for name in seen[0].select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert files and all("run_date=2031-01-01/model_version=gbt_v1" in name for name in files)
    # A report reads sums only.
    report = daily.daily_summary(daily.read_sums(spark, f"{tmp_path}/sums"))
    assert all("/sums/_versions/" in name for name in report.inputFiles()) and report.count() == 4


def test_nothing_published_yet(spark, tmp_path):
    sums = daily.read_sums(spark, str(tmp_path / "sums"))
    assert daily.daily_summary(sums).count() == daily.weekly_trend(sums).count() == daily.model_tracking(sums).count() == 0
