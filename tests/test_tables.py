from datetime import date

import pytest
from pyspark.sql import functions as F
from samples import RAW

from stayline.operators.cleaning import clean
from stayline.operators.features import feature_table, model_matrix
from stayline.plans import reports
from stayline.schemas import CHURN_FEATURES, CHURN_PREDICTIONS, CUSTOMERS
from stayline.sources import tables

RUN = date(2024, 1, 10)


def scores(spark, *rows):
    return spark.createDataFrame(
        [(c, p, int(p >= 0.5), "LOW") for c, p in rows],
        "customer_id string, churn_probability double, churn_prediction int, risk_tier string",
    )


def stored(spark, path):
    rows = tables.read_predictions(spark, path).collect()
    return sorted(
        (r["customer_id"], str(r["run_date"]), r["model_version"], float(r["churn_probability"]))
        for r in rows
    )


def test_blank_is_null_and_bad_numbers_abort(spark, tmp_path, raw):
    assert raw.filter("total_charges IS NULL").count() == 1
    path = tmp_path / "bad.csv"
    path.write_text(",".join(raw.columns) + "\n" + ",".join(["C9"] + ["x"] * 20) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_customers_csv(spark, str(path)).collect()
    assert tables.read_customers_csv(spark, str(path), strict=False).first()["tenure"] is None


def test_columns_are_found_by_their_headers(spark, tmp_path):
    header, first, *_ = RAW.splitlines()
    pairs = list(zip(header.split(","), first.split(",")))
    swapped = pairs[:3] + [pairs[4], pairs[3]] + pairs[5:][::-1]

    def written(name, columns):
        path = tmp_path / name
        path.write_text("\n".join(",".join(p[k] for p in columns) for k in (0, 1)) + "\n")
        return str(path)

    plain = tables.read_customers_csv(spark, written("plain.csv", pairs)).first()
    assert tables.read_customers_csv(spark, written("swapped.csv", swapped)).first() == plain
    assert (plain["partner"], plain["dependents"]) == ("Yes", "No")
    unlabelled = tables.read_customers_csv(spark, written("unlabelled.csv", pairs[:-1])).first()
    assert unlabelled["churn"] is None and unlabelled["tenure"] == 1
    for name, columns, message in (
        ("missing.csv", pairs[1:], "missing .'customer_id'"),
        ("unknown.csv", [*pairs, ("Colour", "red")], "unknown headers .'Colour'"),
        ("twice.csv", [*pairs, ("customer_id", "C9")], "repeated .'customer_id'"),
    ):
        with pytest.raises(ValueError, match=message):
            tables.read_customers_csv(spark, written(name, columns))
    by_place = tables.read_customers_csv(spark, written("place.csv", [(f"c{i}", v) for i, (_, v) in enumerate(pairs)]), by_position=True)
    assert by_place.first() == plain


def test_every_file_must_have_the_same_header(spark, tmp_path):
    header, first, second, *_ = RAW.splitlines()
    names = header.split(",")
    names[3], names[4] = names[4], names[3]
    (tmp_path / "a.csv").write_text(f"{header}\n{first}\n")
    (tmp_path / "b.csv").write_text(f"{','.join(names)}\n{second}\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_customers_csv(spark, str(tmp_path)).collect()


def test_required_values_may_not_be_null(spark, tmp_path, sample):
    with pytest.raises(Exception, match="null in contract"):
        tables.store_customers(sample.withColumn("contract", F.lit(None).cast("string")), str(tmp_path / "c"))
    with pytest.raises(ValueError, match="churn_prediction"):
        tables.publish_run(scores(spark, ("a", 0.9)).drop("churn_prediction"), str(tmp_path / "r"), RUN)
    unknown = scores(spark, ("a", 0.9)).withColumn("churn_probability", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null in churn_probability"):
        tables.publish_run(unknown, str(tmp_path / "r"), RUN)
    other = scores(spark, ("a", 0.9)).withColumn("model_version", F.lit("gbt_v9"))
    with pytest.raises(Exception, match="another run"):
        tables.publish_run(other, str(tmp_path / "r"), RUN)
    with pytest.raises(ValueError, match="model version"):
        tables.publish_run(scores(spark, ("a", 0.9)), str(tmp_path / "r"), RUN, "a/b")


def test_a_run_without_rows_empties_its_own_partition(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = scores(spark, ("a", 0.9), ("b", 0.2))
    tables.publish_run(first, path, RUN)
    tables.publish_run(first, path, date(2024, 1, 11))
    tables.publish_run(first.limit(0), path, RUN)
    assert {r[1] for r in stored(spark, path)} == {"2024-01-11"}


def test_literal_rows(spark):
    row = ["X1", "Male", 0, "No", "No", 2, "Yes", "No", "DSL"] + ["No"] * 6
    row += ["One year", "Yes", "Mailed check", 50.5, None, None]
    made = tables.sample_customers(spark, [tuple(row)])
    assert made.schema["monthly_charges"].dataType.simpleString() == "decimal(8,2)"
    assert made.first()["total_charges"] is None


def test_customers_are_stored_with_defaults(spark, tmp_path, sample):
    path = str(tmp_path / "customers")
    tables.store_customers(sample.withColumn("senior_citizen", F.lit(None).cast("int")), path)
    back = tables.read_table(spark, path)
    assert back.columns == CUSTOMERS.names
    assert {r["senior_citizen"] for r in back.collect()} == {0}
    assert back.filter("created_at IS NULL").count() == 0


def test_features_are_refreshed_whole(spark, tmp_path, sample):
    path = str(tmp_path / "features")
    tables.refresh_features(feature_table(sample), path)
    tables.refresh_features(feature_table(sample.limit(3)), path)
    back = tables.read_table(spark, path)
    assert back.columns == CHURN_FEATURES.names
    assert back.count() == 3


def test_clean_and_matrix_round_trip(spark, tmp_path, raw):
    cleaned = clean(raw)
    tables.store_clean(cleaned, str(tmp_path / "clean"))
    tables.store_matrix(model_matrix(cleaned), str(tmp_path / "matrix"))
    assert tables.read_table(spark, str(tmp_path / "clean")).exceptAll(cleaned).count() == 0
    assert tables.read_table(spark, str(tmp_path / "matrix")).count() == 4


def test_export_is_in_key_order_across_files(spark, tmp_path, sample):
    path = tmp_path / "export"
    tables.export_csv(feature_table(sample).repartition(3), str(path))
    lines = [
        line.split(",")[0]
        for part in sorted(path.glob("part-*.csv"))
        for line in part.read_text().splitlines()[1:]
    ]
    assert lines == sorted(lines) and len(lines) == 10


def test_publishing_a_run_again_changes_nothing_else(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = scores(spark, ("a", 0.9), ("b", 0.2))
    tables.publish_run(first, path, RUN)
    tables.publish_run(first, path, date(2024, 1, 11))
    tables.publish_run(scores(spark, ("a", 0.4)), path, RUN, "gbt_v2")
    once = stored(spark, path)
    tables.publish_run(first, path, RUN)
    assert stored(spark, path) == once
    assert len(once) == 5
    tables.publish_run(scores(spark, ("c", 0.1)), path, RUN)
    assert [r for r in stored(spark, path) if r[1:3] == ("2024-01-10", "gbt_v1")] == [
        ("c", "2024-01-10", "gbt_v1", 0.1)
    ]


def test_a_customer_scored_twice_is_published_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.publish_run(scores(spark, ("a", 0.3), ("a", 0.8), ("a", 0.5)), path, RUN)
    assert stored(spark, path) == [("a", "2024-01-10", "gbt_v1", 0.8)]
    assert tables.read_predictions(spark, path).columns == CHURN_PREDICTIONS.names


def test_the_run_date_picks_folders(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day in (10, 11, 12):
        tables.publish_run(scores(spark, ("a", 0.9)), path, date(2024, 1, day))
    one = tables.read_predictions(spark, path).filter(F.col("run_date") == RUN)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan
    assert len(one.inputFiles()) >= 1 and one.count() == 1


def test_reports_read_only_what_they_need(spark, tmp_path, sample):
    tables.store_customers(sample, str(tmp_path / "customers"))
    tables.publish_run(scores(spark, ("CUST-0001", 0.9)), str(tmp_path / "runs"), RUN)
    runs = tables.read_predictions(spark, str(tmp_path / "runs"))
    customers = tables.read_table(spark, str(tmp_path / "customers"))

    summary = reports.executive_summary(runs, customers, RUN)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,monthly_charges:decimal(8,2)>" in plan
    assert "ReadSchema: struct<customer_id:string,churn_prediction:int,risk_tier:string>" in plan

    drivers = reports.top_drivers(runs, RUN)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(churn_prediction,1)" in drivers and "IsNotNull(top_reason_1)" in drivers
    assert "run_date" in drivers[drivers.index("PartitionFilters") :]


def test_bucketed_tables_join_without_a_shuffle(spark, sample):
    """The same reports over bucketed tables; publishing again replaces only its own partition."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    scored = scores(spark, *[(f"CUST-{i:04d}", i / 10) for i in range(1, 10)])
    try:
        for name in ("bucketed_customers", "bucketed_runs"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        tables.store_customers_bucketed(sample, "bucketed_customers", 4)
        for version in ("gbt_v1", "gbt_v2", "gbt_v1"):
            tables.publish_run_bucketed(scored, "bucketed_runs", 4, RUN, version)
        runs = spark.table("bucketed_runs")
        assert runs.count() == 18
        tables.publish_run_bucketed(scored, "bucketed_runs", 4, date(2024, 1, 11), "gbt_v1")
        tables.publish_run_bucketed(scored.limit(0), "bucketed_runs", 4, date(2024, 1, 11), "gbt_v1")
        assert runs.count() == 18
        assert set(runs.columns) == set(CHURN_PREDICTIONS.names)
        report = reports.model_tracking(runs, spark.table("bucketed_customers"))
        plan = report._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin") :]
        assert "Exchange" not in join
        assert [r["total_predictions"] for r in report.collect()] == [9, 9]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucketed_customers", "bucketed_runs"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
