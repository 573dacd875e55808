"""Tables that change at once, and the foreign key that is checked before they do."""

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayline.operators.quality import unknown_parents
from stayline.sources import tables, versions
from test_tables import RUN, scores, stored

def half_failing(spark):
    """Scores whose write fails after some of its files are there."""
    good = scores(spark, *[(f"n{i:03d}", 0.5) for i in range(200)]).repartition(4)
    fails = F.raise_error(F.lit("lost")).cast("double")
    return good.withColumn("churn_probability", F.when(F.col("customer_id") == "n199", fails).otherwise(0.5))


def people(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id string")


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("part-*.parquet"))


def test_a_write_that_fails_midway_leaves_the_old_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.publish_run(scores(spark, ("a", 0.9), ("b", 0.2)), path, RUN)
    before, old = stored(spark, path), tables.read_predictions(spark, path)
    kept = files(path)
    with pytest.raises(Exception, match="lost"):
        tables.publish_run(half_failing(spark), path, RUN)
    assert stored(spark, path) == before and files(path) == kept
    tables.publish_run(scores(spark, ("c", 0.1)), path, RUN)
    assert [r[0] for r in stored(spark, path)] == ["c"]
    # A reader that has begun goes on with the version it began with.
    assert sorted(r["customer_id"] for r in old.collect()) == ["a", "b"]


def test_a_full_refresh_that_fails_leaves_the_old_table(spark, tmp_path, sample):
    path = str(tmp_path / "customers")
    tables.store_customers(sample, path)
    with pytest.raises(Exception, match="null in contract"):
        tables.store_customers(sample.withColumn("contract", F.when(F.col("tenure") > 5, F.col("contract"))), path)
    assert tables.read_table(spark, path).count() == 10


def test_a_writer_that_dies_before_the_marker_is_not_seen(spark, tmp_path):
    path, part = str(tmp_path / "runs"), "run_date=2024-01-10/model_version=gbt_v1"
    tables.publish_run(scores(spark, ("a", 0.9)), path, RUN)
    dead = versions.stage(tables.conform(scores(spark, ("x", 0.9)), tables.RUN_BODY), path, part)
    assert [r[0] for r in stored(spark, path)] == ["a"]
    versions.publish(spark, path, part, dead)
    assert [r[0] for r in stored(spark, path)] == ["x"]
    with pytest.raises(ValueError, match="no version"):
        versions.publish(spark, path, part, "0" * 32)


def test_two_publishers_never_mix_files(spark, tmp_path):
    """Both stage, then both publish, in either order and at the same number."""
    path = str(tmp_path / "table")
    first, second = (versions.stage(people(spark, *[f"{w}{i}" for i in range(50)]).repartition(3), path) for w in "pq")
    for winner, order in (("q", (first, second)), ("p", (second, first))):
        for version in order:
            versions.publish(spark, path, "", version)
        assert {r["customer_id"][0] for r in versions.read_current(spark, path).collect()} == {winner}
    # The same number: one of them wins, whole, and every reader sees the same one.
    last = max(os.listdir(f"{path}/_published"))
    number = last.split(".")[0]
    for version in (first, second):
        Path(f"{path}/_published/{number}.{version}").touch()
    rows = [r["customer_id"] for r in versions.read_current(spark, path).collect()]
    assert len(rows) == 50 and len({r[0] for r in rows}) == 1


def test_runs_are_published_beside_each_other(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day, version in ((10, "gbt_v1"), (10, "gbt_v2"), (11, "gbt_v1")):
        tables.publish_run(scores(spark, ("a", day / 20)), path, date(2024, 1, day), version)
    before = versions.current(spark, path)
    tables.publish_run(scores(spark, ("b", 0.1)), path, RUN, "gbt_v2")
    after = versions.current(spark, path)
    assert {part for part in before if before[part] != after[part]} == {"run_date=2024-01-10/model_version=gbt_v2"}
    assert stored(spark, path) == [("a", "2024-01-10", "gbt_v1", 0.5), ("a", "2024-01-11", "gbt_v1", 0.55), ("b", "2024-01-10", "gbt_v2", 0.1)]


def test_nothing_published(spark, tmp_path):
    assert tables.read_predictions(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="nothing"):
        tables.read_table(spark, str(tmp_path / "none"))


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "runs")
    for p in (0.1, 0.2, 0.3, 0.4):
        tables.publish_run(scores(spark, ("a", p)), path, RUN)
    tables.publish_run(scores(spark, ("a", 0.5)), path, date(2024, 1, 11))
    versions.stage(tables.conform(scores(spark, ("dead", 0.5)), tables.RUN_BODY), path, "run_date=2024-01-12/model_version=gbt_v1")
    assert versions.expire(spark, path, keep=1, hours=1) == []
    assert len(versions.expire(spark, path, keep=2, hours=-1)) == 3  # two old ones and the dead one
    assert stored(spark, path) == [("a", "2024-01-10", "gbt_v1", 0.4), ("a", "2024-01-11", "gbt_v1", 0.5)]
    assert len({f.rpartition("/")[0] for f in files(path)}) == 3
    tables.publish_run(scores(spark, ("a", 0.6)), path, RUN)
    assert stored(spark, path)[0][3] == 0.6
    with pytest.raises(ValueError):
        versions.expire(spark, path, keep=0)


def test_an_unknown_customer_aborts_the_run(spark, tmp_path, sample):
    path = str(tmp_path / "runs")
    tables.publish_run(scores(spark, ("a", 0.9)), path, RUN, customers=people(spark, "a", "b"))
    kept = files(path)
    with pytest.raises(ValueError, match="unknown customers.*'z'"):
        tables.publish_run(scores(spark, ("a", 0.1), ("z", 0.2)), path, RUN, customers=people(spark, "a", "b"))
    assert stored(spark, path) == [("a", "2024-01-10", "gbt_v1", 0.9)] and files(path) == kept
    from stayline.operators.features import feature_table

    features = str(tmp_path / "features")
    tables.refresh_features(feature_table(sample), features, sample)
    with pytest.raises(ValueError, match="unknown"):
        tables.refresh_features(feature_table(sample), features, sample.filter("customer_id <> 'CUST-0001'"))
    assert tables.read_table(spark, features).count() == 10 and len(os.listdir(f"{features}/_versions")) == 1


def test_unknown_customers_go_to_quarantine(spark, tmp_path):
    path, aside = str(tmp_path / "runs"), str(tmp_path / "aside")
    rows = scores(spark, ("a", 0.9), ("z", 0.2), ("z", 0.4), ("y", 0.3), ("a", 0.5), ("b", 0.1))
    tables.publish_run(rows, path, RUN, customers=people(spark, "a", "b"), quarantine=aside)
    assert [(r[0], r[3]) for r in stored(spark, path)] == [("a", 0.9), ("b", 0.1)]
    assert [(r[0], r[3]) for r in stored(spark, aside)] == [("y", 0.3), ("z", 0.4)]
    # The run again, now with the customers known: nothing stays aside.
    tables.publish_run(rows, path, RUN, customers=people(spark, "a", "b", "y", "z"), quarantine=aside)
    assert [r[0] for r in stored(spark, path)] == ["a", "b", "y", "z"] and stored(spark, aside) == []


def test_the_foreign_key_is_exact_behind_a_bloom_filter(spark, tmp_path):
    """Spark's own filter stands before the parents' shuffle; even one that lets everything through changes nothing."""
    people(spark, *[f"C{i}" for i in range(20_000)]).write.parquet(str(tmp_path / "parents"))
    people(spark, *[f"C{i}" for i in range(19_990, 20_010)]).write.parquet(str(tmp_path / "children"))
    parents, children = (spark.read.parquet(str(tmp_path / n)) for n in ("parents", "children"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in [*conf, "spark.sql.optimizer.runtime.bloomFilter.maxNumBits"]}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        for bits in ("67108864", "8"):  # with 8 bits all parents pass: false positives
            spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.maxNumBits", bits)
            found = unknown_parents(children, parents)
            assert sorted(r["customer_id"] for r in found.collect()) == sorted(f"C{i}" for i in range(20_000, 20_010))
            text = found._jdf.queryExecution().optimizedPlan().toString()
            assert "might_contain" in text.split("Join LeftOuter")[1].split("parents")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
