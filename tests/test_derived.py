"""Subscribers derived from keys of any length."""

from pyspark.sql import functions as F

from stayline.plans.catalog import catalog
from stayline.sources import derived
from stayline.sources.derived import predictions, subscribers


def test_ids_of_long_keys_stay_apart(spark, tiny, tmp_path):
    keys = [7, 10_000_000, 100_000_000, 100_000_001, 100_000_009, 10**10, 10**10 + 1]
    source = spark.read.parquet(f"{tiny}/customer.parquet").limit(1).drop("c_custkey")
    rows = spark.createDataFrame([(k,) for k in keys], "c_custkey long").join(source, F.lit(True))
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    spark.read.parquet(f"{tiny}/orders.parquet").write.parquet(str(tmp_path / "orders.parquet"))
    found = {r["customer_id"] for r in subscribers(spark, str(tmp_path)).collect()}
    assert len(found) == len(keys) and {"CUST-00000007", "CUST-100000001", "CUST-10000000001"} <= found
    assert {r["surplus_rows"] for r in catalog()["dq_duplicate_keys"](spark, str(tmp_path)).collect()} == {0}
    scored = predictions(spark, str(tmp_path))
    assert scored.select("customer_id").distinct().count() == len(keys)


def test_customers_of_one_file_are_dealt_out_in_tasks_of_bounded_size(spark, tmp_path):
    n = 3 * derived.LEAST_ROWS
    customer = ["id AS c_custkey", "id % 25 AS c_nationkey", "CAST(id % 900 AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment"]
    spark.range(n).selectExpr(*customer).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(50).selectExpr("id AS o_orderkey", "id AS o_custkey", "DATE '2024-01-01' AS o_orderdate").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    for made, rows in ((derived.subscribers, n), (derived.predictions, None)):
        tasks = [r["n"] for r in made(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(tasks) == 3 and max(tasks) < 1.5 * min(tasks) and rows in (None, sum(tasks))


def test_the_rows_of_a_task_are_bounded_whatever_the_table():
    assert [derived.tasks_for(n, 12) for n in (0, 4096, 4097, 90_000, 900_000)] == [1, 1, 2, 12, 24]
    assert all(n / derived.tasks_for(n, 12) <= derived.TASK_ROWS for n in (5_400_000, 10**9))
