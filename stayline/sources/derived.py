"""Subscribers and scoring runs derived from the order tables, one subscriber per customer row.

The test tables hold orders, not subscribers; every category, blank, null and band edge the
operators care about is derived from the customer key, the balance and the order history.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.rules import recommended_action
from stayline.schemas import CUSTOMER_COLUMNS

AS_OF = date(2024, 1, 10)
FIRST_RUN = date(2024, 1, 4)
RUNS = 14
SECOND_VERSION_FROM = 9
VERSIONS = ("gbt_v1", "gbt_v2")
TASK_ROWS = 1 << 16  # customers of one task at most, as they are dealt out
LEAST_ROWS = 1 << 12  # fewer are not worth another task


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tasks_for(rows: int, cores: int) -> int:
    """Tasks for so many customers: all cores once there are rows for them, then whole rounds of them, none with too many."""
    if rows <= cores * LEAST_ROWS:
        return max(1, -(-rows // LEAST_ROWS))
    return -(-rows // (TASK_ROWS * cores)) * cores


def dealt_out(customers: DataFrame, rows: int) -> DataFrame:
    """The customers in tasks of bounded size, by id.

    A table of one file would be read by one task, and the adaptive plan joins small shuffle partitions into few; what
    follows, fourteen scores a customer or a model's explanation, is many times the size of what they have read.
    """
    tasks = tasks_for(rows, customers.sparkSession.sparkContext.defaultParallelism)
    return customers.repartition(tasks, "customer_id") if tasks > 1 else customers


def subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """The 21 business columns. Orders are reduced to one row per customer before the join."""
    orders = table(spark, folder, "orders")
    month = "year({0}) * 12 + month({0})"
    last = orders.groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_orderdate").alias("last_order")
    )
    newest = orders.agg(F.expr(month.format("max(o_orderdate)"))).scalar()
    base = table(spark, folder, "customer").selectExpr(
        "c_custkey AS k",
        "c_nationkey AS nation",
        "int(c_custkey * 37 % 73) AS tenure",
        "1825 + (bigint(round(c_acctbal * 100)) + 100000) % 10001 AS cents",
        """CASE WHEN c_custkey * 7919 % 100 < 55 THEN 'Month-to-month'
                WHEN c_custkey * 7919 % 100 < 76 THEN 'One year' ELSE 'Two year' END AS contract""",
        """CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Fiber optic'
                WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'DSL'
                ELSE 'No' END AS internet_service""",
        """CASE (c_custkey * 31 + c_nationkey) % 4 WHEN 0 THEN 'Electronic check'
                WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)'
                ELSE 'Credit card (automatic)' END AS payment_method""",
    )
    since = F.coalesce(
        F.least(F.lit(24), newest - F.expr(month.format("last_order"))), F.lit(24)
    )
    points = F.expr(
        """CASE contract WHEN 'Month-to-month' THEN 30 WHEN 'One year' THEN 8 ELSE 0 END
         + CASE WHEN tenure < 12 THEN 20 WHEN tenure < 24 THEN 8 ELSE 0 END
         + if(internet_service = 'Fiber optic', 12, 0)
         + if(payment_method = 'Electronic check', 8, 0)"""
    )

    def add_on(factor: int, modulus: int, below: int) -> str:
        return f"""CASE WHEN internet_service = 'No' THEN 'No internet service'
                        WHEN k * {factor} % {modulus} < {below} THEN 'Yes' ELSE 'No' END"""

    columns = {
        "customer_id": "concat('CUST-', lpad(string(k), greatest(8, length(string(k))), '0'))",
        "gender": "if(k % 2 = 0, 'Male', 'Female')",
        "senior_citizen": "if(k * 17 % 100 < 16, 1, 0)",
        "partner": "if(nation % 2 = 0, 'Yes', 'No')",
        "dependents": "if((k * 11 + nation) % 10 < 3, 'Yes', 'No')",
        "phone_service": "if(k * 13 % 10 < 9, 'Yes', 'No')",
        "multiple_lines": """CASE WHEN k * 13 % 10 >= 9 THEN 'No phone service'
                                  WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END""",
        "online_security": add_on(3, 7, 3),
        "online_backup": add_on(5, 11, 5),
        "device_protection": add_on(7, 13, 6),
        "tech_support": add_on(9, 17, 7),
        "streaming_tv": add_on(2, 19, 9),
        "streaming_movies": add_on(4, 23, 11),
        "paperless_billing": "if(k * 19 % 10 < 6, 'Yes', 'No')",
        "monthly_charges": "CAST(cents / 100.0D AS DECIMAL(8, 2))",
        "total_charges": """CASE WHEN NOT (tenure = 0 OR k % 97 = 5)
            THEN CAST((cents * tenure + k * 13 % 500) / 100.0D AS DECIMAL(10, 2)) END""",
        "churn": "CASE WHEN k % 50 <> 7 THEN if(points + k * 101 % 30 >= 64, 'Yes', 'No') END",
    }
    made = (
        base.join(last, "k", "left")
        .withColumn("points", points + since)
        .selectExpr(*[f"{columns.get(c, c)} AS {c}" for c in CUSTOMER_COLUMNS])
    )
    # The number of customers is in the files' footers.
    return dealt_out(made, base.count())


def raw_subscribers(spark: SparkSession, folder: str) -> DataFrame:
    """As a file delivers them: totals as text with blanks and junk, labels and genders padded."""
    key = "bigint(substring(customer_id, 6))"
    changed = {
        "total_charges": f"""CASE WHEN total_charges IS NULL THEN if({key} % 2 = 0, '', '  ')
            WHEN {key} % 89 = 3 THEN 'n/a'
            WHEN {key} % 5 = 0 THEN concat(' ', string(total_charges), ' ')
            ELSE string(total_charges) END""",
        "churn": f"if({key} % 4 = 1, concat(churn, ' '), churn)",
        "gender": f"if({key} % 3 = 1, concat('  ', gender), gender)",
    }
    return subscribers(spark, folder).selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in CUSTOMER_COLUMNS]
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Fourteen daily runs; each customer is scored on about two days in three."""
    monthly, short = "contract = 'Month-to-month'", "tenure < 12"
    fiber = "internet_service = 'Fiber optic'"
    scored = (
        subscribers(spark, folder)
        .selectExpr(
            "customer_id",
            "bigint(substring(customer_id, 6)) AS k",
            f"""if({monthly}, 3000, 500) + if({short}, 2500, 0) + if({fiber}, 1200, 0) AS points""",
            f"""transform(filter(array(if({monthly}, 'contract_month_to_month', NULL),
                                       if({short}, 'tenure', NULL),
                                       if({fiber}, 'internet_fiber_optic', NULL)),
                                 name -> name IS NOT NULL),
                          name -> concat(name, ' (high risk, SHAP=+0.',
                            lpad(string(bigint(substring(customer_id, 6)) % 1000), 3, '0'), ')')) AS reasons""",
            f"explode(sequence(0, {RUNS - 1})) AS d",
        )
        .filter("(k + d) % 3 <> 1")
        .withColumn("bp", F.expr("least(9999, greatest(1, points + (k * 7919 + d * 104729) % 3500))"))
        .withColumn("churn_probability", F.expr("CAST(bp / 10000.0D AS DECIMAL(5, 4))"))
    )
    return scored.select(
        "customer_id",
        F.expr(f"date_add(DATE '{FIRST_RUN}', d) AS run_date"),
        F.expr(f"if(d < {SECOND_VERSION_FROM}, '{VERSIONS[0]}', '{VERSIONS[1]}') AS model_version"),
        "churn_probability",
        F.expr("if(bp >= 5000, 1, 0) AS churn_prediction"),
        F.expr("CASE WHEN bp > 6500 THEN 'HIGH' WHEN bp > 4000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier"),
        *[F.expr(f"get(reasons, {n}) AS top_reason_{n + 1}") for n in range(3)],
        recommended_action(F.col("churn_probability")).alias("recommended_action"),
    )
