"""Reading and writing the three tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators.quality import duplicate_keys, require_columns, unknown_parents
from stayline.schemas import (
    CHURN_FEATURES,
    CHURN_PREDICTIONS,
    CUSTOMERS,
    RAW_CUSTOMERS,
    REQUIRED,
    RUN_KEY,
    stored_name,
)
from stayline.sources import versions

RUN_PARTITIONS = ["run_date", "model_version"]


def read_customers_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_CUSTOMERS,
    strict: bool = True,
    by_position: bool = False,
    optional: Sequence[str] = ("churn",),
) -> DataFrame:
    """Columns found by their header, in any order; empty means null; a bad number aborts if strict.

    Headers are matched by ``stored_name``. A header that names no column, two that name the same one
    and a missing column are errors; an ``optional`` column may be missing and is null then. Of
    several files each must have the header of the first. ``by_position`` ignores the header and
    takes the columns in the order of the schema.
    """
    reader = (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )
    if by_position:
        return reader.schema(schema).csv(path)
    found = spark.read.option("header", True).csv(path).columns
    names = [stored_name(header) for header in found]
    wanted = {f.name: f for f in schema}
    unknown = [header for header, name in zip(found, names) if name not in wanted]
    missing = sorted(set(wanted) - set(names) - set(optional))
    twice = sorted({name for name in names if names.count(name) > 1})
    if unknown or missing or twice:
        raise ValueError(f"{path}: unknown headers {unknown}, missing {missing}, repeated {twice}")
    in_file = T.StructType([T.StructField(h, wanted[n].dataType) for h, n in zip(found, names)])
    rows = reader.schema(in_file).option("enforceSchema", False).csv(path)
    return conform(rows.toDF(*names), schema)


def sample_customers(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Hand-made rows in file order, typed like the stored table."""
    business = T.StructType(CUSTOMERS.fields[:21])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in business])
    frame = spark.createDataFrame([[None if v is None else str(v) for v in row] for row in rows], text)
    return conform(frame, business)


def conform(df: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """The schema's columns in its order and types; a missing column is null.

    A missing ``required`` column is an error at once, a null in one when the row is written.
    """
    have = set(df.columns)
    require_columns(df, required)

    def column(field: T.StructField) -> Column:
        value = (F.col(field.name) if field.name in have else F.lit(None)).cast(field.dataType)
        if field.name in required:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in {field.name}")).cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema])


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill absent columns and null values, as a column default does on insert."""
    have = set(df.columns)
    filled = {}
    for name, value in defaults.items():
        default = value if not isinstance(value, (str, int, float, date)) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in have else default
    return df.withColumns(filled)


def store_customers(df: DataFrame, path: str) -> None:
    now = F.current_timestamp()
    full = with_defaults(df, {"senior_citizen": 0, "created_at": now, "updated_at": now})
    versions.replace(conform(full, CUSTOMERS, REQUIRED["customers"]), path)


def store_clean(df: DataFrame, path: str) -> None:
    versions.replace(df, path)


def refresh_features(features: DataFrame, path: str, customers: DataFrame | None = None) -> None:
    """Full refresh: the new table replaces the old one, at once.

    With ``customers``, a row of an unknown customer aborts the refresh and the old table stays.
    """
    spark = features.sparkSession
    stamped = with_defaults(features, {"created_at": F.current_timestamp()})
    staged = versions.stage(conform(stamped, CHURN_FEATURES), path)
    try:
        if customers is not None:
            _reject(unknown_parents(versions.read_version(spark, path, "", staged, CHURN_FEATURES), customers))
        versions.publish(spark, path, "", staged)
    except BaseException:
        versions.discard(spark, path, "", staged)
        raise


def store_matrix(matrix: DataFrame, path: str) -> None:
    versions.replace(matrix, path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as it was last stored in full, also while it is being stored again."""
    return versions.read_current(spark, path, schema)


def export_csv(df: DataFrame, path: str, key: str = "customer_id") -> None:
    """Part files in key order: a range-partitioned sort, never one writer."""
    df.orderBy(key).write.mode("overwrite").option("header", True).csv(path)


def run_of(spark: SparkSession, run_date: date | None, model_version: str) -> tuple[date, str]:
    """The run's day, today if left out, and its model version, which names a folder."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", model_version):
        raise ValueError(f"a model version is made of letters, digits, dots, _ and -: {model_version}")
    return run_date or spark.sql("SELECT current_date()").first()[0], model_version


def _run_rows(scores: DataFrame, run_date: date, model_version: str) -> DataFrame:
    """Published columns of one run. A required value that is null, or a row that says it belongs to
    another run, aborts the write."""
    run = {"run_date": F.lit(run_date), "model_version": F.lit(model_version)}
    stamped = with_defaults(scores, run)
    # On the key, which is always written: the run's own columns are its folders.
    other = F.raise_error(F.lit(f"a row of another run than {run_date} {model_version}"))
    for name in [c for c in run if c in scores.columns]:
        mine = F.when(F.col(name) == run[name], F.col("customer_id")).otherwise(other.cast("string"))
        stamped = stamped.withColumn("customer_id", mine)
    rows = conform(stamped, CHURN_PREDICTIONS, REQUIRED["churn_predictions"])
    return rows.withColumn("created_at", F.current_timestamp())


def _once(rows: DataFrame) -> DataFrame:
    """One row per customer of a run: the highest probability wins."""
    first = ["churn_probability"]
    values = first + [c for c in rows.columns if c not in (*first, "customer_id")]
    kept = rows.groupBy("customer_id").agg(F.max(F.struct(*values)).alias("kept"))
    return kept.select("customer_id", "kept.*").select(*rows.columns)


def _reject(unknown: DataFrame) -> None:
    """An error that names some of the unknown customers, if there are any."""
    some = [r["customer_id"] for r in unknown.select("customer_id").limit(5).collect()]
    if some:
        raise ValueError(f"unknown customers, such as {some}")


RUN_BODY = T.StructType([f for f in CHURN_PREDICTIONS if f.name not in RUN_PARTITIONS])


def publish_run(
    scores: DataFrame,
    path: str,
    run_date: date | None = None,
    model_version: str = "gbt_v1",
    customers: DataFrame | None = None,
    quarantine: str | None = None,
) -> None:
    """Replace the rows of this run date and model version, leave all others.

    The scores are computed once, into files that nobody reads yet. Their keys are then looked at: of a
    customer's rows one stays, and with ``customers`` each has to be one of them, else
    nothing is published. With ``quarantine`` the rows of unknown customers are stored there instead, as
    this run's, and the rest is published. Only then do readers see the run, all of it at once; a
    job that dies before leaves the run as it was. Publishing a run again cannot duplicate rows or flip
    them, and publishing it without rows leaves it without rows.
    """
    spark = scores.sparkSession
    day, version = run_of(spark, run_date, model_version)
    part = f"run_date={day}/model_version={version}"
    staged = versions.stage(_run_rows(scores, day, version).drop(*RUN_PARTITIONS), path, part)
    try:
        rows = versions.read_version(spark, path, part, staged, RUN_BODY)
        unknown = None if customers is None else unknown_parents(rows, customers)
        if unknown is not None and quarantine is None:
            _reject(unknown)
        repeated = not duplicate_keys(rows, ["customer_id"]).isEmpty()
        refused = unknown is not None and not unknown.isEmpty()
        if quarantine is not None:
            # Written even if empty: it replaces what this run left there before.
            versions.replace(rows.limit(0) if unknown is None else _once(unknown), quarantine, part)
        if repeated or refused:
            known = rows.join(unknown.select("customer_id").distinct(), "customer_id", "left_anti") if refused else rows
            better = versions.stage(_once(known).select(*RUN_BODY.names), path, part)
            versions.discard(spark, path, part, staged)
            staged = better
        versions.publish(spark, path, part, staged)
    except BaseException:
        versions.discard(spark, path, part, staged)
        raise


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The runs as published when this is called. A filter on ``run_date`` or ``model_version`` reads only
    the matching folders."""
    return conform(versions.read_current(spark, path, CHURN_PREDICTIONS), CHURN_PREDICTIONS)


def store_matrix_bucketed(matrix: DataFrame, table: str, buckets: int) -> None:
    """As a catalog table, hashed and sorted by customer: looking one up reads one bucket, and of that
    the row groups whose ids span the one asked for."""
    matrix.repartition(buckets, "customer_id").write.mode("overwrite").bucketBy(
        buckets, "customer_id"
    ).sortBy("customer_id").saveAsTable(table)


def store_customers_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """As a catalog table, hashed and sorted by customer: joins with bucketed runs do not shuffle."""
    conform(df, T.StructType(CUSTOMERS.fields[:21])).repartition(buckets, "customer_id").write.mode(
        "overwrite"
    ).bucketBy(buckets, "customer_id").sortBy("customer_id").saveAsTable(table)


def publish_run_bucketed(
    scores: DataFrame,
    table: str,
    buckets: int,
    run_date: date | None = None,
    model_version: str = "gbt_v1",
) -> None:
    """``publish_run`` into a catalog table with the customers' buckets inside each partition.

    A bucket holds whole customers. A run has one row per customer, so none of them is large.
    """
    spark = scores.sparkSession
    day, version = run_of(spark, run_date, model_version)
    body = [c for c in CHURN_PREDICTIONS.names if c not in RUN_PARTITIONS]
    rows = _run_rows(scores, day, version)
    if not duplicate_keys(rows, RUN_KEY).isEmpty():
        rows = _once(rows)
    if not spark.catalog.tableExists(table):
        (
            rows.limit(0)
            .select(*body, *RUN_PARTITIONS)
            .write.partitionBy(*RUN_PARTITIONS)
            .bucketBy(buckets, "customer_id")
            .sortBy("customer_id")
            .saveAsTable(table)
        )
    # A fixed partition is replaced even if there are no rows for it.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (run_date = DATE '{day}', model_version = '{version}')"
        f" SELECT {', '.join(body)} FROM {{rows}}",
        rows=rows.repartition(buckets, "customer_id"),
    )
