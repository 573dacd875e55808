"""Intermediate tables in the folder that all executors share, so that a lost executor costs nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.session import shared_folder

BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back: a cut in the lineage.

    The tables of an application lie in one folder, ``llm-<application>``, which may be deleted once
    the application has ended.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_batches(frame: DataFrame) -> DataFrame:
    """Holds the session to Arrow batches of at most ``BATCH_ROWS`` rows: a task keeps several at a time,
    in the JVM and in Python, and documents are long. A smaller setting stays as it is."""
    conf = frame.sparkSession.conf
    rows = int(conf.get(_BATCH))
    if rows <= 0 or rows > BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return frame


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hashed_sample(rows: DataFrame, most: int, key: list[str], by: str | None = None) -> DataFrame:
    """The ``most`` rows, of each class ``by`` if given, that come first by a hash of the key columns.

    Counts come first, so that only about three times as many rows as are wanted are moved at all,
    however many tasks read the table. Equal keys go by the rest of the row.
    """
    order = F.xxhash64(*key)
    unit = F.shiftrightunsigned(order, 11) / float(1 << 53)
    if by is None:
        some = rows.where(unit * rows.count() < 3 * most) if most else rows.limit(0)
        return some.withColumn("_order", order).orderBy("_order", *key).limit(most).drop("_order")
    # One line per value; a classifier keeps far more than that for each of its classes.
    counts = [c for r in rows.where(F.col(by).isNotNull()).groupBy(by).count().collect() for c in (F.lit(r[0]), F.lit(r[1]))]
    if not counts:
        return rows.limit(0)
    some = rows.where(unit * F.try_element_at(F.create_map(*counts), F.col(by)) < 3 * most)
    first = Window.partitionBy(by).orderBy("_order", *key)
    some = some.withColumn("_order", order).withColumn("_k", F.row_number().over(first))
    return some.where(F.col("_k") <= most).select(rows.columns)
