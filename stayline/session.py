"""Session defaults and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "stayline", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    What the cluster names is taken at its word: a ``file:`` path may well be a shared mount. Only a
    session whose tasks run in the driver may go without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = os.path.join(tempfile.gettempdir(), f"stayline-{spark.sparkContext.applicationId}")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def keep_table(frame: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back: what comes after does not compute it again.

    The tables of an application lie in one folder, ``kept-<application>``, which may be deleted once it has ended.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/kept-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that this library has written for its own use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def files_below(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Path, size and time of change (milliseconds) of every file in a folder and below; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found, out = system.listFiles(path, True), []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return out
