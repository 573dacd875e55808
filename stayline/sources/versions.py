"""Tables that change at once: every write is a version of its own, and an empty marker file makes it the current one.

::

    <path>/_versions/[run_date=.../model_version=.../]<version>/part-*.parquet
    <path>/_published/[run_date=.../model_version=.../]<number>.<version>

A version is written in full before its marker is created. Creating one empty file is atomic on every file
system and object store, so a reader sees the version before or the one after, never half of one,
and a writer that dies leaves files that no marker names. Every writer has a folder of its own: two of them never mix
their files. The marker with the highest number counts; of two published at the same moment one wins, whole.

A part is a group of rows that is replaced by itself, named as Spark names partitions; a table may have one
nameless part. Older versions stay for readers that have begun, until ``expire`` removes them.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stayline.session import delete_folder, files_below, folder_exists

DATA, MARKERS = "_versions", "_published"


def _files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path below the folder and time of change of every file."""
    below = f"/{folder.rstrip('/').rpartition('/')[2]}/"
    return [(name.rpartition(below)[2], changed) for name, _, changed in files_below(spark, folder)]


def _markers(spark: SparkSession, path: str) -> dict[str, list[tuple[int, str, int]]]:
    """Per part: number, version and time of its markers, newest last."""
    found: dict[str, list[tuple[int, str, int]]] = {}
    for name, changed in _files(spark, f"{path}/{MARKERS}"):
        part, _, marker = name.rpartition("/")
        number, _, version = marker.partition(".")
        if number.isdigit() and version:
            found.setdefault(part, []).append((int(number), version, changed))
    return {part: sorted(markers) for part, markers in found.items()}


def folder_of(path: str, part: str, version: str) -> str:
    return "/".join(name for name in (path, DATA, part, version) if name)


def stage(frame: DataFrame, path: str, part: str = "") -> str:
    """Writes a version that nobody reads yet, and returns its name. A write that fails leaves nothing."""
    version = uuid.uuid4().hex
    folder = folder_of(path, part, version)
    try:
        frame.write.parquet(folder)
    except BaseException:
        discard(frame.sparkSession, path, part, version)
        raise
    return version


def read_version(spark: SparkSession, path: str, part: str, version: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder_of(path, part, version))


def discard(spark: SparkSession, path: str, part: str, version: str) -> None:
    delete_folder(spark, folder_of(path, part, version))


def publish(spark: SparkSession, path: str, part: str, version: str) -> None:
    """Makes a staged version the current one of its part."""
    if not folder_exists(spark, folder_of(path, part, version)):
        raise ValueError(f"{path}: there is no version {version} of {part or 'the table'}")
    last = _markers(spark, path).get(part, [(0, "", 0)])[-1][0]
    marker = "/".join(name for name in (path, MARKERS, part, f"{last + 1:012d}.{version}") if name)
    target = spark._jvm.org.apache.hadoop.fs.Path(marker)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False).close()


def replace(frame: DataFrame, path: str, part: str = "") -> None:
    """The frame becomes the part's rows, at once."""
    publish(frame.sparkSession, path, part, stage(frame, path, part))


def current(spark: SparkSession, path: str) -> dict[str, str]:
    """The current version of every part."""
    return {part: markers[-1][1] for part, markers in _markers(spark, path).items()}


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current versions of all parts. Names of parts are columns: a filter on them reads only their folders.

    The versions are those of this call, whatever is published later. Without a schema, it is that of the files.
    """
    folders = [folder_of(path, part, version) for part, version in sorted(current(spark, path).items())]
    if not folders:
        if schema is None:
            raise ValueError(f"{path}: nothing is published there")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{path}/{DATA}")
    return (reader if schema is None else reader.schema(schema)).parquet(*folders)


def expire(spark: SparkSession, path: str, keep: int = 2, hours: float = 24.0) -> list[str]:
    """Removes versions that are neither among the newest ``keep`` of their part nor younger than ``hours``.

    That includes what dead writers left. Give readers and writers longer than they take.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    before = (time.time() - 3600 * hours) * 1000
    markers, latest = _markers(spark, path), {}
    for name, changed in _files(spark, f"{path}/{DATA}"):
        # Unfinished writes keep files some folders further down.
        folder = name.split("/_temporary/")[0] if "/_temporary/" in name else name.rpartition("/")[0]
        latest[folder] = max(latest.get(folder, 0), changed)
    kept = {"/".join(n for n in (part, m[1]) if n) for part, found in markers.items() for m in found[-keep:]}
    young = {"/".join(n for n in (part, m[1]) if n) for part, found in markers.items() for m in found if m[2] > before}
    gone = sorted(folder for folder, changed in latest.items() if folder not in kept | young and changed <= before)
    for folder in gone:
        part, _, version = folder.rpartition("/")
        # First the name, then the files.
        for number, named, _ in markers.get(part, []):
            if named == version:
                delete_folder(spark, "/".join(n for n in (path, MARKERS, part, f"{number:012d}.{version}") if n))
        discard(spark, path, part, version)
    return gone
