"""A small append-only log of (version, body) records below a folder.

Appending one JSON file is a single commit, so a reader sees either the old
newest record or the new one. It keeps table schemas and published versions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

RECORD = "version long, body string"


def append_record(spark: SparkSession, location: str, version: int, body: str) -> None:
    record = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(body).alias("body"))
    record.coalesce(1).write.mode("append").json(location)


def latest_record(spark: SparkSession, location: str) -> tuple[int, str] | None:
    """The newest record, or None where nothing was recorded yet."""
    try:
        newest = (spark.read.schema(RECORD).json(location)
                       .agg(F.max(F.struct("version", "body")).alias("r")).first()["r"])
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if newest is None else (newest["version"], newest["body"])


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a folder; none where it does not exist."""
    store, at = _folder(spark, path)
    if not store.exists(at):
        return []
    return sorted(f.getPath().toString() for f in store.listStatus(at) if f.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library's own making, such as a staged copy; one that is gone already is no error."""
    store, at = _folder(spark, path)
    store.delete(at, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Put a folder of the library's own making in the place of another one, which may exist."""
    store, at = _folder(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.delete(to, True)
    store.mkdirs(to.getParent())
    if not store.rename(at, to):
        raise OSError(f"{path} cannot be moved to {target}")
