"""Sinks for snapshots and recomputed tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.columns import quoted
from touchline.operators.quality import Rule, expect
from touchline.session import TARGET_PARTITION_BYTES, settings
from touchline.sinks.records import RECORD, append_record, latest_record, remove


def stamp(df: DataFrame, run_date: dt.date | str, column: str = "ingestion_date") -> DataFrame:
    return df.withColumn(column, F.lit(str(run_date)))


def audited(df: DataFrame, column: str = "update_date") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def write_snapshot(df: DataFrame, path: str, run_date: dt.date | str,
                   partition_by: Sequence[str] = ()) -> None:
    """Write one run's rows, replacing that day only.

    Every row carries `ingestion_date` as text. With `partition_by`, folders are
    cut by those columns and the day; a hot partition is split over several
    files by the rebalance, which aims at the session's advisory size.
    """
    rows = stamp(df, run_date)
    if not partition_by:
        rows.write.mode("overwrite").parquet(f"{path}/ingestion_date={run_date}")
        return
    (rows.hint("rebalance", *partition_by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by, "ingestion_date").parquet(path))


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows laid out by `keys`, so that file and row-group statistics prune scans.

    A content hash ends the range key: without it all rows of one key value
    would have to go into a single file.
    """
    present = [quoted(k) for k in keys if k in df.columns]
    spread = F.xxhash64(*[quoted(c) for c in df.columns])
    ranged = (df.repartitionByRange(*present, spread) if files is None
              else df.repartitionByRange(files, *present, spread))
    return ranged.sortWithinPartitions(*present)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite",
                    files: int | None = None) -> None:
    clustered(df, keys, files).write.mode(mode).parquet(path)


def materialize(df: DataFrame, table: str, comment: str = "",
                properties: Mapping[str, str] | None = None) -> None:
    """Recompute a catalogue table, with its comment and properties."""
    spark = df.sparkSession
    df.write.mode("overwrite").saveAsTable(table)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    if properties:
        pairs = ", ".join("'{}' = '{}'".format(*(x.replace("'", "''") for x in pair)) for pair in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def sized_files(spark: SparkSession, file_bytes: int):
    """Settings under which a rebalanced write makes files of about `file_bytes`, however its input is cut.

    Spark measures the shuffled rows, which are within a small factor of the file they become.
    """
    return settings(spark, {"spark.sql.adaptive.enabled": "true",
                            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes),
                            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
                            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true"})


def packed_reads(spark: SparkSession, file_bytes: int):
    """Settings under which a scan reads about `file_bytes` of files in each task, so that copying them makes files of that size."""
    return settings(spark, {"spark.sql.files.maxPartitionBytes": str(file_bytes), "spark.sql.files.minPartitionNum": "1",
                            "spark.sql.files.openCostInBytes": "1024"})


@dataclass(frozen=True)
class Published:
    """A recomputed table in a folder: each version is written to a folder of its
    own and only then recorded, so readers never see half a table and a failed
    run leaves the last version in place.

    The record of a version holds its schema, comment, tags and how many rows were checked, broke each rule and were kept.
    """

    spark: SparkSession
    path: str

    def _newest(self) -> tuple[int, dict] | None:
        newest = latest_record(self.spark, f"{self.path}/versions")
        return None if newest is None else (newest[0], json.loads(newest[1]))

    def version(self) -> int | None:
        newest = self._newest()
        return None if newest is None else newest[0]

    def publish(self, df: DataFrame | Sequence[DataFrame], version: int | None = None, cluster_by: Sequence[str] = (),
                partition_by: Sequence[str] = (), comment: str = "", tags: Mapping[str, str] | None = None,
                rules: Sequence[Rule] = (), file_bytes: int = TARGET_PARTITION_BYTES) -> None:
        """Check, write and record a version.

        Rules drop rows or fail the write; what they found is counted while the rows are first written, as their tasks hold
        them. That copy is then laid out in files that aim at `file_bytes`, without a shuffle unless the layout asks for one:
        shuffled rows are several times as wide as stored columns, and the shuffles that made the rows are done by then.
        A table may come in several parts, which are made one after another.
        `partition_by` lays the table out in folders, so that a reader with a filter on these columns opens those only;
        `cluster_by` sorts it over ranges instead.
        """
        current = self.version()
        version = (0 if current is None else current + 1) if version is None else version
        folder = f"{self.path}/data-{version}"
        staged = f"{self.path}/staged-{version}"
        parts = [df] if isinstance(df, DataFrame) else list(df)
        schema, counts = parts[0].schema, Counter()
        for i, part in enumerate(parts):
            kept = Observation(f"kept-{uuid.uuid4().hex}")
            rows, seen = expect(part, rules, f"checked-{uuid.uuid4().hex}")
            rows = rows.observe(kept, F.count(F.lit(1)).alias("kept"))
            # Small row groups, so that a scan can cut a large file.
            writer = rows.write.mode("append" if i else "overwrite").option("parquet.block.size", max(1 << 16, file_bytes // 8))
            writer.parquet(staged)
            counts.update({("checked", name): n for name, n in seen.get.items()} | {("kept",): kept.get["kept"]})
        rows = self.spark.read.schema(schema).parquet(staged)
        if cluster_by:
            clustered(rows, cluster_by).write.mode("overwrite").parquet(folder)
        elif partition_by:
            with sized_files(self.spark, file_bytes):
                rows.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        else:
            with packed_reads(self.spark, file_bytes):
                rows.write.mode("overwrite").parquet(folder)
        remove(self.spark, staged)
        body = {"folder": folder, "schema": schema.jsonValue(), "comment": comment, "tags": dict(tags or {}),
                "checked": counts["checked", "rows"], "kept": counts["kept",],
                "rules": [{"rule": r.name, "action": r.action, "broken": counts["checked", r.name]} for r in rules]}
        append_record(self.spark, f"{self.path}/versions", version, json.dumps(body))

    def read(self) -> DataFrame:
        newest = self._newest()
        if newest is None:
            raise FileNotFoundError(f"nothing published under {self.path}")
        schema = StructType.fromJson(newest[1]["schema"])
        return self.spark.read.schema(schema).parquet(newest[1]["folder"]).select(*[quoted(c) for c in schema.names])

    def report(self) -> DataFrame:
        """One row per version and rule (one without a rule for a version without any): what was recorded with it."""
        body = F.from_json("body", "comment string, tags map<string,string>, checked bigint, kept bigint, "
                                   "rules array<struct<rule:string,action:string,broken:bigint>>")
        records = self.spark.read.schema(RECORD).json(f"{self.path}/versions").select("version", body.alias("b"))
        return (records.select("version", "b.comment", F.col("b.tags")["quality"].alias("quality"), "b.checked", "b.kept",
                               F.explode_outer("b.rules").alias("r"))
                       .select("version", "comment", "quality", "checked", "kept", "r.rule", "r.action", "r.broken"))
