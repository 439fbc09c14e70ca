"""Helpers of the operators: stored tables, text batches, broadcast by measured size, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_dir

#: Tables of at most so many fixed-width rows may be broadcast (16 bytes each: 3.2 MB).
BROADCAST_ROWS = 200_000
#: Text that one Python step works on at a time.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch, up to its last row: a batch is one run of SLICE_BYTES unless its rows are long.
BATCH_BYTES = SLICE_BYTES - (SLICE_BYTES >> 4)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, and no longer lost with an executor."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark cut the Arrow batches of this session by bytes, if its user has not chosen a limit.

    Both ends of the pipe to a Python worker hold whole batches, outside the heap: 10,000 texts of 2 kB are buffers of 32 MB.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def crc32_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with at most `limit` bytes of `text` (a longer text comes alone)."""
    for batch in batches:
        size = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(size):
            if total + n > limit and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one after another, and the offset of each row (NULL is empty)."""
    column = column.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def small_side(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of fixed-width rows whose counted size allows it; else leave it to the shuffle join."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and roots (smallest member) of the components of a few edges held in memory."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = code[:len(a)], code[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        nxt = label.copy()
        np.minimum.at(nxt, left, low)
        np.minimum.at(nxt, right, low)
        np.minimum.at(nxt, label[left], low)
        np.minimum.at(nxt, label[right], low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            break
        label = nxt
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (id, root) per node that is not the smallest of its component.

    Every round points each node at its smallest smaller neighbour (an aggregate with partial sums), follows the
    pointers eight steps and replaces both ends of every edge, until no edge joins different nodes. The smallest
    node never moves, so it ends up as the root. Tables between rounds are written to the shared folder; pointer
    tables are broadcast only up to a counted number of rows, beyond it skewed joins are left to adaptive execution.
    Empty input gives no rows; NULL ends and loops are ignored.
    """
    spark = edges.sparkSession
    labels = None
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"),
                         (F.col("a").isNull() | F.col("b").isNull()).alias("bad")).filter("NOT bad AND a <> b").select("a", "b")
    edges = stored(edges.distinct(), "edges")
    while edges.head(1):
        point = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root")), "pointers")
        n = point.count()
        for _ in range(3):
            up = small_side(point.select(F.col("id").alias("root"), F.col("root").alias("above")), n)
            point = point.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root"))
            if n > BROADCAST_ROWS:
                point = stored(point, "pointers")
        point = stored(point, "pointers")
        for end in ("a", "b"):
            to = small_side(point.select(F.col("id").alias(end), F.col("root").alias("to")), n)
            rest = "b" if end == "a" else "a"
            edges = edges.join(to, end, "left").select(F.coalesce("to", end).alias(end), rest)
        edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        if labels is None:
            labels = point
        else:
            to = small_side(point.select(F.col("id").alias("root"), F.col("root").alias("to")), n)
            moved = labels.join(to, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
            fresh = point.join(small_side(labels.select("id"), labels.count()), "id", "left_anti")
            labels = stored(moved.unionByName(fresh), "labels")
    return labels if labels is not None else spark.createDataFrame([], "id long, root long")
