"""Joins and numbering that stay balanced when one group holds most rows.

A plain window or a plain shuffle join puts a whole group into one task. The
helpers here keep that cheap form for groups of a checked size, and give the
larger ("hot") groups an exact form that spreads each of them over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from touchline.operators.columns import quoted
from touchline.session import freeze

MAX_GROUP_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# monotonically_increasing_id keeps the partition number above this bit.
PARTITION_SHIFT = 33


def content(df: DataFrame) -> Column:
    """A hash of a whole row: settles ties by what the rows hold, whatever task or plan they come from."""
    return F.xxhash64(*[quoted(c) for c in df.columns])


def table_bytes(df: DataFrame) -> int:
    """The width of all rows as they are: real lengths of text, binary and nested values, 16 bytes for any other."""
    fixed, sizes = 16, []
    for field in df.schema.fields:
        value = quoted(field.name)
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.octet_length(value))
        elif isinstance(field.dataType, (StructType, ArrayType, MapType)):
            sizes.append(F.octet_length(F.to_json(F.struct(value))))
        else:
            fixed += 16
    width = reduce(lambda x, y: x + y, [F.coalesce(n, F.lit(0)).cast("bigint") for n in sizes], F.lit(fixed).cast("bigint"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """A stored table, broadcast if its measured size allows it, and whether it is.

    A larger one is marked for a sort-merge join: what Spark estimates of stored rows does not see how long they are.
    """
    small = table_bytes(df) <= max_bytes
    return (F.broadcast(df) if small else df.hint("merge")), small


def _keyed(small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`small` with its key columns under names of their own, so that joining it
    to the table it came from leaves no column ambiguous."""
    return small.select(*[quoted(k).alias(f"_on{i}") for i, k in enumerate(keys)],
                        *[quoted(c) for c in small.columns if c not in keys])


def _same(keys: Sequence[str], null_safe: bool = True) -> Column:
    pairs = [(quoted(k), F.col(f"_on{i}")) for i, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def join_by_key(df: DataFrame, side: DataFrame, on: Sequence[str],
                max_group_rows: int = MAX_GROUP_ROWS, null_safe: bool = True,
                max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left join of a one-row-per-key `side` of any size.

    Keys that hold more than `max_group_rows` rows of `df` are taken out first:
    their few rows of `side` (one per hot key) are stored and measured. Below
    `max_bytes` they are broadcast; above it, hot rows are dealt out by their
    content and the rows of `side` repeated for every part. (Adaptive skew
    splitting alone would not do: it leaves a join alone whose other input comes
    straight from an aggregate.) NULL keys meet NULL keys unless `null_safe` is
    off, which spares an aggregated `side` its second shuffle.
    """
    result = [*df.columns, *[c for c in side.columns if c not in on]]
    normal, hot, keys = split_hot(df, on, max_group_rows, max_bytes)
    parts = [normal.join(_keyed(side, on), _same(on, null_safe), "left")]
    if hot is not None:
        wanted, _ = broadcast_if_small(_keyed(keys.drop("_n"), on), max_bytes)
        few = freeze(side.join(wanted, _same(on), "left_semi"))
        listed, small = broadcast_if_small(_keyed(few, on), max_bytes)
        if small:
            parts.append(hot.join(listed, _same(on, null_safe), "left"))
        else:
            most = keys.agg(F.max("_n")).first()[0]
            shares = -(-most // max(1, max_group_rows))
            dealt = hot.withColumn("_share", F.pmod(content(hot), F.lit(shares)))
            copies = listed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<bigint>")))
            parts.append(dealt.join(copies, _same(on, null_safe) & (F.col("_share") == F.col("_part")), "left"))
    return reduce(DataFrame.unionByName, [p.select(*[quoted(c) for c in result]) for p in parts])


def attach(df: DataFrame, small: DataFrame, on: Sequence[str], max_bytes: int = MAX_BROADCAST_BYTES,
           max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Left join of an aggregate of `df`, one row per key, back onto its rows.

    `small` is computed once into the shared folder and measured. Below
    `max_bytes` it is broadcast, so `df` is not shuffled at all; above it,
    `join_by_key` takes over.
    """
    result = [*df.columns, *[c for c in small.columns if c not in on]]
    if not on:
        # No key: `small` is a global aggregate, exactly one row by definition.
        df, small, on = df.withColumn("_all", F.lit(1)), small.withColumn("_all", F.lit(1)), ["_all"]
    small = freeze(_keyed(small, on))
    listed, fits = broadcast_if_small(small, max_bytes)
    if fits:
        joined = df.join(listed, _same(on), "left")
    else:
        named = listed.withColumnsRenamed({f"_on{i}": k for i, k in enumerate(on)})
        joined = join_by_key(df, named, on, max_group_rows, max_bytes=max_bytes)
    return joined.select(*[quoted(c) for c in result])


def split_by(df: DataFrame, keys_table: DataFrame, on: Sequence[str],
             max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is not in the stored `keys_table`, rows whose key is).

    Too many keys to broadcast are shuffled; rows of one key may then meet in
    one task while they are told apart, which needs no memory per key.
    """
    side, _ = broadcast_if_small(_keyed(keys_table.select(*[quoted(k) for k in on]), on), max_bytes)
    return df.join(side, _same(on), "left_anti"), df.join(side, _same(on), "left_semi")


def split_hot(df: DataFrame, keys: Sequence[str], max_group_rows: int, max_bytes: int = MAX_BROADCAST_BYTES,
              ) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """(rows of normal groups, rows of hot groups, hot keys with `_n`).

    The check is one narrow aggregate over the key columns. There are at most
    total rows / `max_group_rows` hot keys. Without a hot group the second and
    third part are None; without keys the whole table is one group.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = freeze(sizes.filter(F.col("_n") > max_group_rows))
    if hot.isEmpty():
        return df, None, None
    if not keys:
        return None, df, hot
    normal, large = split_by(df, hot, keys, max_bytes)
    return normal, large, hot


def number_hot_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    rows: int, out: str, rows_per_task: int) -> DataFrame:
    """Row numbers inside each of a few very large groups, without a window over them.

    Range partitioning cuts even a single group into sorted slices. A row's
    number is its place in its slice plus the lengths of the group's earlier
    slices; only (group, slice) lengths are combined. The sorted rows are frozen
    first, since slice borders come from sampling and must not change between
    the two uses.
    """
    sort = [*[quoted(k).asc_nulls_first() for k in keys], *order, content(df).asc()]
    slices = max(2, -(-rows // rows_per_task))
    placed = freeze(df.repartitionByRange(slices, *sort).sortWithinPartitions(*sort)
                      .withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_slice", F.shiftright("_place", PARTITION_SHIFT))
    lengths = (placed.groupBy(*keys, "_slice")
                     .agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_len")))
    # At most `slices` rows per group reach this window.
    earlier = (Window.partitionBy(*keys).orderBy("_slice")
                     .rowsBetween(Window.unboundedPreceding, -1))
    offsets = lengths.select(*[quoted(k) for k in keys], "_slice", "_start",
                             F.coalesce(F.sum("_len").over(earlier), F.lit(0)).alias("_before"))
    numbered = attach(placed, offsets, [*keys, "_slice"])
    number = F.col("_place") - F.col("_start") + F.col("_before") + 1
    return numbered.select(*[quoted(c) for c in df.columns], number.cast("bigint").alias(out))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str,
                max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """1..n per group in the given order, for groups of any size (bigint).

    Ties are settled by the content of the rows, alike in both forms.
    """
    normal, hot, sizes = split_hot(df, keys, max_group_rows)
    parts = []
    if normal is not None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, content(df).asc()))
        parts.append(normal.withColumn(out, place.cast("bigint")))
    if hot is not None:
        rows = sizes.agg(F.sum("_n")).first()[0]
        parts.append(number_hot_rows(hot, keys, order, rows, out, max_group_rows))
    return reduce(DataFrame.unionByName, parts)
