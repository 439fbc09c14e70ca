"""Positions, quantiles and quartile bands of a view."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.columns import quoted
from touchline.operators.skew import MAX_GROUP_ROWS, attach, number_rows, split_hot
from touchline.session import freeze

# Band names from low to high, and the metrics where low is good.
BANDS = ("Q1 (Low)", "Q2", "Q3", "Q4 (High)")
LOWER_IS_BETTER = ("L", "xGD L", "GA", "xGA", "GA PG", "xGA PG")
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def is_lower_better(metric: str) -> bool:
    return metric.replace("_", " ") in LOWER_IS_BETTER


def sort_order(by: str, ascending: bool = False, ties: Sequence[str] = ()) -> list[Column]:
    """Sort expressions with NULLs at the end in both directions."""
    first = quoted(by).asc_nulls_last() if ascending else quoted(by).desc_nulls_last()
    return [first, *[quoted(t).asc_nulls_last() for t in ties]]


def position(df: DataFrame, by: str, ascending: bool = False, within: Sequence[str] = (),
             ties: Sequence[str] = ("Team",), out: str = "Position",
             max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """1..n within each view in sorted order; no `within` numbers the whole table."""
    return number_rows(df, within, sort_order(by, ascending, ties), out, max_group_rows)


def _value(metric: str) -> Column:
    """The metric as double; NaN is a missing value here."""
    value = quoted(metric).cast("double")
    return F.when(~F.isnan(value), value)


def value_counts(df: DataFrame, metrics: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Stored counts (group, `_metric`, `_v`, `_n`) of all values, missing ones included.

    One pass with partial sums serves all metrics, and a value that fills a
    third of a group is one row here.
    """
    values = F.array(*[F.struct(F.lit(i).alias("_metric"), _value(m).alias("_v")) for i, m in enumerate(metrics)])
    rows = df.select(*[quoted(k) for k in within], F.inline(values))
    return freeze(rows.groupBy(*within, "_metric", "_v").agg(F.count(F.lit(1)).alias("_n")))


def running_counts(counts: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    """`_until`, the number of a group's values up to each distinct one, for groups of any number of them.

    Distinct values are range partitioned, so that slices are even; a value's
    sum is that inside its slice plus those of the group's earlier slices.
    """
    sort = [*[quoted(k).asc_nulls_first() for k in keys], F.col("_v").asc()]
    slices = max(2, -(-counts.count() // rows_per_task))
    placed = freeze(counts.repartitionByRange(slices, *sort).sortWithinPartitions(*sort)
                    .withColumn("_slice", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*[quoted(k) for k in keys], "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return attach(placed.withColumn("_inside", inside), before, [*keys, "_slice"]).withColumn("_until", F.col("_before") + F.col("_inside"))


def _quantiles(df: DataFrame, metrics: Sequence[str], probs: Sequence[float], within: Sequence[str],
               max_group_rows: int) -> DataFrame:
    """(group, `_metric`, `_edges`) from value counts; a group without values has NULL edges."""
    counts = value_counts(df, metrics, within)
    keys = [*within, "_metric"]
    normal, hot, _ = split_hot(counts, keys, max_group_rows)
    edges = F.percentile("_v", F.array(*[F.lit(p) for p in probs]), F.col("_n"))
    parts = [normal.groupBy(*keys).agg(edges.alias("_edges"))]
    if hot is not None:
        ranked = running_counts(hot.filter(F.col("_v").isNotNull()), keys, max_group_rows)
        ranked = attach(ranked, ranked.groupBy(*keys).agg(F.sum("_n").alias("_all")), keys)

        def at(p: float) -> Column:
            place = F.lit(p) * (F.col("_all") - 1)

            def value(rank: Column) -> Column:
                return F.max(F.when((rank < F.col("_until")) & (rank >= F.col("_until") - F.col("_n")), F.col("_v")))
            low, high = value(F.floor(place)), value(F.ceil(place))
            part = F.max(place - F.floor(place))
            return F.when(low == high, low).otherwise((1 - part) * low + part * high)
        parts.append(ranked.groupBy(*keys).agg(F.array(*[at(p) for p in probs]).alias("_edges")))
    return reduce(DataFrame.unionByName, parts)


def group_quantiles(df: DataFrame, metric: str, probs: Sequence[float], within: Sequence[str] = (),
                    out: str = "edges", max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation, as an array per group.

    All rows are counted per group and value first. The built-in aggregate then
    holds a group's distinct values in one buffer, which serves groups of up to
    `max_group_rows` of them; of larger ones only the values at the wanted ranks
    are kept, from running counts in slices.
    """
    return _quantiles(df, [metric], probs, within, max_group_rows).select(*[quoted(k) for k in within], F.col("_edges").alias(out))


def medians(df: DataFrame, metrics: Sequence[str], within: Sequence[str] = (),
            max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Exact interpolated median of each metric per view, as `median_<metric>`, all from one pass."""
    edges = _quantiles(df, metrics, [0.5], within, max_group_rows)
    return edges.groupBy(*within).agg(*[
        F.max(F.when(F.col("_metric") == i, F.col("_edges")[0])).alias(f"median_{m}") for i, m in enumerate(metrics)])


def quartile_bands(df: DataFrame, metric: str, within: Sequence[str] = (),
                   lower_is_better: bool | None = None, out: str = "Quartile",
                   max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Quartile band of each row within its view.

    Intervals are closed on the right and the minimum belongs to the lowest
    one; a missing value has no band. Where two edges coincide, or the view has
    no value at all, every row of the view is in the low band, also when low is
    good.
    """
    reverse = is_lower_better(metric) if lower_is_better is None else lower_is_better
    labels = list(reversed(BANDS)) if reverse else list(BANDS)
    edges = group_quantiles(df, metric, QUARTILES, within, "_edges", max_group_rows)
    rows = attach(df, edges, list(within))
    edge = [F.col("_edges")[i] for i in range(5)]
    apart = reduce(lambda a, b: a & b, [edge[i] < edge[i + 1] for i in range(4)])
    value = _value(metric)
    band = (F.when(~F.coalesce(apart, F.lit(False)), F.lit(BANDS[0]))
             .when(value <= edge[1], F.lit(labels[0]))
             .when(value <= edge[2], F.lit(labels[1]))
             .when(value <= edge[3], F.lit(labels[2]))
             .when(value.isNotNull(), F.lit(labels[3])))
    return rows.withColumn(out, band).drop("_edges")
