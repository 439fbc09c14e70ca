"""Filtered views, filter lists and trend comparison over gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.columns import quoted
from touchline.operators.skew import MAX_BROADCAST_BYTES, MAX_GROUP_ROWS, attach


def filter_view(df: DataFrame, equals: Mapping[str, Any]) -> DataFrame:
    """Equality filters; a value of None means "all" and filters nothing."""
    for column, value in equals.items():
        if value is not None:
            df = df.filter(quoted(column) == value)
    return df


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str],
                max_bytes: int = MAX_BROADCAST_BYTES, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Rows whose key appears in `keys`; a NULL key appears nowhere.

    The keys are made distinct first, so a key that fills a third of either side
    is one row on the right, and small key sets are broadcast.
    """
    wanted = keys.select(*on).dropna().distinct().withColumn("_wanted", F.lit(True))
    return attach(df, wanted, list(on), max_bytes, max_group_rows).filter("_wanted").drop("_wanted")


def distinct_values(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    order = quoted(column).desc() if descending else quoted(column).asc()
    return df.select(quoted(column)).distinct().orderBy(order)


@dataclass(frozen=True)
class Trace:
    """One line of a trend chart: a metric of the rows that meet the equalities."""

    label: str
    metric: str
    where: Mapping[str, Any] = field(default_factory=dict)

    def matches(self) -> Column:
        tests = [quoted(c) == v for c, v in self.where.items()]
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def compare_trends(df: DataFrame, traces: Sequence[Trace], number: str = "Match_No",
                   keep: Sequence[str] = (), aligned: bool = False) -> DataFrame:
    """Long form (*keep, trace, number, value), or one column per trace side by side.

    One scan serves all traces, with their filters pushed down as a disjunction;
    the aligned form groups by match number instead of joining trace to trace.
    """
    wanted = reduce(lambda a, b: a | b, [t.matches() for t in traces])
    points = F.array(*[
        F.when(t.matches(), F.struct(F.lit(t.label).alias("trace"), F.col(number),
                                     quoted(t.metric).cast("double").alias("value")))
        for t in traces])
    long = df.filter(wanted).select(*[quoted(k) for k in keep],
                                    F.inline(F.filter(points, lambda p: p.isNotNull())))
    if not aligned:
        return long
    return long.groupBy(*keep, number).agg(
        *[F.max(F.when(F.col("trace") == t.label, F.col("value"))).alias(t.label) for t in traces])
