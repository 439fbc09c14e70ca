"""Reshaping and enriching match rows before they become results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.outcomes import DECIDED_MARGIN, expected_result, match_result, result_points
from touchline.operators.columns import quoted
from touchline.operators.skew import MAX_BROADCAST_BYTES, MAX_GROUP_ROWS, attach, broadcast_if_small, join_by_key
from touchline.session import freeze


def to_sides(df: DataFrame, keep: Sequence[str], home: Mapping[str, str | Column],
             away: Mapping[str, str | Column], venue_col: str = "venue",
             labels: tuple[str, str] = ("Home", "Away")) -> DataFrame:
    """One row per game to one row per side, from a single scan.

    `home` and `away` map output columns to their source. A column only one
    side has is NULL on the other.
    """
    names = list(dict.fromkeys([*home, *away]))

    def side(columns: Mapping[str, str | Column], label: str) -> Column:
        values = []
        for name in names:
            source = columns.get(name, F.lit(None))
            values.append((F.col(source) if isinstance(source, str) else source).alias(name))
        return F.struct(*values, F.lit(label).alias(venue_col))

    sides = F.array(side(home, labels[0]), side(away, labels[1]))
    return df.select(*keep, F.inline(sides))


def group_median(df: DataFrame, value: str, group: Sequence[str], out: str,
                 accuracy: int = 10_000) -> DataFrame:
    """Approximate median per group, an actual value of the group.

    The sketch has a fixed size, so a hot group is merged, never collected.
    """
    return (df.filter(F.col(value).isNotNull()).groupBy(*group)
              .agg(F.percentile_approx(value, 0.5, accuracy).alias(out)))


def fill_from_group(df: DataFrame, value: str, group: Sequence[str], out: str | None = None,
                    accuracy: int = 10_000, stats: DataFrame | None = None,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Replace NULL by the group's approximate median; NULL where the group has none."""
    median = f"_median_{value}"
    stats = group_median(df, value, group, median, accuracy) if stats is None else \
        stats.select(*group, F.col([c for c in stats.columns if c not in group][0]).alias(median))
    filled = attach(df, stats, list(group), max_bytes)
    target = out or value
    columns = [c for c in df.columns if c != target]
    return filled.select(*columns, F.coalesce(F.col(value), F.col(median)).alias(target))


def unique_dimension(dim: DataFrame, key: str, value: str) -> DataFrame:
    """`key` and `value` only; running it raises if a key comes up twice."""
    grouped = (dim.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v")))
    clash = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))
    return grouped.select(key, F.when(F.col("_n") == 1, F.col("_v"))
                                .otherwise(clash.cast(dim.schema[value].dataType)).alias(value))


@dataclass(frozen=True)
class Dimension:
    """A dimension with a unique key, checked, stored and measured once for all the roles it plays."""

    rows: DataFrame
    key: str
    value: str
    small: bool

    @classmethod
    def prepare(cls, dim: DataFrame, key: str, value: str, max_bytes: int = MAX_BROADCAST_BYTES) -> Dimension:
        """Raises if a key comes up twice; rows without a key are left out."""
        stored = freeze(unique_dimension(dim, key, value).select(F.col(key).alias("_dim_key"), F.col(value).alias("_dim_value")))
        rows, small = broadcast_if_small(stored, max_bytes)
        return cls(rows, "_dim_key", "_dim_value", small)

    def attach(self, df: DataFrame, key: str, out: str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
        """Left lookup of `key` in the dimension as column `out`.

        The dimension is broadcast only if its measured size allows it; a larger one is joined by shuffle with the hot keys
        of `df` set apart.
        """
        if self.small:
            found = df.join(self.rows, quoted(key) == F.col(self.key), "left")
            return found.select(*[quoted(c) for c in df.columns], F.col(self.value).alias(out))
        side = self.rows.select(F.col(self.key).alias(key), F.col(self.value).alias(out))
        return join_by_key(df, side, [key], max_group_rows)


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str,
           max_bytes: int = MAX_BROADCAST_BYTES, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Left lookup of one value in a dimension with a unique key; several roles of one dimension: `lookup_roles`."""
    return lookup_roles(df, dim, {key: out}, dim_key, value, max_bytes, max_group_rows)


def lookup_roles(df: DataFrame, dim: DataFrame, roles: Mapping[str, str], dim_key: str, value: str,
                 max_bytes: int = MAX_BROADCAST_BYTES, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Left lookups of several columns (column to output) in one dimension, which is prepared once."""
    dimension = Dimension.prepare(dim, dim_key, value, max_bytes)
    for key, out in roles.items():
        df = dimension.attach(df, key, out, max_group_rows)
    return df


def outcome_columns(df: DataFrame, scored: str = "goals", conceded: str = "goals_allowed",
                    xg: str = "expected_goals", xga: str = "expected_goals_allowed",
                    threshold: float = DECIDED_MARGIN) -> DataFrame:
    """Result, points and differences of each row, actual and expected."""
    margin = F.col(xg) - F.col(xga)
    result = match_result(F.col(scored), F.col(conceded))
    expected = expected_result(margin, threshold)
    return df.withColumns({
        "result": result,
        "expected_result": expected,
        "points": result_points(result),
        "expected_result_points": result_points(expected),
        "goal_difference": F.col(scored) - F.col(conceded),
        "expected_goal_difference": margin,
    })
