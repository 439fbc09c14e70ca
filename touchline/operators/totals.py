"""Totals per team and season, and the newest rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.text import league_label, season_label

GROUP = ("team_id", "team", "season", "league")

# Output names and the per-match columns derived from them.
RESULTS = ("W", "D", "L")
FRACTIONS = ("xG", "xGA", "xGD")
TOTALS = ("Points", "W", "D", "L", "MP", "xGD_W", "xGD_D", "xGD_L", "xGD_Points",
          "G", "GA", "GD", "xG", "xGA", "xGD")
PER_MATCH = {
    "PPG": "Points", "xGD_PPG": "xGD_Points", "G_PG": "G", "GA_PG": "GA",
    "GD_PG": "GD", "xG_PG": "xG", "xGA_PG": "xGA", "xGD_PG": "xGD",
}


def _times(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def season_totals(df: DataFrame, group: Sequence[str] = GROUP, code: str = "team_code",
                  day: str = "date") -> DataFrame:
    """Totals and unrounded per-match ratios of each (team-season, team, season, league).

    The team's code is its newest known one (by day, then by code). Keeping a
    text maximum beside the sums would make Spark sort all rows before it
    aggregates, so the rows are first summed per group and code in hash
    aggregates of fixed width; only those few partial rows are merged by text.
    """
    team_id, team, season, league = group
    part = df.groupBy(*group, F.col(code).alias("_code")).agg(
        F.max(day).alias("_day"),
        F.sum("points").alias("Points"),
        *[_times("result", r).alias(r) for r in RESULTS],
        F.count("result_id").alias("MP"),
        *[_times("expected_result", r).alias(f"xGD_{r}") for r in RESULTS],
        F.sum("expected_result_points").alias("xGD_Points"),
        F.sum("goals").alias("G"),
        F.sum("goals_allowed").alias("GA"),
        F.sum("goal_difference").alias("GD"),
        F.sum("expected_goals").alias("xG"),
        F.sum("expected_goals_allowed").alias("xGA"),
        F.sum("expected_goal_difference").alias("xGD"),
        F.sum("possession").alias("_possession"), F.count("possession").alias("_held"))
    newest = F.max_by("_code", F.when(F.col("_code").isNotNull(), F.struct("_day", "_code")))
    totals = part.groupBy(*group).agg(
        newest.alias("Team_Abbreviation"),
        *[F.sum(c).cast("float" if c in FRACTIONS else "int").alias(c) for c in TOTALS],
        F.round(F.try_divide(F.sum("_possession"), F.sum("_held")), 1).alias("Possession"))
    ratios = [F.try_divide(F.col(total), F.col("MP")).alias(name) for name, total in PER_MATCH.items()]
    return totals.select(
        F.col(team_id).alias("Team-Season"),
        F.col(team).alias("Team"),
        season_label(season).alias("Season"),
        league_label(league).alias("League"),
        "Team_Abbreviation", *TOTALS, "Possession", *ratios)


def current_season(df: DataFrame, column: str = "season") -> DataFrame:
    """Rows of the largest value (text order). The broadcast side is one row:
    a global maximum."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(column) == F.col("_newest")).drop("_newest")


def last_n(df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int = 8) -> DataFrame:
    """The first `n` rows of each group in `order`.

    Spark turns the rank filter into a group limit that already runs before the
    shuffle, so a hot group sends at most `n` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def last_n_form(df: DataFrame, group: Sequence[str] = GROUP, n: int = 8, code: str = "team_code",
                order: Sequence[str] = ("date", "result_team_id")) -> DataFrame:
    """Totals over each team's newest `n` matches of the newest season."""
    newest = [F.col(c).desc() for c in order]
    recent = last_n(current_season(df, group[2]), [group[0]], newest, n)
    return season_totals(recent, group, code, order[0])
