"""Gold tables from the match results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.text import league_label, season_label
from touchline.operators.quality import Rule, enforce
from touchline.operators.skew import MAX_GROUP_ROWS
from touchline.operators.totals import last_n_form, season_totals
from touchline.operators.trend import rolling_mean
from touchline.plans.catalogue import Layout
from touchline.sinks.tables import Published

# Views ask for a league, a season or both.
SERVED_BY = ("League", "Season")

# The window length and the metrics of the trend table.
WINDOW = 8
# The trend table of more rows is made in so many slices.
SLICES, SLICE_ROWS = 4, 1_000_000
TREND_METRICS = {
    "PPG": "points", "xGD_PPG": "expected_result_points", "G_PG": "goals", "GA_PG": "goals_allowed",
    "GD_PG": "goal_difference", "xG_PG": "expected_goals", "xGA_PG": "expected_goals_allowed",
    "xGD_PG": "expected_goal_difference",
}

# The rules of both totals tables.
CONSISTENT = "(MP = W + D + L) AND (MP = xGD_W + xGD_D + xGD_L)"
HEADLINE_RULES = (
    Rule("headline_points_not_null", "Points IS NOT NULL"),
    Rule("headline_league_format", "League NOT LIKE '%-%'"),
    Rule("headline_mp_consistency", CONSISTENT),
)
FORM_RULES = (
    Rule("form_points_not_null", "Points IS NOT NULL", "drop"),
    Rule("form_league_format", "League NOT LIKE '%-%'"),
    Rule("form_mp_check", f"MP <= {WINDOW} AND {CONSISTENT}"),
)


def headline_stats(results: DataFrame, code: str = "team_code") -> DataFrame:
    return enforce(season_totals(results, code=code), HEADLINE_RULES)


def form_stats(results: DataFrame, code: str = "team_code") -> DataFrame:
    return enforce(last_n_form(results, n=WINDOW, code=code), FORM_RULES)


def rolling_stats(results: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, on_disk: bool = False) -> DataFrame:
    """Eight-match means per team-season; equal dates are settled by the row id. `on_disk`: `results` is a stored table."""
    needed = results.select("team_id", "team", "season", "league", "date", "result_team_id",
                            *TREND_METRICS.values())
    trend = rolling_mean(needed, ["team_id"], [F.col("date").asc(), F.col("result_team_id").asc()],
                         TREND_METRICS, WINDOW, "Match_No", max_group_rows, on_disk)
    return trend.select(
        F.col("team").alias("Team"), season_label("season").alias("Season"),
        league_label("league").alias("League"), F.col("date").alias("Date"),
        "Match_No", *TREND_METRICS)


def rolling_slices(results: DataFrame) -> list[DataFrame]:
    """`rolling_stats` of the stored results in a few slices of whole team-seasons, so that a large table is not shuffled at once."""
    n = max(1, min(SLICES, -(-results.count() // SLICE_ROWS)))
    share = F.pmod(F.xxhash64("team_id"), F.lit(n))
    return [rolling_stats(results if n == 1 else results.filter(share == i), on_disk=True) for i in range(n)]


def run_gold(spark: SparkSession, layout: Layout) -> None:
    """Recompute the three gold tables from the published results, in folders by league and season."""
    results = Published(spark, layout.table("results")).read()
    code = "team_code_understat"
    tables = {
        "headline_stats": (season_totals(results, code=code), HEADLINE_RULES, "Totals of each team and season"),
        "form_stats": (last_n_form(results, n=WINDOW, code=code), FORM_RULES, f"Totals of each team's last {WINDOW} matches"),
        "rolling_stats": (rolling_slices(results), (), f"Means over {WINDOW} matches at each match of a team and season")}
    for name, (rows, rules, comment) in tables.items():
        publish_gold(Published(spark, layout.table(name)), rows, rules, comment)


def publish_gold(table: Published, rows: DataFrame | Sequence[DataFrame], rules: Sequence[Rule] = (), comment: str = "") -> DataFrame:
    """Publish a table that is read by league and season; returns it as its readers see it."""
    table.publish(rows, partition_by=SERVED_BY, comment=comment, tags={"quality": "gold"}, rules=rules)
    return table.read()
