"""What a reader of the gold tables sees: filtered, ranked, banded, compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import plot_label
from touchline.operators.columns import display_names, metric_columns, project_existing
from touchline.operators.ranking import medians, position, quartile_bands
from touchline.operators.serving import Trace, compare_trends, filter_view, semi_filter
from touchline.operators.skew import MAX_GROUP_ROWS

# Display columns in order, and the columns that are no metric.
STATS_ORDER = (
    "MP", "W", "D", "L", "Points", "PPG",
    "xGD W", "xGD D", "xGD L", "xGD Points", "xGD PPG",
    "G", "GA", "GD", "xG", "xGA", "xGD",
    "G PG", "GA PG", "GD PG", "xG PG", "xGA PG", "xGD PG",
    "Possession",
)
LEAGUE_ORDER = ("Position", "Team", *STATS_ORDER)
COMBINED_ORDER = ("Position", "Team", "League", *STATS_ORDER)
HISTORIC_ORDER = ("Position", "Team", "League", "Season", *STATS_ORDER)
NOT_SORTABLE = ("Position", "Team", "League", "Season", "MP")
NOT_PLOTTED = ("Position", "Team", "MP", "Team-Season", "Team Abbreviation", "Season", "League",
               "Short Season", "Plot Label")
NOT_A_TREND = ("Team", "Season", "League", "Date", "Match No")


def view(table: DataFrame, league: str | None = None, season: str | None = None,
         team: str | None = None) -> DataFrame:
    """A gold table under display names, filtered at the scan; None means all."""
    return display_names(filter_view(table, {"League": league, "Season": season, "Team": team}))


def league_table(table: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """One league by points; pass a season for totals, none for the form table."""
    ranked = position(view(table, league, season), "Points")
    return project_existing(ranked, LEAGUE_ORDER).orderBy("Position")


def combined_table(table: DataFrame, season: str | None, sort_by: str = "PPG",
                   ascending: bool = False) -> DataFrame:
    """All leagues of one season by any metric."""
    ranked = position(view(table, season=season), sort_by, ascending, ties=("Team", "League"))
    return project_existing(ranked, COMBINED_ORDER).orderBy("Position")


def historic_table(table: DataFrame, league: str | None = None, team: str | None = None,
                   sort_by: str = "PPG", ascending: bool = False,
                   max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """All seasons, optionally of one league or team, by any metric."""
    ranked = position(view(table, league, team=team), sort_by, ascending, ties=("Team", "Season", "League"),
                      max_group_rows=max_group_rows)
    return project_existing(ranked, HISTORIC_ORDER).orderBy("Position")


def trend_chart(rolling: DataFrame, traces: Sequence[Trace], shown: DataFrame | None = None,
                aligned: bool = False) -> DataFrame:
    """Traces in match order; with `shown`, only teams of that view can appear."""
    rows = rolling if shown is None else semi_filter(rolling, shown, ["Team"])
    order = ["Match_No"] if aligned else ["trace", "Match_No"]
    return compare_trends(rows, traces, aligned=aligned).orderBy(*order)


def sort_choices(table: DataFrame, order: Sequence[str] = HISTORIC_ORDER) -> list[str]:
    return [c for c in order if c in table.columns and c not in NOT_SORTABLE]


def plot_choices(table: DataFrame) -> list[str]:
    return metric_columns(table, NOT_PLOTTED)


def trend_choices(table: DataFrame) -> list[str]:
    return metric_columns(table, NOT_A_TREND)


def scatter(table: DataFrame, x: str, y: str, color: str, within: Sequence[str] = ()) -> DataFrame:
    """Points of a scatter chart (display names): label, both metrics and the band."""
    banded = quartile_bands(table, color, within)
    return banded.withColumn("Plot Label", plot_label("Team Abbreviation", "Season")).select(
        "Team", "Season", "League", "Plot Label", *dict.fromkeys([x, y, color]), F.col("Quartile"))


def benchmark_lines(table: DataFrame, x: str, y: str, within: Sequence[str] = ()) -> DataFrame:
    return medians(table, [x, y], within)
