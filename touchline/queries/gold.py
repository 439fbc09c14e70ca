"""Totals, form and trend tables over the nation model."""

from pyspark.sql import functions as F

from touchline.operators.enrich import outcome_columns as with_outcomes
from touchline.plans import bridge
from touchline.plans.gold import form_stats, headline_stats, rolling_stats
from touchline.queries import sql
from touchline.queries.registry import query


@query("season_totals", f"WITH {sql.NATION_RESULTS} {sql.totals('res')}")
def season_totals(spark, sf_dir):
    return headline_stats(bridge.nation_results(spark, sf_dir))


@query("last_8_form", f"WITH {sql.NATION_RESULTS}, {sql.RECENT} {sql.totals('recent')}")
def last_8_form(spark, sf_dir):
    return form_stats(bridge.nation_results(spark, sf_dir))


@query("rolling_8", f"WITH {sql.NATION_RESULTS}, {sql.ROLLING} SELECT * FROM rolling")
def rolling_8(spark, sf_dir):
    return rolling_stats(bridge.nation_results(spark, sf_dir))


@query("outcome_columns", f"""
WITH {sql.NATION_RESULTS}
SELECT game_id, venue, team, team_code, goals, goals_allowed, goal_difference, expected_goals,
       expected_goals_allowed, expected_goal_difference, result, expected_result, points,
       expected_result_points, possession
FROM res""")
def outcome_columns(spark, sf_dir):
    return bridge.nation_results(spark, sf_dir).select(
        "game_id", "venue", "team", "team_code", "goals", "goals_allowed", "goal_difference",
        "expected_goals", "expected_goals_allowed", "expected_goal_difference", "result",
        "expected_result", "points", "expected_result_points", "possession")


@query("unplayed_outcomes", f"""
WITH {sql.NATION_SIDES}
SELECT game_id, venue, team, goals, expected_goals, 'L' AS result, 'D' AS expected_result, 0 AS points,
       1 AS expected_result_points, goals - goals_allowed AS goal_difference
FROM side WHERE match_report IS NULL""")
def unplayed_outcomes(spark, sf_dir):
    """Outcomes of matches without goals: lost without points, and drawn where nothing was expected."""
    rows = with_outcomes(bridge.nation_matches(spark, sf_dir).filter(F.col("match_report").isNull()))
    return rows.select("game_id", "venue", "team", "goals", "expected_goals", "result", "expected_result", "points",
                       "expected_result_points", "goal_difference")
