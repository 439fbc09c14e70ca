"""Star-schema test tables seen as match data.

One order is one game with a home and an away row. The `nation` model has few
teams with long seasons (totals, windows, serving); the `customer` model has
many teams and few meetings per pairing (joins, unpivot, current rows). All
measures are whole numbers or multiples of 1/32, so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.casts import iso_text
from touchline.functions.text import extract_id, joined_id, tiered_code
from touchline.operators.enrich import outcome_columns, to_sides
from touchline.session import stored
from touchline.sinks.tables import write_snapshot

# Fixed values of the bridge: codes for some teams, the others fall back to letters.
NATION_CODES = {"NATION_1": "ONE", "NATION_2": "TWO", "NATION_7": "SEV", "NATION_11": "ELV"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def season_of(day: Column) -> Column:
    """'1516' for a day in 1995: two-digit years, moved on by 20 so that text order holds."""
    start = F.year(day) + 20
    two = [F.lpad(F.pmod(start + i, F.lit(100)).cast("string"), 2, "0") for i in (0, 1)]
    return F.concat(*two)


def report_url(order: Column, gaps: bool = False) -> Column:
    """The match report of an order; with `gaps`, some are missing or do not match."""
    url = F.concat(F.lit("/en/matches/"), order.cast("string"), F.lit("/x"))
    if not gaps:
        return url
    return (F.when(order % 11 == 3, F.concat(F.lit("/en/stathead/"), order.cast("string")))
             .when(order % 11 != 7, url))


def goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goals and expected goals of both sides of an order, from its lines."""
    lines = table(spark, sf_dir, "lineitem")
    def of(flag: str) -> Column:
        return F.col("l_returnflag") == flag
    return lines.groupBy("l_orderkey").agg(
        F.count_if(of("A")).cast("int").alias("home_goals"),
        F.count_if(of("R")).cast("int").alias("away_goals"),
        (F.sum(F.when(of("A"), F.col("l_quantity"))) / 32.0).cast("float").alias("home_xg"),
        (F.sum(F.when(of("R"), F.col("l_quantity"))) / 32.0).cast("float").alias("away_xg"))


def nation_matches(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Two rows per order, teams are nations, leagues are regions.

    Orders with status P are matches to come: no report, no goals and no
    expected goals yet.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region")
    league = F.concat(F.substring("r_name", 1, 3), F.lit("-"), F.col("r_name"))
    where = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", league.alias("league"))
    scores = goals(spark, sf_dir)

    order = F.col("o_orderkey")
    home = F.col("c_nationkey").cast("int")
    away = ((F.col("c_nationkey") + 5 * (1 + order % 4)) % 25).cast("int")
    possession = (30 + order % 41).cast("int")
    def name(key: Column) -> Column:
        return F.concat(F.lit("NATION_"), key.cast("string"))
    def code(key: Column) -> Column:
        # The provider lags on every third order.
        return F.when(order % 3 != 0, F.concat(F.lit("N"), key.cast("string")))
    # The scores are already partitioned by order; a merge keeps that partitioning.
    games = (orders.join(scores.hint("merge"), order == F.col("l_orderkey"), "left")
                   .join(customers, F.col("o_custkey") == F.col("c_custkey"))
                   .join(where, F.col("c_nationkey") == F.col("n_nationkey")))
    day = F.col("o_orderdate").cast("date")

    def played(value: Column) -> Column:
        return F.when(F.col("o_orderstatus") != "P", value)
    games = games.select(
        order.alias("game_id"), "league", season_of(day).alias("season"), day.alias("date"),
        played(report_url(order, gaps)).alias("match_report"),
        name(home).alias("home_team"), name(away).alias("away_team"),
        code(home).alias("home_code"), code(away).alias("away_code"),
        played(F.coalesce("home_goals", F.lit(0))).alias("home_goals"),
        played(F.coalesce("away_goals", F.lit(0))).alias("away_goals"),
        played(F.col("home_xg")).alias("home_xg"), played(F.col("away_xg")).alias("away_xg"),
        possession.alias("home_possession"), (F.lit(100) - possession).alias("away_possession"))

    def side(own: str, other: str) -> dict[str, str]:
        return {"team": f"{own}_team", "opponent": f"{other}_team", "provider_code": f"{own}_code",
                "goals": f"{own}_goals", "goals_allowed": f"{other}_goals",
                "expected_goals": f"{own}_xg", "expected_goals_allowed": f"{other}_xg",
                "possession": f"{own}_possession"}
    keep = ["game_id", "league", "season", "date", "match_report"]
    return to_sides(games, keep, side("home", "away"), side("away", "home"))


def nation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation model with ids, codes and outcomes: the input of the gold tables.

    Matches without a report have not been played and are left out, as in the silver tables.
    """
    rows = nation_matches(spark, sf_dir).filter(F.col("match_report").isNotNull())
    result_id = extract_id("match_report")
    rows = rows.withColumns({
        "result_id": result_id,
        "team_id": joined_id("team", "season"),
        "result_team_id": joined_id(result_id, "team", "season"),
        "team_code": tiered_code("provider_code", "team", NATION_CODES)})
    return outcome_columns(rows)


def customer_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with both sides, teams are customers."""
    count = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    order = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        order.alias("game_id"), season_of(day).alias("season"), day.alias("date"),
        F.col("o_custkey").alias("home_team_id"),
        ((F.col("o_custkey") + 1 + order % 4) % count).alias("away_team_id"),
        F.when(order % 7 != 0, (order % 160) / 8.0).cast("float").alias("home_ppda"),
        ((order % 96) / 8.0).cast("float").alias("away_ppda"),
        (order % 13).cast("int").alias("home_deep_completions"),
        (order % 17).cast("int").alias("away_deep_completions"))


def customer_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    def side(own: str, other: str) -> dict[str, str | Column]:
        return {"game_team_id": joined_id("game_id", f"{own}_team_id"),
                "team": f"{own}_team_id", "opponent": f"{other}_team_id",
                "ppda_raw": f"{own}_ppda", "deep_completions": f"{own}_deep_completions"}
    return to_sides(customer_games(spark, sf_dir), ["season", "date", "game_id"],
                    side("home", "away"), side("away", "home"))


# Fixed values of the bridge: two weekly snapshots of the same matches.
FIRST_RUN, SECOND_RUN = "2001-09-01", "2001-09-08"


def land_nation_model(spark: SparkSession, sf_dir: str, landing: str, advanced_too: bool = True,
                      broken: bool = False) -> DataFrame:
    """Land both providers' snapshots of the nation model, or the first one's; returns the name mapping.

    In the first run nobody knows the goals yet. In the second they are text such
    as '3.0', which does not fit the whole-number column of the first. The second
    provider spells the clubs of low-priority orders in a way that the mapping does
    not know yet.
    """
    games = nation_matches(spark, sf_dir)
    rows = games.select(
        "league", "season", "team", iso_text("date").alias("date"), "venue", "opponent",
        F.col("goals").cast("bigint").alias("GF"), F.col("goals_allowed").cast("bigint").alias("GA"),
        F.col("expected_goals").cast("double").alias("xG"),
        F.col("expected_goals_allowed").cast("double").alias("xGA"),
        F.col("possession").cast("double").alias("Poss"), F.lit("4-3-3").alias("Formation"),
        F.lit("4-4-2").alias("Opp Formation"), "match_report")
    unknown = F.lit(None).cast("bigint")
    folder = f"{landing}/match_team_schedule"
    with stored(rows) as rows:
        write_snapshot(rows.withColumns({"GF": unknown, "GA": unknown}), folder, FIRST_RUN)
        write_snapshot(rows.withColumns({c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("GF", "GA")}),
                       folder, SECOND_RUN)
    if advanced_too:
        land_advanced(spark, sf_dir, f"{landing}/match_team_stats_understat", broken)
    key = F.col("n_nationkey").cast("string")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), key).alias("understat_club_name"),
        F.concat(F.lit("NATION_"), key).alias("master_club_name"))


def land_advanced(spark: SparkSession, sf_dir: str, folder: str, broken: bool = False) -> None:
    """Both weekly snapshots of the second provider."""
    order = F.col("o_orderkey")
    home = F.col("c_nationkey").cast("int")
    away = ((F.col("c_nationkey") + 5 * (1 + order % 4)) % 25).cast("int")
    day = F.col("o_orderdate").cast("date")
    def club(key: Column) -> Column:
        return F.concat(F.lit("N"), key.cast("string"), F.when(F.col("o_orderpriority") == "5-LOW", " FC").otherwise(""))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    advanced = (table(spark, sf_dir, "orders")
                .join(customers, F.col("o_custkey") == F.col("c_custkey")))
    advanced = advanced.select(
        F.lit("all").alias("league"), season_of(day).alias("season"), iso_text(day).alias("date"),
        order.alias("game_id"), F.year(day).alias("season_id"),
        home.alias("home_team_id"), away.alias("away_team_id"),
        club(home).alias("home_team"), club(away).alias("away_team"),
        F.when(order % 3 != 0, club(home)).alias("home_team_code"),
        F.when(order % 3 != 0, club(away)).alias("away_team_code"),
        F.lit(0).alias("home_points"), F.lit(0).alias("away_points"),
        F.when(order % 7 != 0, (order % 160) / 8.0).alias("home_ppda"),
        ((order % 96) / 8.0).alias("away_ppda"),
        (order % 13).alias("home_deep_completions"), (order % 17).alias("away_deep_completions"))
    missing = F.lit(None).cast("double")
    write_snapshot(advanced.withColumns({"home_ppda": missing, "away_ppda": missing}), folder, FIRST_RUN)
    if broken:
        game = F.col("game_id")
        bad = advanced.filter(game % 50 == 0).withColumns({
            "league": F.when(game % 100 != 0, F.col("league")), "date": F.lit(None).cast("string"), "game_id": -1 - game,
            "home_ppda": missing, "away_ppda": missing})
        advanced = advanced.unionByName(bad)
    write_snapshot(advanced, folder, SECOND_RUN)
