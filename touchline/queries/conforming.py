"""Current rows, unpivot, lookups and matching over the customer model."""

from pyspark.sql import functions as F

from touchline.functions.text import extract_id, infer_label, joined_id, tiered_code
from touchline.operators import matching
from touchline.operators.cdc import latest_per_key, one_per_key
from touchline.operators.enrich import fill_from_group, lookup_roles
from touchline.operators.serving import semi_filter
from touchline.plans import bridge
from touchline.plans.silver import standard_rows
from touchline.queries import sql
from touchline.queries.registry import query

LATEST_EVENT = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("latest_per_key_scd1", LATEST_EVENT)
def latest_per_key_scd1(spark, sf_dir):
    events = bridge.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"])


@query("drop_duplicates_on_key", """
SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey
                           ORDER BY l_orderkey, l_linenumber, l_quantity) = 1""")
def drop_duplicates_on_key(spark, sf_dir):
    lines = bridge.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return one_per_key(lines, ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("home_away_unpivot", f"WITH {sql.CUSTOMER_GAMES} SELECT * FROM csides")
def home_away_unpivot(spark, sf_dir):
    return bridge.customer_sides(spark, sf_dir)


@query("fill_group_median", f"""
WITH {sql.CUSTOMER_GAMES},
med AS (SELECT season, quantile_disc(ppda_raw, 0.5) AS m FROM csides WHERE ppda_raw IS NOT NULL GROUP BY season)
SELECT game_team_id, season, ppda_raw, coalesce(ppda_raw, m) AS ppda
FROM csides LEFT JOIN med USING (season)""")
def fill_group_median(spark, sf_dir):
    sides = bridge.customer_sides(spark, sf_dir).select("game_team_id", "season", "ppda_raw")
    return fill_from_group(sides, "ppda_raw", ["season"], "ppda", accuracy=1_000_000)


@query("dimension_two_roles", f"""
WITH {sql.CUSTOMER_GAMES}
SELECT game_team_id, t.c_name AS master_team_name, o.c_name AS master_opp_name
FROM csides LEFT JOIN customer t ON team = t.c_custkey LEFT JOIN customer o ON opponent = o.c_custkey""")
def dimension_two_roles(spark, sf_dir):
    names = bridge.table(spark, sf_dir, "customer")
    sides = bridge.customer_sides(spark, sf_dir).select("game_team_id", "team", "opponent")
    sides = lookup_roles(sides, names, {"team": "master_team_name", "opponent": "master_opp_name"}, "c_custkey", "c_name")
    return sides.select("game_team_id", "master_team_name", "master_opp_name")


@query("best_match_join", f"""
WITH {sql.CUSTOMER_GAMES}
SELECT l.game_team_id, r.game_team_id AS matched_id, r.ppda_raw AS ppda, r.deep_completions
FROM csides l LEFT JOIN csides r ON l.team = r.team AND l.opponent = r.opponent AND l.season = r.season
QUALIFY row_number() OVER (PARTITION BY l.game_team_id
  ORDER BY (l.venue <> r.venue), abs(datediff('day', l.date, r.date)), r.game_team_id) = 1""")
def best_match_join(spark, sf_dir):
    sides = bridge.customer_sides(spark, sf_dir)
    left = sides.select("game_team_id", "team", "opponent", "season", "venue", "date")
    right = sides.select("team", "opponent", "season", "venue", "date",
                         F.col("game_team_id").alias("matched_id"), F.col("ppda_raw").alias("ppda"),
                         "deep_completions")
    matched = matching.best_match_join(left, right, ["team", "opponent", "season"], "venue", "date",
                                       "matched_id", ["matched_id", "ppda", "deep_completions"])
    return matched.select("game_team_id", "matched_id", "ppda", "deep_completions")


@query("team_code_tiers", """
SELECT c_custkey, n_name,
       coalesce(CASE WHEN c_acctbal > 5000 THEN 'N' || n_nationkey END,
                CASE n_name WHEN 'NATION_1' THEN 'ONE' WHEN 'NATION_2' THEN 'TWO'
                            WHEN 'NATION_7' THEN 'SEV' WHEN 'NATION_11' THEN 'ELV' END,
                upper(substr(n_name, 1, 3))) AS team_code
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def team_code_tiers(spark, sf_dir):
    """Provider code, else fixed table, else letters, for every customer."""
    teams = bridge.table(spark, sf_dir, "customer").join(
        bridge.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    provider = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    return teams.select("c_custkey", "n_name",
                        tiered_code(provider, "n_name", bridge.NATION_CODES).alias("team_code"))


@query("url_id_and_league", """
WITH u AS (
  SELECT o_orderkey, o_orderpriority AS team,
         CASE WHEN o_orderkey % 11 = 3 THEN '/en/stathead/' || o_orderkey
              WHEN o_orderkey % 11 <> 7 THEN '/en/matches/' || o_orderkey || '/x-' ||
                   CASE o_orderkey % 6 WHEN 0 THEN 'Bundesliga' WHEN 1 THEN 'Premier-League'
                     WHEN 2 THEN 'Ligue-1' WHEN 3 THEN 'Serie-A' WHEN 4 THEN 'La-Liga' ELSE 'Cup' END
         END AS url,
         CASE WHEN o_orderkey % 5 = 0 THEN 'KNOWN' END AS league0
  FROM orders),
v AS (
  SELECT o_orderkey, team, regexp_extract(url, '/en/matches/([^/]+)/', 1) AS result_id,
         coalesce(league0, CASE WHEN contains(url, 'Bundesliga') THEN 'GER-Bundesliga'
           WHEN contains(url, 'Premier-League') THEN 'ENG-Premier League'
           WHEN contains(url, 'Ligue-1') THEN 'FRA-Ligue 1' WHEN contains(url, 'Serie-A') THEN 'ITA-Serie A'
           WHEN contains(url, 'La-Liga') THEN 'ESP-La Liga' END) AS league
  FROM u)
SELECT o_orderkey, result_id, result_id || '-' || team AS result_team_id, league
FROM v WHERE league IS NOT NULL AND result_id IS NOT NULL""")
def url_id_and_league(spark, sf_dir):
    key = F.col("o_orderkey")
    suffix = F.element_at(F.array(*[F.lit(s) for s in ("Bundesliga", "Premier-League", "Ligue-1",
                                                       "Serie-A", "La-Liga", "Cup")]),
                          (key % 6 + 1).cast("int"))
    match = F.concat(F.lit("/en/matches/"), key.cast("string"), F.lit("/x-"), suffix)
    url = (F.when(key % 11 == 3, F.concat(F.lit("/en/stathead/"), key.cast("string")))
            .when(key % 11 != 7, match))
    rows = bridge.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", url.alias("url"), F.when(key % 5 == 0, F.lit("KNOWN")).alias("known"))
    result_id = extract_id("url")
    return (rows.select("o_orderkey", result_id.alias("result_id"),
                        joined_id(result_id, "o_orderpriority").alias("result_team_id"),
                        infer_label("known", "url").alias("league"))
                .dropna(subset=["league", "result_team_id"]))


@query("page_url_id", """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host FROM pages""")
def page_url_id(spark, sf_dir):
    return bridge.table(spark, sf_dir, "pages").select(
        "page_id", extract_id("url", r"^https?://([^/]+)/").alias("host"))


@query("semi_filter", f"""
WITH {sql.CUSTOMER_GAMES}
SELECT game_team_id, team, venue FROM csides
WHERE team IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_filter_teams(spark, sf_dir):
    teams = (bridge.table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
                   .select(F.col("c_custkey").alias("team")))
    sides = bridge.customer_sides(spark, sf_dir).select("game_team_id", "team", "venue")
    return semi_filter(sides, teams, ["team"])


@query("crowded_match_join", """
WITH o AS (
  SELECT o_orderkey, o_orderstatus AS team, o_orderpriority AS opponent,
         CASE WHEN o_totalprice < 250000 THEN 'Home' ELSE 'Away' END AS venue, CAST(o_orderdate AS DATE) AS date
  FROM orders),
held AS (SELECT team, opponent, venue, date, min(o_orderkey) AS id FROM o GROUP BY ALL),
asked AS (SELECT DISTINCT team, opponent, venue, date + 3 AS date FROM o),
picked AS (
  SELECT a.*, h.id FROM asked a JOIN held h ON a.team = h.team AND a.opponent = h.opponent
  QUALIFY row_number() OVER (PARTITION BY a.team, a.opponent, a.venue, a.date
    ORDER BY (a.venue <> h.venue), abs(datediff('day', a.date, h.date)), h.id) = 1)
SELECT o.o_orderkey, p.id AS matched_id FROM o JOIN picked p
  ON o.team = p.team AND o.opponent = p.opponent AND o.venue = p.venue AND o.date + 3 = p.date""")
def crowded_match_join(spark, sf_dir):
    """Fifteen keys share all orders: each row finds its nearest counterpart without pairs."""
    venue = F.when(F.col("o_totalprice") < 250000, "Home").otherwise("Away")
    rows = bridge.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("team"), F.col("o_orderpriority").alias("opponent"),
        venue.alias("venue"), F.col("o_orderdate").cast("date").alias("date"))
    left = rows.withColumn("date", F.date_add("date", 3))
    right = rows.withColumnRenamed("o_orderkey", "matched_id")
    matched = matching.best_match_join(left, right, ["team", "opponent"], "venue", "date",
                                       "matched_id", ["matched_id"])
    return matched.select("o_orderkey", "matched_id")


@query("one_season_rows", f"""
WITH {sql.NATION_RESULTS}
SELECT result_team_id, season, league, team, venue FROM res WHERE season = (SELECT max(season) FROM res)""")
def one_season_rows(spark, sf_dir):
    """The cleaned rows of a run that is restricted to one season."""
    rows = bridge.nation_matches(spark, sf_dir)
    newest = rows.filter("match_report IS NOT NULL").agg(F.max("season")).first()[0]
    texts = {c: F.lit(None).cast("string") for c in ("Formation", "Opp Formation", "_rescued_data", "source_file")}
    bronze = rows.select("league", "season", "team", "opponent", "venue", "date", "match_report").withColumns({
        "GF": F.lit(1), "GA": F.lit(1), "xG": F.lit(1.0), "xGA": F.lit(1.0), "Poss": F.lit(50.0), **texts,
        "ingestion_date": F.lit("2001-09-01"), "file_modification_time": F.lit(None).cast("timestamp")})
    return standard_rows(bronze, season=newest).select("result_team_id", "season", "league", "team", "venue")
