"""Files in and out: snapshots, drift, streams and a full run."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.cdc import latest_per_key
from touchline.operators.enrich import to_sides
from touchline.operators.recency import recent_rows
from touchline.plans import bridge
from touchline.plans.bronze import run_bronze
from touchline.plans.catalogue import ADVANCED_FOLDER, BRONZE_FOLDERS, LEAGUES, MATCH_STATS, SHOTS_FOLDER, Layout, match_folder
from touchline.plans.land import land_all
from touchline.plans.pipeline import read_gold, run_pipeline, run_report
from touchline.queries import sql
from touchline.queries.conforming import LATEST_EVENT
from touchline.queries.registry import query
from touchline.session import scratch_dir, small_on_disk
from touchline.sinks.tables import Published, audited, write_clustered, write_snapshot
from touchline.sources.landing import read_newest, scan_landing
from touchline.streaming.current import CurrentTable, read_batches, running_latest, write_batches
from touchline.streaming.ingest import append_stream, ingest_files, read_ingested

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders"


def orders(spark, sf_dir):
    return bridge.table(spark, sf_dir, "orders")


def shuffled_event_files(spark, sf_dir, folder):
    """All events in three sets of files whose time ranges overlap, newest set first."""
    events = bridge.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    for day in (2, 0, 1):
        events.filter(F.dayofmonth("ts") % 3 == day).write.mode("append").parquet(folder)
    return events.schema


@query("stream_scd1", LATEST_EVENT)
def stream_scd1(spark, sf_dir):
    """Change log per batch, folded after each of two runs."""
    work = scratch_dir(spark, "scd1")
    schema = shuffled_event_files(spark, sf_dir, f"{work}/in")
    table = CurrentTable(spark, f"{work}/table", ("user_id",), "ts", ("event_id",))
    stream = scan_landing(spark, f"{work}/in", schema, streaming=True, max_files=2).select(*schema.names)
    table.log_changes(stream, f"{work}/checkpoint")
    table.fold_changes()
    table.log_changes(stream, f"{work}/checkpoint")
    table.fold_changes()
    return table.read().select(*schema.names)


@query("stream_scd1_running", LATEST_EVENT)
def stream_scd1_running(spark, sf_dir):
    """The same as streaming state: each batch emits the keys it touched."""
    work = scratch_dir(spark, "scd1-state")
    schema = shuffled_event_files(spark, sf_dir, f"{work}/in")
    stream = scan_landing(spark, f"{work}/in", schema, streaming=True, max_files=2).select(*schema.names)
    current = running_latest(stream, ["user_id"], "ts", ["event_id"])
    write_batches(current, f"{work}/out", f"{work}/checkpoint", "update")
    emitted = read_batches(spark, f"{work}/out", schema)
    return latest_per_key(emitted, ["user_id"], "change_batch").select(*schema.names)


@query("stream_append", "SELECT event_id, user_id, value, 'events.parquet' AS file_name FROM events")
def stream_append(spark, sf_dir):
    """The events file itself as an append-only streaming table with its metadata."""
    work = scratch_dir(spark, "append")
    rows = scan_landing(spark, sf_dir, bridge.table(spark, sf_dir, "events").schema,
                        streaming=True, names="events.parquet")
    append_stream(rows, f"{work}/table", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/table").select(
        "event_id", "user_id", "value", F.element_at(F.split("source_file", "/"), -1).alias("file_name"))


@query("stream_unpivot", """
SELECT event_id, user_id AS team, event_type AS opponent, 'Home' AS venue FROM events WHERE value > 10
UNION ALL SELECT event_id, NULL, event_type, 'Away' FROM events WHERE value > 10""")
def stream_unpivot(spark, sf_dir):
    """Filter and fan out one row to two on a stream; a column of one side only is NULL on the other."""
    work = scratch_dir(spark, "unpivot")
    rows = scan_landing(spark, sf_dir, bridge.table(spark, sf_dir, "events").schema,
                        streaming=True, names="events.parquet").filter("value > 10")
    sides = to_sides(rows, ["event_id"], {"team": "user_id", "opponent": "event_type"},
                     {"opponent": "event_type"})
    append_stream(sides, f"{work}/table", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/table")


@query("ingest_metadata", """
SELECT o_orderkey, 'orders.parquet' AS file_name, true AS has_time, '2001-09-01' AS ingestion_date FROM orders""")
def ingest_metadata(spark, sf_dir):
    rows = scan_landing(spark, f"{sf_dir}/orders.parquet")
    return rows.select(
        "o_orderkey", F.element_at(F.split("source_file", "/"), -1).alias("file_name"),
        F.col("file_modification_time").isNotNull().alias("has_time"),
        F.lit("2001-09-01").alias("ingestion_date"))


@query("clustered_write_roundtrip", ORDERS_SQL)
def clustered_write_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "clustered")
    write_clustered(orders(spark, sf_dir), path, ["o_orderdate", "o_orderpriority"])
    return spark.read.parquet(path).select(*ORDER_COLUMNS)


@query("snapshot_same_day_overwrite", """
SELECT o_orderkey, o_totalprice, '2001-09-01' AS ingestion_date FROM orders
UNION ALL SELECT o_orderkey, o_totalprice * 2, '2001-09-08' FROM orders""")
def snapshot_same_day_overwrite(spark, sf_dir):
    """The second day is written twice; only its last write and the first day remain."""
    path = scratch_dir(spark, "snapshots")
    rows = orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    doubled = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for run_date, df in (("2001-09-01", rows), ("2001-09-08", rows), ("2001-09-08", doubled)):
        write_snapshot(df, path, run_date)
    schema = "o_orderkey bigint, o_totalprice double, ingestion_date string"
    return spark.read.schema(schema).parquet(path)


@query("partitioned_snapshot", f"""
SELECT o_orderkey, {sql.SEASON} AS season, '2001-09-01' AS ingestion_date FROM orders
UNION ALL SELECT o_orderkey, {sql.SEASON}, '2001-09-08' FROM orders""")
def partitioned_snapshot(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    rows = orders(spark, sf_dir).select("o_orderkey", bridge.season_of(F.col("o_orderdate")).alias("season"))
    for run_date in ("2001-09-01", "2001-09-08", "2001-09-08"):
        write_snapshot(rows, path, run_date, ["season"])
    return spark.read.schema("o_orderkey bigint, season string, ingestion_date string").parquet(path)


@query("newest_file_rows", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-06-01' - 7 AND o_orderkey % 11 <> 7""")
def newest_file_rows(spark, sf_dir):
    """Of three snapshots the newest is read and cut to its recent, played rows."""
    path = scratch_dir(spark, "newest")
    key = F.col("o_orderkey")
    rows = orders(spark, sf_dir).select(key, "o_orderdate", bridge.report_url(key, gaps=True).alias("match_report"))
    for run_date, df in (("2001-09-08", rows.withColumn("o_orderkey", key + 1_000_000_000)),
                         ("2001-09-15", rows.withColumn("o_orderkey", -key)), ("2001-09-01", rows)):
        write_snapshot(df, path, run_date)
    return recent_rows(read_newest(spark, path), "o_orderdate", dt.date(2001, 6, 1)).select("o_orderkey", "o_orderdate")


@query("schema_drift_scan", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'O' THEN CAST(o_custkey AS BIGINT)
            WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS BIGINT) END
            ELSE CASE WHEN o_custkey % 4 = 0 THEN CAST(o_custkey / 4 AS BIGINT) END END AS gf,
       CASE WHEN o_orderstatus = 'F' AND o_custkey % 2 = 1 THEN o_custkey || ' (4)'
            WHEN o_orderstatus = 'P' AND o_custkey % 4 = 1 THEN CAST(o_custkey / 4.0 AS VARCHAR)
            WHEN o_orderstatus = 'P' AND o_custkey % 4 = 2 THEN CAST(o_custkey / 4.0 AS VARCHAR)
            WHEN o_orderstatus = 'P' AND o_custkey % 4 = 3 THEN CAST(o_custkey / 4.0 AS VARCHAR) END AS rescued_gf,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS extra
FROM orders""")
def schema_drift_scan(spark, sf_dir):
    """One column as whole number, as text and as fraction, plus a new column, over two runs."""
    work = scratch_dir(spark, "drift")
    rows = orders(spark, sf_dir)
    gf = F.col("o_custkey")
    text = F.when(gf % 2 == 0, gf.cast("string")).otherwise(F.concat(gf.cast("string"), F.lit(" (4)")))
    def land(status, run_date, value, *extra):
        write_snapshot(rows.filter(F.col("o_orderstatus") == status).select("o_orderkey", value.alias("GF"), *extra),
                       f"{work}/in", run_date)
    def ingest():
        ingest_files(spark, f"{work}/in", f"{work}/table", f"{work}/checkpoint", f"{work}/schema",
                     cluster_by=["ingestion_date"])
    land("O", "2001-09-01", gf)
    ingest()
    land("F", "2001-09-08", text)
    land("P", "2001-09-15", gf / 4.0, F.col("o_orderpriority").alias("extra"))
    ingest()
    table = read_ingested(spark, f"{work}/table", f"{work}/schema")
    return table.select("o_orderkey", F.col("GF").alias("gf"),
                        F.get_json_object("_rescued_data", "$.GF").alias("rescued_gf"), "extra")


def full_run(spark, sf_dir, advanced_too=True, broken=False):
    """Land the nation model and run all stages."""
    work = scratch_dir(spark, "full-run")
    layout = Layout(f"{work}/landing", f"{work}/warehouse")
    with small_on_disk(spark):
        mapping = bridge.land_nation_model(spark, sf_dir, layout.landing, advanced_too, broken)
    run_pipeline(spark, layout, mapping, as_of=dt.date(2001, 7, 1))
    return layout


FULL_RUN_SQL = f"""
WITH {sql.NATION_RESULTS},
adv AS (
  SELECT game_id, {sql.SEASON.replace('o_orderdate', 'date')} AS season, date, h, a,
         CASE WHEN game_id % 3 <> 0 THEN 1 END AS coded,
         CASE WHEN game_id % 7 <> 0 THEN CAST((game_id % 160) / 8.0 AS REAL) END AS hp,
         CAST((game_id % 96) / 8.0 AS REAL) AS ap, o_orderpriority <> '5-LOW' AS mapped
  FROM game JOIN orders ON o_orderkey = game_id),
adv_side AS (
  SELECT game_id || '-' || h AS game_team_id, game_id, season, date, 'NATION_' || h AS team,
         'NATION_' || a AS opponent, 'N' || h AS club, CASE WHEN coded = 1 THEN 'N' || h END AS code,
         hp AS raw, game_id % 13 AS deep, 'Home' AS venue, mapped FROM adv
  UNION ALL
  SELECT game_id || '-' || a, game_id, season, date, 'NATION_' || a, 'NATION_' || h, 'N' || a,
         CASE WHEN coded = 1 THEN 'N' || a END, ap, game_id % 17, 'Away', mapped FROM adv),
med AS (SELECT season, quantile_disc(raw, 0.5) AS m FROM adv_side WHERE raw IS NOT NULL GROUP BY season),
advanced AS (SELECT adv_side.*, coalesce(raw, m) AS ppda FROM adv_side LEFT JOIN med USING (season)),
silver AS (
  SELECT r.* EXCLUDE (team_code), v.game_team_id AS result_team_id_understat,
         CAST(v.game_id AS INTEGER) AS result_id_understat, v.ppda, v.deep AS deep_completions,
         coalesce(v.club, r.team) AS team_understat,
         coalesce(v.code, upper(substr(r.team, 1, 3))) AS team_code
  FROM res r LEFT JOIN advanced v ON r.team = v.team AND r.opponent = v.opponent AND r.season = v.season
       AND v.mapped
  QUALIFY row_number() OVER (PARTITION BY r.result_team_id
    ORDER BY (r.venue <> v.venue), abs(datediff('day', r.date, v.date)), v.game_team_id) = 1)
"""


@query("full_run_results", FULL_RUN_SQL + """
SELECT result_team_id, result_id, team_id, league, season, date, team, opponent, venue, result, expected_result,
       points, expected_result_points, goals, goals_allowed, goal_difference, expected_goals,
       expected_goals_allowed, expected_goal_difference, possession, result_team_id_understat,
       result_id_understat, team_understat, team_code AS team_code_understat, ppda, deep_completions
FROM silver""")
def full_run_results(spark, sf_dir):
    """The silver table of a run over landed snapshots of both providers."""
    return Published(spark, full_run(spark, sf_dir).table("results")).read().select(
        "result_team_id", "result_id", "team_id", "league", "season", "date", "team", "opponent", "venue",
        "result", "expected_result", "points", "expected_result_points", "goals", "goals_allowed",
        "goal_difference", "expected_goals", "expected_goals_allowed", "expected_goal_difference", "possession",
        "result_team_id_understat", "result_id_understat", "team_understat", "team_code_understat", "ppda",
        "deep_completions")


@query("full_run_headline", f"{FULL_RUN_SQL} {sql.totals('silver')}")
def full_run_headline(spark, sf_dir):
    return read_gold(spark, full_run(spark, sf_dir), "headline_stats")


@query("full_run_form", f"{FULL_RUN_SQL}, {sql.RECENT.replace('FROM res', 'FROM silver')} {sql.totals('recent')}")
def full_run_form(spark, sf_dir):
    return read_gold(spark, full_run(spark, sf_dir), "form_stats")


@query("full_run_rolling", f"{FULL_RUN_SQL}, {sql.ROLLING.replace('FROM res', 'FROM silver')} SELECT * FROM rolling")
def full_run_rolling(spark, sf_dir):
    return read_gold(spark, full_run(spark, sf_dir), "rolling_stats")


@query("full_run_one_provider", f"""
WITH {sql.NATION_RESULTS}
SELECT result_team_id, result, points, goals, CAST(NULL AS VARCHAR) AS result_team_id_understat, team AS team_understat,
       upper(substr(team, 1, 3)) AS team_code_understat, CAST(NULL AS REAL) AS ppda, CAST(NULL AS BIGINT) AS deep_completions
FROM res""")
def full_run_one_provider(spark, sf_dir):
    """A run before the second provider has landed anything."""
    return Published(spark, full_run(spark, sf_dir, advanced_too=False).table("results")).read().select(
        "result_team_id", "result", "points", "goals", "result_team_id_understat", "team_understat",
        "team_code_understat", "ppda", "deep_completions")


@query("full_run_rule_counts", f"""
WITH {sql.NATION_RESULTS},
bad AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 100 = 0) AS unnamed FROM orders WHERE o_orderkey % 50 = 0),
sides AS (SELECT 2 * (SELECT count(*) FROM orders) + 2 * n AS n, 2 * n AS undated, 2 * unnamed AS unnamed FROM bad),
tot AS (SELECT count(DISTINCT team_id) AS n FROM res),
form AS (SELECT count(DISTINCT team_id) AS n FROM res WHERE season = (SELECT max(season) FROM res)),
advanced AS (
  SELECT 'results_advanced' AS "table", 'silver' AS quality, rule || '_not_null' AS rule, 'drop' AS action, n AS checked, n - undated AS kept,
         CASE rule WHEN 'date' THEN undated WHEN 'league' THEN unnamed ELSE 0 END AS broken
  FROM sides, (SELECT unnest(['league', 'season_understat', 'game_id', 'date']) AS rule)),
results AS (
  SELECT 'results', 'silver', rule || '_not_null', 'fail', (SELECT count(*) FROM res), (SELECT count(*) FROM res), 0
  FROM (SELECT unnest(['result_team_id', 'result_id', 'team_id', 'league', 'season', 'date', 'team']) AS rule))
SELECT * FROM advanced UNION ALL SELECT * FROM results
UNION ALL SELECT 'headline_stats', 'gold', rule, 'fail', n, n, 0
  FROM tot, (SELECT unnest(['headline_points_not_null', 'headline_league_format', 'headline_mp_consistency']) AS rule)
UNION ALL SELECT 'form_stats', 'gold', rule, CASE rule WHEN 'form_points_not_null' THEN 'drop' ELSE 'fail' END, n, n, 0
  FROM form, (SELECT unnest(['form_points_not_null', 'form_league_format', 'form_mp_check']) AS rule)""")
def full_run_rule_counts(spark, sf_dir):
    """What a run over games without dates and leagues recorded: rows checked, kept and breaking each rule."""
    report = run_report(spark, full_run(spark, sf_dir, broken=True))
    return report.filter("rule IS NOT NULL AND comment <> ''").select("table", "quality", "rule", "action", "checked", "kept", "broken")


@query("catalogue_landing", """
SELECT folder, CASE WHEN folder = 'match_team_misc' THEN 'failed' ELSE 'ok' END AS landed,
       CAST(CASE WHEN folder <> 'match_team_misc' THEN n END AS BIGINT) AS n_rows, CAST(CASE WHEN folder <> 'match_team_misc' THEN total END AS BIGINT) AS total
FROM (SELECT CASE o_orderkey % 11 WHEN 0 THEN 'match_team_schedule' WHEN 1 THEN 'match_team_keeper' WHEN 2 THEN 'match_team_passing'
             WHEN 3 THEN 'match_team_passing_types' WHEN 4 THEN 'match_team_defense' WHEN 5 THEN 'match_team_possession'
             WHEN 6 THEN 'match_team_misc' WHEN 7 THEN 'match_team_shooting' WHEN 8 THEN 'match_team_goal_shot_creation'
             WHEN 9 THEN 'match_individual_shots' ELSE 'match_team_stats_understat' END AS folder,
             count(*) AS n, sum(o_custkey) AS total
      FROM orders GROUP BY 1)""")
def catalogue_landing(spark, sf_dir):
    """Eleven datasets landed and ingested by the catalogue; one of them fails and the others come through."""
    layout = Layout(*[scratch_dir(spark, "catalogue")] * 2)
    bronze = {folder: table for table, folder in BRONZE_FOLDERS.items()}
    folders = [*[match_folder(s) for s in MATCH_STATS], SHOTS_FOLDER, ADVANCED_FOLDER]
    order = ["schedule", "keeper", "passing", "passing_types", "defense", "possession", "misc", "shooting", "goal_shot_creation"]
    share = {match_folder(s): i for i, s in enumerate(order)} | {SHOTS_FOLDER: 9, ADVANCED_FOLDER: 10}

    def raw(folder):
        rows = orders(spark, sf_dir).filter(F.col("o_orderkey") % 11 == share[folder])
        season = bridge.season_of(F.col("o_orderdate"))
        rows = rows.select(F.lit(LEAGUES[0]).alias("league"), season.alias("season"), F.col("o_orderdate").alias("date"),
                           F.struct(F.col("o_custkey").cast("string").alias("value")).alias("stat"), F.lit("7").alias("minute"))
        if folder == "match_team_misc":
            return rows.withColumn("stat", F.raise_error(F.lit("the provider sent no page")))
        return rows.withColumn("stat", F.col("stat.value")) if folder == ADVANCED_FOLDER else rows
    landed = land_all({f: lambda f=f: raw(f) for f in folders}, layout.landing, "2001-09-01", LEAGUES)
    run_bronze(spark, layout, [bronze[f] for f in folders if landed[f] == "ok"])

    def ingested(folder):
        table = bronze[folder]
        rows = read_ingested(spark, layout.table(table), layout.schema(table))
        value = F.col("stat" if folder == ADVANCED_FOLDER else "stat_value").cast("bigint")
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total")).select(
            F.lit(folder).alias("folder"), F.lit("ok").alias("landed"), "n_rows", "total")
    good = reduce(DataFrame.unionByName, [ingested(f) for f in folders if landed[f] == "ok"])
    bad = [(f, landed[f].partition(":")[0], None, None) for f in folders if landed[f] != "ok"]
    return good.unionByName(spark.createDataFrame(bad, "folder string, landed string, n_rows long, total long"))


@query("season_in_path_and_file", f"""
SELECT o_orderkey, {sql.SEASON} AS season, '2001-09-01' AS ingestion_date FROM orders""")
def season_in_path_and_file(spark, sf_dir):
    """Files that carry another season than the folder they lie in: the folder wins and stays text."""
    work = scratch_dir(spark, "both")
    rows = orders(spark, sf_dir).select("o_orderkey", bridge.season_of(F.col("o_orderdate")).alias("folder"), F.lit(1).alias("season"))
    for season in [r[0] for r in rows.select("folder").distinct().collect()]:
        rows.filter(F.col("folder") == season).drop("folder").write.parquet(f"{work}/in/season={season}/ingestion_date=2001-09-01")
    ingest_files(spark, f"{work}/in", f"{work}/table", f"{work}/checkpoint", f"{work}/schema")
    return read_ingested(spark, f"{work}/table", f"{work}/schema").select("o_orderkey", "season", "ingestion_date")


@query("audit_column", "SELECT o_orderstatus, count(*) AS n_rows, count(*) AS n_dated, 1 AS moments FROM orders GROUP BY o_orderstatus")
def audit_column(spark, sf_dir):
    """The moment of a run is on every row of a published table, and it is one moment."""
    table = Published(spark, scratch_dir(spark, "audited"))
    table.publish(audited(orders(spark, sf_dir).repartition(8)), partition_by=["o_orderstatus"])
    moments = F.count_distinct("update_date").cast("int")
    return table.read().groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("update_date").alias("n_dated"), moments.alias("moments"))
