"""Names, casts and text coercion over whole driver tables."""

from pyspark.sql import functions as F

from touchline.functions.casts import iso_text, to_day, to_float, to_int, to_moment, whole_or_zero
from touchline.functions.text import league_label, plot_label, season_label, short_season
from touchline.operators.columns import (coerce_mixed, flatten_struct, numeric_profile,
                                         recover_from_json, sanitize_columns)
from touchline.plans import bridge
from touchline.queries import sql
from touchline.queries.registry import query


@query("rescued_json", """
SELECT event_id, coalesce(CASE WHEN event_type = 'click' THEN 'own' END,
                          json_extract_string(props, '$.k')) AS season,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")
def rescued_json(spark, sf_dir):
    events = bridge.table(spark, sf_dir, "events").select(
        "event_id", "props", F.when(F.col("event_type") == "click", "own").alias("season"),
        F.lit(None).cast("string").alias("k"))
    found = recover_from_json(events, {"season": "k", "k": "k"}, "props")
    return found.select("event_id", "season", to_int("k").alias("k"))


@query("typed_casts", """
SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS order_no,
       CAST(trunc(o_totalprice) AS INTEGER) AS price_int, CAST(o_totalprice AS REAL) AS price_float,
       CAST(o_orderdate AS DATE) AS day, CAST(NULL AS INTEGER) AS status_int
FROM orders""")
def typed_casts(spark, sf_dir):
    as_text = bridge.table(spark, sf_dir, "orders").select(
        *[F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")])
    return as_text.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"), to_int("o_orderkey").alias("order_no"),
        to_int("o_totalprice").alias("price_int"), to_float("o_totalprice").alias("price_float"),
        to_day("o_orderdate").alias("day"), to_int("o_orderstatus").alias("status_int"))


@query("numeric_profile", """
WITH t AS (
  SELECT CAST(p_size AS VARCHAR) AS p_size, p_brand, p_type, p_name,
         CASE WHEN p_size % 10 = 0 THEN ' ' || p_size || '.9 ' WHEN p_size % 10 = 1 THEN 'inf' ELSE p_brand END AS mixed
  FROM part),
n AS (
  SELECT 'p_size' AS column_name, p_size AS v FROM t UNION ALL SELECT 'p_brand', p_brand FROM t
  UNION ALL SELECT 'p_type', p_type FROM t UNION ALL SELECT 'p_name', p_name FROM t
  UNION ALL SELECT 'mixed', mixed FROM t)
SELECT column_name, bool_or(TRY_CAST(trim(v) AS DOUBLE) IS NOT NULL AND v <> 'inf') AS has_number,
       count(*) FILTER (WHERE TRY_CAST(trim(v) AS DOUBLE) IS NOT NULL AND v <> 'inf') AS numeric_rows,
       count(*) FILTER (WHERE v = 'inf') AS infinite_rows
FROM n GROUP BY column_name""")
def profile_text_columns(spark, sf_dir):
    return numeric_profile(mixed_part(spark, sf_dir))


def mixed_part(spark, sf_dir):
    size = F.col("p_size")
    mixed = (F.when(size % 10 == 0, F.concat(F.lit(" "), size.cast("string"), F.lit(".9 ")))
              .when(size % 10 == 1, F.lit("inf")).otherwise(F.col("p_brand")))
    return bridge.table(spark, sf_dir, "part").select(
        "p_partkey", size.cast("string").alias("p_size"), "p_brand", "p_type", "p_name", mixed.alias("mixed"))


@query("mixed_coercion", """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_brand, p_type, p_name,
       CASE WHEN p_size % 10 = 0 THEN CAST(p_size AS BIGINT) ELSE 0 END AS mixed
FROM part""")
def mixed_coercion(spark, sf_dir):
    return coerce_mixed(mixed_part(spark, sf_dir))


@query("minute_coercion", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS minute
FROM lineitem""")
def minute_coercion(spark, sf_dir):
    text = (F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("string"))
             .when(F.col("l_returnflag") == "R", F.concat(F.col("l_quantity").cast("string"), F.lit("+2"))))
    return bridge.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", whole_or_zero(text).alias("minute"))


@query("flatten_struct", """
SELECT o_orderkey AS key, o_orderstatus AS order_status, o_totalprice AS order_price,
       o_orderpriority AS priority FROM orders""")
def flatten_two_levels(spark, sf_dir):
    nested = bridge.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("order"),
        F.struct(F.col("o_orderpriority").alias("")).alias("priority"))
    return flatten_struct(nested)


@query("flatten_struct_stripped", """
SELECT o_orderkey AS key, o_orderstatus AS order_status, o_totalprice AS price FROM orders""")
def flatten_two_levels_stripped(spark, sf_dir):
    nested = bridge.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_key_"),
        F.struct(F.col("o_orderstatus").alias("status_")).alias("order"),
        F.struct(F.col("o_totalprice").alias("price")).alias("_")
    )
    return flatten_struct(nested, strip=True)


@query("sanitize_names", """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_quantity AS qty_units, l_returnflag AS return_flag
FROM lineitem""")
def sanitize_names(spark, sf_dir):
    messy = bridge.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("Line-No"),
        F.col("l_quantity").alias("Qty (units)"), F.col("l_returnflag").alias("Return/Flag"))
    return sanitize_columns(messy)


@query("iso_date_text", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date FROM events""")
def iso_date_text(spark, sf_dir):
    return bridge.table(spark, sf_dir, "events").select("event_id", iso_text("ts").alias("date"))


@query("iso_date_round_trip", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(hour(o_orderdate) AS INTEGER) AS hour_of_day
FROM orders""")
def iso_date_round_trip(spark, sf_dir):
    text = bridge.table(spark, sf_dir, "orders").select("o_orderkey", iso_text("o_orderdate").alias("date"))
    return text.select("o_orderkey", to_day("date").alias("day"),
                       F.hour(to_moment("date")).alias("hour_of_day"))


@query("season_labels", f"""
WITH {sql.NATION_RESULTS}
SELECT DISTINCT season, league, team_code,
       '20' || substr(season, 1, 2) || '/' || substr(season, 3, 2) AS season_label,
       regexp_replace(league, '^.*-', '') AS league_label,
       right('20' || substr(season, 1, 2), 2) || '/' || right(substr(season, 3, 2), 2) AS short_season,
       team_code || ' ' || substr(season, 1, 2) || '/' || substr(season, 3, 2) AS plot_label
FROM res""")
def season_labels(spark, sf_dir):
    label = season_label("season")
    return bridge.nation_results(spark, sf_dir).select(
        "season", "league", "team_code", label.alias("season_label"),
        league_label("league").alias("league_label"), short_season(label).alias("short_season"),
        plot_label("team_code", label).alias("plot_label")).distinct()
