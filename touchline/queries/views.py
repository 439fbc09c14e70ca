"""Tables and charts over the gold tables of the nation model."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.columns import display_names, project_existing
from touchline.operators.ranking import group_quantiles, position, quartile_bands
from touchline.operators.serving import Trace, compare_trends, distinct_values, semi_filter
from touchline.operators.totals import last_n_form, season_totals
from touchline.operators.trend import rolling_mean
from touchline.plans import bridge, views
from touchline.plans.gold import publish_gold, rolling_stats
from touchline.queries import sql
from touchline.queries.registry import query
from touchline.session import freeze, scratch_dir
from touchline.sinks.tables import Published

TOTALS_SQL = f"WITH {sql.NATION_RESULTS}, tot AS ({sql.totals('res')})"
FORM_SQL = f"WITH {sql.NATION_RESULTS}, {sql.RECENT}, form AS ({sql.totals('recent')})"


def display_list(columns, skip=()):
    """Select list that renames a totals column to its display name."""
    return ", ".join(f'"{c.replace(" ", "_")}" AS "{c}"' for c in columns if c not in skip)


def totals(spark, sf_dir):
    """The stored totals table: several operators read it, so it is computed once."""
    return freeze(season_totals(bridge.nation_results(spark, sf_dir)))


def form(spark, sf_dir):
    return freeze(last_n_form(bridge.nation_results(spark, sf_dir)))


def served(spark, rows):
    """A totals table as views read it: published in folders by league and season."""
    return publish_gold(Published(spark, scratch_dir(spark, "served")), rows)


def served_totals(spark, sf_dir):
    return served(spark, season_totals(bridge.nation_results(spark, sf_dir)))


def served_form(spark, sf_dir):
    return served(spark, last_n_form(bridge.nation_results(spark, sf_dir)))


@query("display_projection", f"""
{TOTALS_SQL} SELECT {display_list(views.COMBINED_ORDER, ("Position",))} FROM tot""")
def display_projection(spark, sf_dir):
    return project_existing(display_names(totals(spark, sf_dir)), views.COMBINED_ORDER)


@query("distinct_filter_values", f"""
{TOTALS_SQL}
SELECT 'League' AS filter, "League" AS value FROM (SELECT DISTINCT "League" FROM tot)
UNION ALL SELECT 'Season', "Season" FROM (SELECT DISTINCT "Season" FROM tot)
UNION ALL SELECT 'Team', "Team" FROM (SELECT DISTINCT "Team" FROM tot)""")
def distinct_filter_values(spark, sf_dir):
    table = served_totals(spark, sf_dir)
    lists = [distinct_values(table, c, c == "Season").select(F.lit(c).alias("filter"), F.col(c).alias("value"))
             for c in ("League", "Season", "Team")]
    return reduce(DataFrame.unionByName, lists)


@query("league_table_position", f"""
{TOTALS_SQL}
SELECT "Season", "League", row_number() OVER (PARTITION BY "Season", "League"
         ORDER BY "Points" DESC NULLS LAST, "Team") AS "Position", "Team", "MP", "Points", "PPG"
FROM tot""")
def league_table_position(spark, sf_dir):
    ranked = position(totals(spark, sf_dir), "Points", within=["Season", "League"])
    return ranked.select("Season", "League", "Position", "Team", "MP", "Points", "PPG")


@query("league_table_view", f"""
{TOTALS_SQL}
SELECT row_number() OVER (ORDER BY "Points" DESC NULLS LAST, "Team") AS "Position",
       {display_list(views.LEAGUE_ORDER, ("Position",))}
FROM tot WHERE "League" = 'ASIA' AND "Season" = '2019/20'""")
def league_table_view(spark, sf_dir):
    return views.league_table(served_totals(spark, sf_dir), "ASIA", "2019/20")


@query("form_table_position", f"""
{FORM_SQL}
SELECT "League", row_number() OVER (PARTITION BY "League" ORDER BY "Points" DESC NULLS LAST, "Team")
         AS "Position", "Team", "MP", "Points"
FROM form""")
def form_table_position(spark, sf_dir):
    ranked = position(form(spark, sf_dir), "Points", within=["League"])
    return ranked.select("League", "Position", "Team", "MP", "Points")


@query("combined_table_position", f"""
{TOTALS_SQL}
SELECT "Season", row_number() OVER (PARTITION BY "Season"
         ORDER BY "xGD_PG" ASC NULLS LAST, "Team", "League") AS "Position", "Team", "League", "xGD_PG"
FROM tot""")
def combined_table_position(spark, sf_dir):
    ranked = position(totals(spark, sf_dir), "xGD_PG", ascending=True, within=["Season"],
                      ties=["Team", "League"])
    return ranked.select("Season", "Position", "Team", "League", "xGD_PG")


@query("combined_form_table", f"""
{FORM_SQL}
SELECT row_number() OVER (ORDER BY "PPG" DESC NULLS LAST, "Team", "League") AS "Position",
       {display_list(views.COMBINED_ORDER, ("Position",))}
FROM form""")
def combined_form_table(spark, sf_dir):
    return views.combined_table(served_form(spark, sf_dir), None)


@query("historic_table", f"""
{TOTALS_SQL}
SELECT row_number() OVER (ORDER BY "PPG" DESC NULLS LAST, "Team", "Season", "League") AS "Position",
       {display_list(views.HISTORIC_ORDER, ("Position",))}
FROM tot""")
def historic_table(spark, sf_dir):
    return views.historic_table(served_totals(spark, sf_dir))


@query("order_position_whole_table", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS "Position"
FROM orders""")
def order_position_whole_table(spark, sf_dir):
    """Numbers a whole table as one view."""
    orders = bridge.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return position(orders, "o_totalprice", ties=["o_orderkey"]).select(
        "o_orderkey", "Position")


def band_sql(source, metric, within, columns, labels):
    part = f"PARTITION BY {within}" if within else ""
    q = [f'quantile_cont(CAST("{metric}" AS DOUBLE), {p}) OVER ({part})' for p in (0, 0.25, 0.5, 0.75, 1)]
    return f"""
SELECT {columns}, CASE
   WHEN NOT coalesce(e0 < e1 AND e1 < e2 AND e2 < e3 AND e3 < e4, false) THEN 'Q1 (Low)'
   WHEN m <= e1 THEN '{labels[0]}' WHEN m <= e2 THEN '{labels[1]}' WHEN m <= e3 THEN '{labels[2]}'
   WHEN m IS NOT NULL THEN '{labels[3]}' END AS "Quartile"
FROM (SELECT *, CAST("{metric}" AS DOUBLE) AS m, {q[0]} AS e0, {q[1]} AS e1, {q[2]} AS e2, {q[3]} AS e3,
             {q[4]} AS e4 FROM {source})"""


UP = ("Q1 (Low)", "Q2", "Q3", "Q4 (High)")
DOWN = tuple(reversed(UP))


@query("quartile_bands", f"""
{TOTALS_SQL} {band_sql('tot', 'xG', '"Season"', '"Team-Season", "xG"', UP)}""")
def quartile_bands_by_season(spark, sf_dir):
    return quartile_bands(totals(spark, sf_dir), "xG", ["Season"]).select("Team-Season", "xG", "Quartile")


@query("quartile_bands_reversed", f"""
{TOTALS_SQL} {band_sql('tot', 'GA', '', '"Team-Season", "GA"', DOWN)}""")
def quartile_bands_reversed(spark, sf_dir):
    return quartile_bands(totals(spark, sf_dir), "GA").select("Team-Season", "GA", "Quartile")


@query("quartile_bands_tied_edges", f"""
{FORM_SQL} {band_sql('form', 'W', '"League"', '"Team-Season", "W"', UP)}""")
def quartile_bands_tied_edges(spark, sf_dir):
    """Views of five teams, where equal edges put the whole view in the low band."""
    return quartile_bands(form(spark, sf_dir), "W", ["League"]).select("Team-Season", "W", "Quartile")


@query("line_quantiles_hot_groups", """
SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS q2,
       quantile_cont(l_quantity, 0.75) AS q3
FROM lineitem GROUP BY l_returnflag""")
def line_quantiles_hot_groups(spark, sf_dir):
    """Three groups with a third of all lines each, of few distinct values."""
    lines = bridge.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    edges = group_quantiles(lines, "l_quantity", [0.25, 0.5, 0.75], ["l_returnflag"])
    return edges.select("l_returnflag", *[F.col("edges")[i].alias(f"q{i + 1}") for i in range(3)])


LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("line_rolling_hot_groups", f"""
SELECT l_returnflag, l_orderkey, l_linenumber, row_number() OVER s AS "Match_No",
       avg(l_quantity) OVER (s ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS mean_quantity
FROM lineitem WINDOW s AS (PARTITION BY l_returnflag ORDER BY {', '.join(LINE_ORDER)})""")
def line_rolling_hot_groups(spark, sf_dir):
    """Three series with a third of all lines each."""
    lines = bridge.table(spark, sf_dir, "lineitem").select("l_returnflag", *LINE_ORDER)
    trend = rolling_mean(lines, ["l_returnflag"], [F.col(c).asc() for c in LINE_ORDER],
                         {"mean_quantity": "l_quantity"})
    return trend.select("l_returnflag", "l_orderkey", "l_linenumber", "Match_No", "mean_quantity")


@query("median_benchmarks", f"""
{TOTALS_SQL}
SELECT "Season", median(CAST("xG" AS DOUBLE)) AS "median_xG", median(CAST("G" AS DOUBLE)) AS "median_G"
FROM tot GROUP BY "Season" """)
def median_benchmarks(spark, sf_dir):
    return views.benchmark_lines(totals(spark, sf_dir), "xG", "G", ["Season"])


@query("scatter_points", f"""
{TOTALS_SQL}, d AS (SELECT * FROM tot)
SELECT "Team", "Season", "League", "Plot Label", "xG", "G", "Points", "Quartile" FROM ({band_sql(
    '(SELECT *, "Team_Abbreviation" || chr(32) || substr("Season", 3) AS "Plot Label" FROM d)',
    'Points', '"Season"', '"Team", "Season", "League", "Plot Label", "xG", "G", "Points"', UP)})""")
def scatter_points(spark, sf_dir):
    return views.scatter(display_names(totals(spark, sf_dir)), "xG", "G", "Points", ["Season"])


TREND_SQL = f"WITH {sql.NATION_RESULTS}, {sql.ROLLING}"


@query("trend_compare", f"""
{TREND_SQL}
SELECT 'NATION_0 2019/20 - PPG' AS trace, "Match_No", "PPG" AS value FROM rolling
WHERE "Team" = 'NATION_0' AND "Season" = '2019/20'
UNION ALL SELECT 'NATION_7 2018/19 - xGD_PPG', "Match_No", "xGD_PPG" FROM rolling
WHERE "Team" = 'NATION_7' AND "Season" = '2018/19'""")
def trend_compare(spark, sf_dir):
    return views.trend_chart(rolling_stats(bridge.nation_results(spark, sf_dir)), [
        Trace("NATION_0 2019/20 - PPG", "PPG", {"Team": "NATION_0", "Season": "2019/20"}),
        Trace("NATION_7 2018/19 - xGD_PPG", "xGD_PPG", {"Team": "NATION_7", "Season": "2018/19"})])


@query("trend_compare_aligned", f"""
{TREND_SQL}
SELECT coalesce(a."Match_No", b."Match_No") AS "Match_No", a."G_PG" AS first, b."GA_PG" AS second
FROM (SELECT * FROM rolling WHERE "Team" = 'NATION_0' AND "Season" = '2019/20') a
FULL JOIN (SELECT * FROM rolling WHERE "Team" = 'NATION_7' AND "Season" = '2018/19') b
  ON a."Match_No" = b."Match_No" """)
def trend_compare_aligned(spark, sf_dir):
    return views.trend_chart(rolling_stats(bridge.nation_results(spark, sf_dir)), [
        Trace("first", "G_PG", {"Team": "NATION_0", "Season": "2019/20"}),
        Trace("second", "GA_PG", {"Team": "NATION_7", "Season": "2018/19"})], aligned=True)


@query("trend_compare_all_series", f"""
{TREND_SQL}
SELECT "Team", "Season", 'PPG' AS trace, "Match_No", "PPG" AS value FROM rolling
UNION ALL SELECT "Team", "Season", 'xGD_PPG', "Match_No", "xGD_PPG" FROM rolling""")
def trend_compare_all_series(spark, sf_dir):
    return compare_trends(rolling_stats(bridge.nation_results(spark, sf_dir)),
                          [Trace("PPG", "PPG"), Trace("xGD_PPG", "xGD_PPG")], keep=["Team", "Season"])


@query("trend_of_view_teams", f"""
{TREND_SQL}, {sql.RECENT}, form AS ({sql.totals('recent')})
SELECT "Team", "Season", "Match_No", "GD_PG" FROM rolling
WHERE "Team" IN (SELECT "Team" FROM form WHERE "League" = 'EUROPE')""")
def trend_of_view_teams(spark, sf_dir):
    results = bridge.nation_results(spark, sf_dir)
    shown = views.view(last_n_form(results), league="EUROPE")
    return semi_filter(rolling_stats(results), shown, ["Team"]).select("Team", "Season", "Match_No", "GD_PG")


METRICS = [c for c in views.STATS_ORDER if c != "MP"]


@query("plot_metrics", f"{TOTALS_SQL} " + " UNION ALL ".join(
    f"""SELECT "Team", "Season", '{c}' AS metric, CAST("{c.replace(' ', '_')}" AS DOUBLE) AS value FROM tot""" for c in METRICS))
def plot_metrics(spark, sf_dir):
    """Every column that a chart may show, as all columns but the listed ones, in long form."""
    table = display_names(totals(spark, sf_dir))
    metrics = [F.col(f"`{c}`").cast("double").alias(c) for c in views.plot_choices(table)]
    return table.select("Team", "Season", *metrics).unpivot(["Team", "Season"], views.plot_choices(table), "metric", "value")
