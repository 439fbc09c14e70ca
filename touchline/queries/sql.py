"""SQL building blocks of the oracles: the bridge models and the gold tables."""

SEASON = ("lpad(CAST((year(o_orderdate) + 20) % 100 AS VARCHAR), 2, '0') || "
          "lpad(CAST((year(o_orderdate) + 21) % 100 AS VARCHAR), 2, '0')")

NATION_SIDES = f"""
goal AS (
  SELECT l_orderkey,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS hg,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS ag,
         CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'A') / 32.0 AS REAL) AS hx,
         CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') / 32.0 AS REAL) AS ax
  FROM lineitem GROUP BY l_orderkey),
game AS (
  SELECT o_orderkey AS game_id, substr(r_name, 1, 3) || '-' || r_name AS league,
         {SEASON} AS season, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderstatus <> 'P' THEN '/en/matches/' || o_orderkey || '/x' END AS match_report,
         c_nationkey AS h, CAST((c_nationkey + 5 * (1 + o_orderkey % 4)) % 25 AS INTEGER) AS a,
         CASE WHEN o_orderstatus <> 'P' THEN coalesce(hg, 0) END AS hg,
         CASE WHEN o_orderstatus <> 'P' THEN coalesce(ag, 0) END AS ag,
         CASE WHEN o_orderstatus <> 'P' THEN hx END AS hx, CASE WHEN o_orderstatus <> 'P' THEN ax END AS ax,
         CAST(30 + o_orderkey % 41 AS INTEGER) AS hp
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN goal ON l_orderkey = o_orderkey),
side AS (
  SELECT game_id, league, season, date, match_report,
         'NATION_' || h AS team, 'NATION_' || a AS opponent,
         CASE WHEN game_id % 3 <> 0 THEN 'N' || h END AS provider_code,
         hg AS goals, ag AS goals_allowed, hx AS expected_goals, ax AS expected_goals_allowed,
         hp AS possession, 'Home' AS venue FROM game
  UNION ALL
  SELECT game_id, league, season, date, match_report, 'NATION_' || a, 'NATION_' || h,
         CASE WHEN game_id % 3 <> 0 THEN 'N' || a END, ag, hg, ax, hx, 100 - hp, 'Away' FROM game)
"""

NATION_RESULTS = NATION_SIDES + """,
keyed AS (
  SELECT *, regexp_extract(match_report, '/en/matches/([^/]+)/', 1) AS result_id,
         team || '-' || season AS team_id,
         coalesce(provider_code,
                  CASE team WHEN 'NATION_1' THEN 'ONE' WHEN 'NATION_2' THEN 'TWO'
                            WHEN 'NATION_7' THEN 'SEV' WHEN 'NATION_11' THEN 'ELV' END,
                  upper(substr(team, 1, 3))) AS team_code,
         goals - goals_allowed AS goal_difference,
         expected_goals - expected_goals_allowed AS expected_goal_difference
  FROM side WHERE match_report IS NOT NULL),
scored AS (
  SELECT *, result_id || '-' || team || '-' || season AS result_team_id,
         CASE WHEN goals = goals_allowed THEN 'D' WHEN goals > goals_allowed THEN 'W' ELSE 'L' END AS result,
         CASE WHEN expected_goal_difference > 0.5 THEN 'W'
              WHEN expected_goal_difference < -0.5 THEN 'L' ELSE 'D' END AS expected_result
  FROM keyed),
res AS (
  SELECT *, CASE result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS points,
         CASE expected_result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS expected_result_points
  FROM scored)
"""


def totals(source: str) -> str:
    """The totals table over `source`, as a SELECT."""
    return f"""
  SELECT "Team-Season", "Team", "Season", "League", "Team_Abbreviation", "Points", "W", "D", "L", "MP",
         "xGD_W", "xGD_D", "xGD_L", "xGD_Points", "G", "GA", "GD", "xG", "xGA", "xGD", "Possession",
         "Points" / CAST("MP" AS DOUBLE) AS "PPG", "xGD_Points" / CAST("MP" AS DOUBLE) AS "xGD_PPG",
         "G" / CAST("MP" AS DOUBLE) AS "G_PG", "GA" / CAST("MP" AS DOUBLE) AS "GA_PG",
         "GD" / CAST("MP" AS DOUBLE) AS "GD_PG",
         CAST("xG" AS DOUBLE) / "MP" AS "xG_PG", CAST("xGA" AS DOUBLE) / "MP" AS "xGA_PG",
         CAST("xGD" AS DOUBLE) / "MP" AS "xGD_PG"
  FROM (
    SELECT team_id AS "Team-Season", team AS "Team",
           '20' || substr(season, 1, 2) || '/' || substr(season, 3, 2) AS "Season",
           regexp_replace(league, '^.*-', '') AS "League",
           arg_max(team_code, (date, team_code)) FILTER (WHERE team_code IS NOT NULL) AS "Team_Abbreviation",
           CAST(sum(points) AS INTEGER) AS "Points",
           CAST(count(*) FILTER (WHERE result = 'W') AS INTEGER) AS "W",
           CAST(count(*) FILTER (WHERE result = 'D') AS INTEGER) AS "D",
           CAST(count(*) FILTER (WHERE result = 'L') AS INTEGER) AS "L",
           CAST(count(result_id) AS INTEGER) AS "MP",
           CAST(count(*) FILTER (WHERE expected_result = 'W') AS INTEGER) AS "xGD_W",
           CAST(count(*) FILTER (WHERE expected_result = 'D') AS INTEGER) AS "xGD_D",
           CAST(count(*) FILTER (WHERE expected_result = 'L') AS INTEGER) AS "xGD_L",
           CAST(sum(expected_result_points) AS INTEGER) AS "xGD_Points",
           CAST(sum(goals) AS INTEGER) AS "G", CAST(sum(goals_allowed) AS INTEGER) AS "GA",
           CAST(sum(goal_difference) AS INTEGER) AS "GD",
           CAST(sum(expected_goals) AS REAL) AS "xG", CAST(sum(expected_goals_allowed) AS REAL) AS "xGA",
           CAST(sum(expected_goal_difference) AS REAL) AS "xGD",
           round(avg(possession), 1) AS "Possession"
    FROM {source} GROUP BY team_id, team, season, league)
"""


RECENT = """
recent AS (
  SELECT * FROM res WHERE season = (SELECT max(season) FROM res)
  QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY date DESC, result_team_id DESC) <= 8)
"""

ROLLING = """
rolling AS (
  SELECT team AS "Team", '20' || substr(season, 1, 2) || '/' || substr(season, 3, 2) AS "Season",
         regexp_replace(league, '^.*-', '') AS "League", date AS "Date",
         row_number() OVER s AS "Match_No",
         avg(points) OVER w AS "PPG", avg(expected_result_points) OVER w AS "xGD_PPG",
         avg(goals) OVER w AS "G_PG", avg(goals_allowed) OVER w AS "GA_PG",
         avg(goal_difference) OVER w AS "GD_PG", avg(expected_goals) OVER w AS "xG_PG",
         avg(expected_goals_allowed) OVER w AS "xGA_PG", avg(expected_goal_difference) OVER w AS "xGD_PG"
  FROM res
  WINDOW s AS (PARTITION BY team_id ORDER BY date, result_team_id),
         w AS (PARTITION BY team_id ORDER BY date, result_team_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
"""

CUSTOMER_GAMES = f"""
cgame AS (
  SELECT o_orderkey AS game_id, {SEASON} AS season, CAST(o_orderdate AS DATE) AS date,
         o_custkey AS home_team_id,
         (o_custkey + 1 + o_orderkey % 4) % (SELECT count(*) FROM customer) AS away_team_id,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_orderkey % 160) / 8.0 AS REAL) END AS home_ppda,
         CAST((o_orderkey % 96) / 8.0 AS REAL) AS away_ppda,
         CAST(o_orderkey % 13 AS INTEGER) AS home_deep_completions,
         CAST(o_orderkey % 17 AS INTEGER) AS away_deep_completions
  FROM orders),
csides AS (
  SELECT season, date, game_id, game_id || '-' || home_team_id AS game_team_id,
         home_team_id AS team, away_team_id AS opponent, home_ppda AS ppda_raw,
         home_deep_completions AS deep_completions, 'Home' AS venue FROM cgame
  UNION ALL
  SELECT season, date, game_id, game_id || '-' || away_team_id, away_team_id, home_team_id,
         away_ppda, away_deep_completions, 'Away' FROM cgame)
"""
