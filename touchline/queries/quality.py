"""Row rules and the freshness count."""

import datetime as dt

from pyspark.sql import functions as F

from touchline.operators.quality import Rule, enforce, not_null, violations
from touchline.operators.recency import recent_rows
from touchline.plans import bridge
from touchline.plans.gold import FORM_RULES, HEADLINE_RULES
from touchline.operators.totals import last_n_form, season_totals
from touchline.queries import sql
from touchline.queries.registry import query

DROP_RULES = [
    Rule("priority_known", "o_orderpriority NOT LIKE '4%'", "drop"),
    Rule("report_present", "match_report IS NOT NULL", "drop"),
    Rule("price_positive", "o_totalprice > 1000", "drop"),
]


def reported_orders(spark, sf_dir):
    return bridge.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate",
        bridge.report_url(F.col("o_orderkey"), gaps=True).alias("match_report"))


@query("expect_drop", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority NOT LIKE '4%' AND o_orderkey % 11 <> 7 AND o_totalprice > 1000""")
def expect_drop(spark, sf_dir):
    return enforce(reported_orders(spark, sf_dir), DROP_RULES).select("o_orderkey", "o_totalprice")


@query("expect_fail_passes", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def expect_fail_passes(spark, sf_dir):
    orders = bridge.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return enforce(orders, not_null(*orders.columns))


@query("expect_report", """
SELECT 'priority_known' AS rule, 'drop' AS action, count(*) AS checked,
       count(*) FILTER (WHERE o_orderpriority LIKE '4%') AS broken FROM orders
UNION ALL SELECT 'report_present', 'drop', count(*), count(*) FILTER (WHERE o_orderkey % 11 = 7) FROM orders
UNION ALL SELECT 'price_positive', 'drop', count(*),
       count(*) FILTER (WHERE NOT coalesce(o_totalprice > 1000, false)) FROM orders""")
def expect_report(spark, sf_dir):
    return violations(reported_orders(spark, sf_dir), DROP_RULES)


def consistency_sql(label, source, limit):
    extra = f'"MP" <= {limit} AND ' if limit else ""
    return f"""
SELECT '{label}' AS "table", count(*) AS checked, count(*) FILTER (WHERE NOT ({extra}
  "MP" = "W" + "D" + "L" AND "MP" = "xGD_W" + "xGD_D" + "xGD_L"
  AND "Points" IS NOT NULL AND "League" NOT LIKE '%-%')) AS broken
FROM ({sql.totals(source)})"""


@query("expect_consistency", f"""
WITH {sql.NATION_RESULTS}, {sql.RECENT}
{consistency_sql('headline', 'res', None)} UNION ALL {consistency_sql('form', 'recent', 8)}""")
def expect_consistency(spark, sf_dir):
    results = bridge.nation_results(spark, sf_dir)
    def report(label, table, rules):
        every = " AND ".join(f"({r.condition})" for r in rules)
        return violations(table, [Rule(label, every)]).select(
            F.col("rule").alias("table"), "checked", "broken")
    return (report("headline", season_totals(results), HEADLINE_RULES)
            .unionByName(report("form", last_n_form(results), FORM_RULES)))


@query("recent_window_count", """
SELECT count(*) AS row_count FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '2001-06-01' - 7 AND o_orderkey % 11 <> 7""")
def recent_window_count(spark, sf_dir):
    orders = reported_orders(spark, sf_dir)
    return recent_rows(orders, "o_orderdate", dt.date(2001, 6, 1)).agg(F.count(F.lit(1)).alias("row_count"))
