"""Every registered query against its SQL, and properties of the bridge."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from touchline.operators.totals import last_n_form, season_totals
from touchline.plans import bridge
from touchline.plans.gold import rolling_stats
from touchline.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    message, _, ok = compare(spark, con, name, SF_DIR)
    assert ok, message


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.fixture(scope="module")
def results(spark):
    return bridge.nation_results(spark, SF_DIR).cache()


def test_totals_add_up(results):
    totals = season_totals(results).agg(
        F.sum("MP"), F.sum("Points"), F.sum("D"), F.sum("GD"), F.sum("W"), F.sum("L")).first()
    matches, points, draws, difference, wins, losses = totals
    assert matches == results.count() and wins == losses and difference == 0
    # Three points for a decided game, two for a draw; each game has two rows.
    assert points == 3 * wins + 2 * (draws // 2)


def test_last_rolling_row_equals_form(results):
    form = {(r["Team"], r["Season"]): r["PPG"] for r in last_n_form(results).collect()}
    trend = rolling_stats(results)
    last = trend.groupBy("Team", "Season").agg(F.max_by("PPG", "Match_No").alias("PPG")).collect()
    last = {(r["Team"], r["Season"]): r["PPG"] for r in last}
    assert form and all(last[k] == pytest.approx(v) for k, v in form.items())
