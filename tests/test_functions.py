import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.functions import casts, outcomes, text


def values(spark, data, column, kind="string"):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_number_text(spark):
    data = ["1", " 2.9 ", "1e3", "-4", ".5", "x", "", None, "1d", "1f", "inf", "nan", "1e400", "2 (4)", "3.0"]
    want = [1.0, 2.9, 1000.0, -4.0, 0.5] + [None] * 9 + [3.0]
    assert values(spark, data, casts.to_number("v")) == want
    assert values(spark, data, casts.whole_or_zero("v")) == [1, 2, 1000, -4, 0] + [0] * 9 + [3]
    assert values(spark, ["3.0", "2 (4)", "99999999999"], casts.to_int("v")) == [3, None, None]
    assert values(spark, [61.0, None], casts.to_int("v"), "double") == [61, None]


def test_infinite_text(spark):
    assert values(spark, ["inf", "-Infinity", "info", None], casts.is_infinite_text("v")) == \
        [True, True, False, None]


def test_days_and_iso_text(spark):
    assert values(spark, ["2025-08-16T15:00:00", "2025-08-16", "soon", None], casts.to_day("v")) == \
        [dt.date(2025, 8, 16), dt.date(2025, 8, 16), None, None]
    assert values(spark, [dt.datetime(2025, 8, 16, 15, 4, 5)], casts.iso_text("v"), "timestamp_ntz") == \
        ["2025-08-16T15:04:05"]


def test_result_id_of_urls(spark):
    urls = ["/en/matches/ab12/x-Premier-League", "/en/stathead/y", None]
    assert values(spark, urls, text.extract_id("v")) == ["ab12", "", None]
    assert values(spark, urls, text.extract_id("v", strict=True)) == ["ab12", None, None]
    assert values(spark, urls, text.joined_id(text.extract_id("v"), F.lit("A"))) == ["ab12-A", "-A", None]


@pytest.mark.parametrize("url, league", [
    ("/x-Bundesliga", "GER-Bundesliga"), ("/x-Premier-League", "ENG-Premier League"),
    ("/x-Ligue-1", "FRA-Ligue 1"), ("/x-Serie-A", "ITA-Serie A"), ("/x-La-Liga", "ESP-La Liga"),
    ("/Bundesliga-La-Liga", "GER-Bundesliga"), ("/x-Cup", None), (None, None)])
def test_league_from_url(spark, url, league):
    assert values(spark, [url], text.infer_label(F.lit(None).cast("string"), "v")) == [league]
    assert values(spark, [url], text.infer_label(F.lit("KNOWN"), "v")) == ["KNOWN"]


def test_team_codes(spark):
    names = ["Manchester Utd", "Manchester City", "Nott'ham Forest", "Arsenal", None]
    assert values(spark, names, text.tiered_code(F.lit(None).cast("string"), "v")) == \
        ["MUN", "MCI", "NFO", "ARS", None]
    assert values(spark, names[:1], text.tiered_code(F.lit("MU"), "v")) == ["MU"]


def test_labels(spark):
    assert values(spark, ["2526"], text.season_label("v")) == ["2025/26"]
    assert values(spark, [2526], text.season_label("v"), "int") == ["2025/26"]
    assert values(spark, ["ENG-Premier League", "A-B-C", "Plain"], text.league_label("v")) == \
        ["Premier League", "C", "Plain"]
    assert values(spark, ["2025/26", "2023/2024", "7", None], text.short_season("v")) == \
        ["25/26", "23/24", "7", None]
    assert values(spark, ["2025/26", None], text.plot_label(F.lit("ARS"), "v")) == ["ARS 25/26", None]


def test_outcomes(spark):
    df = spark.createDataFrame(
        [(0, 2, 1, 1.5, 1.0), (1, 1, 1, 1.51, 1.0), (2, 0, 1, 1.0, 1.51), (3, None, None, None, None)],
        "i int, g int, ga int, xg double, xga double")
    result = outcomes.match_result(F.col("g"), F.col("ga"))
    expected = outcomes.expected_result(F.col("xg") - F.col("xga"))
    got = df.orderBy("i").select(result, outcomes.result_points(result), expected,
                                 outcomes.result_points(expected)).collect()
    # On the threshold it is a draw; an unknown score is a loss, unknown xG a draw.
    assert [tuple(r) for r in got] == [("W", 3, "D", 1), ("D", 1, "W", 3), ("L", 0, "L", 0), ("L", 0, "D", 1)]
