import pytest
from pyspark.sql import functions as F

from touchline.operators import columns


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Opp Formation", "Goals/90", "xG (np)-adj"])
    assert columns.sanitize_columns(df).columns == ["opp_formation", "goals_90", "xg_np_adj"]
    with pytest.raises(ValueError, match="a_b"):
        columns.sanitize_columns(spark.createDataFrame([(1, 2)], ["A B", "a-b"]))


def test_flatten(spark):
    df = spark.range(1).select(
        F.lit("x").alias("team"),
        F.struct(F.lit(1).alias("Gls"), F.lit(2).alias("")).alias("Standard"),
        F.struct(F.lit(3).alias("season_")).alias("_"))
    plain = columns.flatten_struct(df)
    assert plain.columns == ["team", "Standard_Gls", "Standard", "__season_"]
    assert tuple(plain.first()) == ("x", 1, 2, 3)
    assert columns.flatten_struct(df, strip=True).columns == ["team", "Standard_Gls", "Standard", "season"]


def test_projection_helpers(spark):
    df = columns.display_names(spark.createDataFrame([(1, 2, 3)], ["xGD_W", "Team-Season", "MP"]))
    assert df.columns == ["xGD W", "Team-Season", "MP"]
    assert columns.project_existing(df, ["Position", "MP", "xGD W"]).columns == ["MP", "xGD W"]
    assert columns.metric_columns(df, ["MP", "Team-Season"]) == ["xGD W"]


def test_mixed_text(spark, rows):
    data = [("1", "a", "inf", 7), ("x", "b", "2", 7), (" 2.9 ", "c", None, 7), ("1e3", "d", "y", 7),
            (None, None, "z", 7)]
    df = spark.createDataFrame(data, "mixed string, words string, odd string, n int")
    assert rows(columns.numeric_profile(df)) == [
        ("mixed", True, 3, 0), ("odd", True, 1, 1), ("words", False, 0, 0)]
    got = columns.coerce_mixed(df)
    assert [tuple(r) for r in got.collect()] == [
        (1, "a", 0, 7), (0, "b", 2, 7), (2, "c", 0, 7), (1000, "d", 0, 7), (0, None, 0, 7)]
    assert dict(got.dtypes) == {"mixed": "bigint", "words": "string", "odd": "bigint", "n": "int"}
    assert dict(columns.coerce_mixed(df, exclude=["odd"]).dtypes)["odd"] == "string"
    assert dict(columns.coerce_mixed(df, profile=["words"]).dtypes)["mixed"] == "string"


def test_recover_from_json(spark, rows):
    note = '{"season":2526,"GF":1,"GA":"2 (4)","_file_path":"f"}'
    df = spark.createDataFrame([(None, None, None, note), ("2425", 3, 0, note), (None, None, None, None)],
                               "season string, gf int, ga int, note string")
    got = columns.recover_from_json(df, {"season": "season", "gf": "GF", "ga": "GA"}, "note")
    assert rows(got, "season", "gf", "ga") == [
        (None, None, None), ("2425", "3", "0"), ("2526", "1", "2 (4)")]
