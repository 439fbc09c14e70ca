"""The spread forms must equal the plain ones, whatever the group sizes."""

import random

import pytest
from pyspark.sql import functions as F

from touchline.operators.ranking import group_quantiles, medians, position, quartile_bands, running_counts, value_counts
from touchline.operators.skew import attach, join_by_key, number_rows, split_hot, table_bytes
from touchline.operators.trend import rolling_mean
from touchline.session import scratch_dir


@pytest.fixture(scope="module")
def series(spark):
    """One group with most rows, some small groups and a NULL group."""
    rng = random.Random(7)
    data = [("hot", i, rng.choice([None, *range(20)])) for i in range(400)]
    data += [(g, i, rng.choice([None, *range(20)])) for g in ("a", "b", None) for i in range(23)]
    data += [("one", 0, 5)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, i int, v int").repartition(5).cache(), data


def by_group(data):
    groups = {}
    for g, i, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(g, []).append((i, v))
    return groups


def test_split(series):
    df, _ = series
    normal, hot, sizes = split_hot(df, ["g"], 50)
    assert (normal.count(), hot.count(), sizes.count()) == (70, 400, 1)
    assert split_hot(df, ["g"], 1000)[1] is None
    assert split_hot(df, [], 50)[0] is None


@pytest.mark.parametrize("limit", [10, 50, 10_000])
def test_numbers(series, rows, limit):
    df, data = series
    got = rows(number_rows(df, ["g"], [F.col("i").asc()], "n", limit), "g", "i", "n")
    want = [(g, i, n) for g, items in by_group(data).items() for n, (i, _) in enumerate(items, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [37, 10_000])
def test_numbers_of_whole_table(series, limit):
    df, data = series
    got = [r[0] for r in number_rows(df, [], [F.col("v").asc_nulls_last(), F.col("g"), F.col("i")], "n", limit)
           .select("n").collect()]
    assert sorted(got) == list(range(1, len(data) + 1))


@pytest.mark.parametrize("limit", [8, 9, 100, 10_000])
def test_rolling(series, limit):
    df, data = series
    got = rolling_mean(df, ["g"], [F.col("i").asc()], {"m": "v"}, 8, "n", limit)
    got = {(r["g"], r["i"]): (r["n"], r["m"]) for r in got.collect()}
    assert len(got) == len(data)
    for g, items in by_group(data).items():
        for place, (i, _) in enumerate(items):
            frame = [v for _, v in items[max(0, place - 7):place + 1] if v is not None]
            number, mean = got[(g, i)]
            assert number == place + 1
            assert mean == (pytest.approx(sum(frame) / len(frame)) if frame else None)


@pytest.mark.parametrize("limit", [8, 10_000])
def test_rolling_over_a_stored_table_makes_no_copy(spark, series, rows, limit, monkeypatch):
    df, _ = series
    path = scratch_dir(spark, "test")
    df.write.parquet(path)
    call = lambda rows, **options: rolling_mean(rows, ["g"], [F.col("i").asc()], {"m": "v"}, 8, "n", limit, **options)
    want = rows(call(df))
    monkeypatch.setattr("touchline.operators.trend.freeze", lambda df: pytest.fail("a copy of the rows"))
    assert rows(call(spark.read.parquet(path), on_disk=True)) == want


def test_rolling_needs_a_whole_frame(series):
    with pytest.raises(ValueError):
        rolling_mean(series[0], ["g"], [F.col("i")], {"m": "v"}, 8, "n", 7)


@pytest.mark.parametrize("limit", [20, 10_000])
def test_quantiles_and_medians(series, limit):
    df, data = series
    pd = pytest.importorskip("pandas")
    frame = pd.DataFrame(data, columns=["g", "i", "v"]).astype({"v": "float"})
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    want = {g: part["v"].quantile(probs).tolist() for g, part in frame.groupby("g", dropna=False)}
    want = {None if isinstance(g, float) else g: q for g, q in want.items()}
    got = {r["g"]: r["edges"] for r in group_quantiles(df, "v", probs, ["g"], max_group_rows=limit).collect()}
    assert {g: pytest.approx(q) for g, q in want.items()} == got
    got = {r["g"]: r["median_v"] for r in medians(df, ["v"], ["g"], limit).collect()}
    assert {g: pytest.approx(q[2]) for g, q in want.items()} == got
    whole = medians(df, ["v", "i"], (), limit).first()
    assert whole["median_v"] == pytest.approx(frame["v"].median())
    assert whole["median_i"] == pytest.approx(frame["i"].median())


@pytest.mark.parametrize("limit", [20, 10_000])
def test_bands_of_hot_groups(series, rows, limit):
    df, _ = series
    plain = rows(quartile_bands(df, "v", ["g"], max_group_rows=10_000), "g", "i", "v", "Quartile")
    assert rows(quartile_bands(df, "v", ["g"], max_group_rows=limit), "g", "i", "v", "Quartile") == plain


@pytest.mark.parametrize("max_bytes, limit", [(0, 50), (0, 10_000), (10**9, 50)])
def test_attach(series, rows, max_bytes, limit):
    df, data = series
    small = df.groupBy("g").agg(F.count("*").alias("c"))
    got = rows(attach(df, small, ["g"], max_bytes, limit), "g", "i", "c")
    sizes = {g: len(items) for g, items in by_group(data).items()}
    assert len(got) == len(data) and all(c == sizes[g] for g, _, c in got)


def test_attach_without_key(series):
    df, data = series
    got = attach(df, df.agg(F.max("i").alias("top")), [])
    assert got.columns == ["g", "i", "v", "top"]
    assert got.filter("top = 399").count() == len(data)


@pytest.mark.parametrize("ascending", [True, False])
def test_missing_values_come_last_both_ways(spark, ascending):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "Team string, x double")
    got = {r["Team"]: r["Position"] for r in position(df, "x", ascending).collect()}
    assert got == ({"a": 1, "c": 2, "b": 3} if ascending else {"c": 1, "a": 2, "b": 3})


def test_ties_do_not_depend_on_the_limit(spark, rows):
    """Rows with equal sort values, and rows that are equal throughout."""
    df = spark.createDataFrame([("g", 1, i // 3) for i in range(200)], "g string, v int, i int").repartition(7)
    plain, spread = (number_rows(df, ["g"], [F.col("v").asc()], "n", limit) for limit in (1000, 10))
    assert rows(plain) == rows(spread)
    plain, spread = (rolling_mean(df, ["g"], [F.col("v").asc()], {"m": "i"}, 4, "n", limit) for limit in (1000, 10))
    assert rows(plain) == rows(spread)


def test_a_frequent_value_fills_no_slice(spark):
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).alias("v"))
    ranked = running_counts(value_counts(df, ["v"], ["g"]), ["g", "_metric"], 100)
    sizes = [r["count"] for r in ranked.groupBy("_slice").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) + 1
    quantiles = [group_quantiles(df, "v", [0.1, 0.5, 0.93, 0.9999], ["g"], max_group_rows=n).first()["edges"] for n in (100, 10**6)]
    assert quantiles[0] == pytest.approx(quantiles[1])


def test_a_table_of_long_texts_is_measured_and_shuffled(spark):
    """200 rows of 1 MB: few rows, but too much to broadcast."""
    side = spark.range(200).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1 << 20).alias("t"))
    assert table_bytes(side) > 200 << 20
    joined = attach(spark.range(400).select((F.col("id") % 200).alias("k")), side, ["k"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and joined.filter("t is not null").count() == 400


def test_many_hot_keys_are_dealt_out(spark, rows):
    df = spark.range(600).select((F.col("id") % 6).alias("k"), "id")
    side = spark.createDataFrame([(k, f"name {k}") for k in range(5)], "k long, t string")
    spread = join_by_key(df, side, ["k"], 20, max_bytes=0)
    assert rows(spread) == rows(join_by_key(df, side, ["k"], 1000)) == rows(df.join(side, "k", "left").select("k", "id", "t"))
    assert "_part" in spread._jdf.queryExecution().optimizedPlan().toString()
