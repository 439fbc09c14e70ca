import pytest
from pyspark.errors import PySparkException

from touchline.operators.quality import Rule, enforce, expect, not_null, violations
from touchline.session import scratch_dir
from touchline.sources.landing import scan_landing
from touchline.streaming.ingest import append_stream


@pytest.fixture
def points(spark):
    return spark.createDataFrame([("a", 1), ("b", None), ("c", -1), (None, 5)], "k string, v int")


def test_drop_and_counts(points, rows):
    rules = [Rule("positive", "v > 0", "drop"), Rule("named", "k IS NOT NULL", "warn")]
    kept, seen = expect(points, rules)
    assert rows(kept) == [(None, 5), ("a", 1)]
    # NULL > 0 is not TRUE, so it counts as broken.
    assert seen.get == {"rows": 4, "positive": 2, "named": 1}
    assert rows(violations(points, rules)) == [("named", "warn", 4, 1), ("positive", "drop", 4, 2)]


def test_fail(points):
    with pytest.raises(PySparkException, match="rule v_not_null broken"):
        enforce(points, not_null("v")).count()


def test_dropped_rows_never_fail(points, rows):
    rules = [Rule("sign", "v > 0"), Rule("known", "v IS NOT NULL AND v <> -1", "drop")]
    assert rows(enforce(points, rules)) == [(None, 5), ("a", 1)]


def test_without_rules(points):
    assert enforce(points, []).count() == 4


def test_rules_on_a_stream(spark, rows):
    place = scratch_dir(spark, "test")
    spark.createDataFrame([("a", 1), ("b", None)], "k string, v int").write.parquet(f"{place}/in")
    stream = scan_landing(spark, f"{place}/in", spark.createDataFrame([], "k string, v int").schema, True)
    kept, seen = expect(stream.select("k", "v"), not_null("v", action="drop"), "stream_rules")
    assert seen is None
    append_stream(kept, f"{place}/t", f"{place}/c")
    assert rows(spark.read.parquet(f"{place}/t"), "k", "v") == [("a", 1)]
