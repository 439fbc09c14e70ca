import pytest

from touchline.operators.ranking import is_lower_better, quartile_bands

LOW, Q2, Q3, HIGH = "Q1 (Low)", "Q2", "Q3", "Q4 (High)"


def bands(spark, values, **options):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    return [r["Quartile"] for r in quartile_bands(df, "x", **options).orderBy("i").collect()]


@pytest.mark.parametrize("values, want", [
    ([1.0, 2.0, 3.0, 4.0, 5.0], [LOW, LOW, Q2, Q3, HIGH]),
    ([1.0, 2.0, 3.0, 4.0, None], [LOW, Q2, Q3, HIGH, None]),
    ([1.0, 2.0, 3.0, 4.0, float("nan")], [LOW, Q2, Q3, HIGH, None]),
    ([1.0, 1.0, 1.0, 1.0, 5.0], [LOW] * 5),
    ([3.0], [LOW]),
    ([None, None], [LOW] * 2),
])
def test_bands(spark, values, want):
    assert bands(spark, values) == want


def test_lower_is_better(spark):
    assert bands(spark, [1.0, 2.0, 3.0, 4.0], lower_is_better=True) == [HIGH, Q3, Q2, LOW]
    # Where edges coincide the whole view is low, also when low is good.
    assert bands(spark, [1.0, 1.0, 1.0, 9.0], lower_is_better=True) == [LOW] * 4


def test_empty_view(spark):
    df = spark.createDataFrame([], "i int, x double")
    assert quartile_bands(df, "x").count() == 0


def test_which_metrics_are_reversed():
    assert is_lower_better("xGD_L") and is_lower_better("GA PG") and not is_lower_better("Points")
