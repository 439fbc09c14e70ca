"""Match outcome expressions from goals and expected goals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An expected-goal margin beyond this decides a match.
DECIDED_MARGIN = 0.5
POINTS = {"W": 3, "D": 1, "L": 0}


def match_result(scored: Column, conceded: Column) -> Column:
    """W, D or L; an unknown score counts as L."""
    return F.when(scored > conceded, "W").when(scored == conceded, "D").otherwise("L")


def expected_result(margin: Column, threshold: float = DECIDED_MARGIN) -> Column:
    """W or L beyond the threshold, D on it, inside it and where unknown."""
    return F.when(margin > threshold, "W").when(margin < -threshold, "L").otherwise("D")


def result_points(result: Column) -> Column:
    return (F.when(result == "W", F.lit(POINTS["W"]))
             .when(result == "D", F.lit(POINTS["D"]))
             .otherwise(F.lit(POINTS["L"])))
