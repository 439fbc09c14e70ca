"""Row rules: drop, fail or only count the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row passes only where `condition` is TRUE; NULL counts as broken."""

    name: str
    condition: str
    action: Literal["drop", "fail", "warn"] = "fail"

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def _all(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.passed() for r in rules], F.lit(True))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Drop the rows that break a drop rule, then fail on the first other break.

    One CASE keeps the order fixed: a dropped row can never raise.
    """
    drops = [r for r in rules if r.action == "drop"]
    fails = [r for r in rules if r.action == "fail"]
    keep = F.when(~_all(drops), F.lit(False))
    for rule in fails:
        keep = keep.when(~rule.passed(), F.raise_error(f"rule {rule.name} broken: {rule.condition}")
                         .cast("boolean"))
    return df.filter(keep.otherwise(F.lit(True))) if drops or fails else df


def expect(df: DataFrame, rules: Sequence[Rule],
           name: str = "expectations") -> tuple[DataFrame, Observation | None]:
    """`enforce` plus counts of broken rows per rule, gathered while the job runs.

    A batch gets an `Observation`; a stream reports under `name` in its progress.
    """
    counts = [F.count(F.lit(1)).alias("rows"),
              *[F.count_if(~r.passed()).alias(r.name) for r in rules]]
    if df.isStreaming:
        return enforce(df.observe(name, *counts), rules), None
    seen = Observation(name)
    return enforce(df.observe(seen, *counts), rules), seen


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the rows checked and broken, in one pass."""
    report = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                 F.count(F.lit(1)).alias("checked"), F.count_if(~r.passed()).alias("broken"))
        for r in rules])
    return df.agg(report.alias("_r")).select(F.inline("_r"))


def not_null(*columns: str, action: str = "fail", prefix: str = "") -> list[Rule]:
    return [Rule(f"{prefix}{c}_not_null", f"`{c}` IS NOT NULL", action) for c in columns]
