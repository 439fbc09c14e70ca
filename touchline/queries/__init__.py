"""Registered queries over the test tables, each with the SQL it must equal."""

from touchline.queries import cleaning, conforming, gold, landing, quality, views  # noqa: F401
from touchline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
