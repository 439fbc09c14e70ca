"""Assembled pipelines: bronze, silver, gold, and the test-data bridge."""
