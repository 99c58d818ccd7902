"""Registered queries (Spark) and their SQL oracles (DuckDB dialect)."""

from tideline.plans.oracle import ORACLE_SQL
from tideline.plans.queries import QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
