"""Registered queries (one per operator key of the blueprint) and their SQL oracles."""

from tillflow.plans.catalog import QUERIES
from tillflow.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
