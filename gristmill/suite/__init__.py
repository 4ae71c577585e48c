"""TESTDATA queries: one per implemented operator, each with its oracle SQL
where the operator is SQL-expressible."""

from . import q_basic, q_dates, q_flagship, q_learn, q_plans, q_stats, q_text  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
