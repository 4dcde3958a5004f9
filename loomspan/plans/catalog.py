"""All queries over the driver tables and the SQL of those that SQL can express."""

from __future__ import annotations

from . import class_queries, evaluation_queries, gene_queries, hit_queries, interval_queries, model_queries, orthology_queries, sequence_queries, statistics_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
