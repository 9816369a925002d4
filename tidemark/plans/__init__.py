"""Queries that apply the operators to whole tables, with the SQL that checks them."""

from tidemark.plans import queries_derived, queries_metrics, queries_panel, queries_pit, queries_quality
from tidemark.plans.registry import ORACLE_SQL, QUERIES

__all__ = [
    "ORACLE_SQL", "QUERIES", "queries_derived", "queries_metrics", "queries_panel", "queries_pit", "queries_quality"
]
