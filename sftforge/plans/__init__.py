"""Registered queries (one per operator) and their DuckDB oracle SQL."""

from sftforge.plans import (  # noqa: F401  (register queries)
    bracket_queries, chat_queries, loss_queries, synth_queries, token_queries,
)
from sftforge.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
