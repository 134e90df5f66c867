"""The registered queries: every operator over whole tables, with its SQL oracle."""

from lexloom.queries import corpus, graph, layers, publishing, relational, reports, starred, windows  # noqa: F401
from lexloom.queries.registry import oracles, queries

__all__ = ["oracles", "queries"]
