"""All queries and their SQL counterparts."""

from __future__ import annotations

from checks import flights, parsing, serving, streams  # noqa: F401  (registers the queries)
from checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
