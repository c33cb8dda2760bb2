"""Registered queries of the library."""

from . import context, decisions, learning, storage, surveillance  # noqa: F401  they fill the registry
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
