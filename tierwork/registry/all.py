"""Importing this module registers every query."""

from . import changes, checks, history, profiling, relational, star  # noqa: F401
from .base import QUERIES, SQL, Tables

__all__ = ["QUERIES", "SQL", "Tables"]
