"""Importing this module registers every query of the subpackage."""

from . import (  # noqa: F401
    chat, circulant, decontaminate, fill_in_middle, jaccard, language, language_model, licenses, mixing, neighbours, prefixes, toxicity, warc,
)
from .common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
