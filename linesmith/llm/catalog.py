"""Importing this module registers every query of the subpackage."""

from . import queries_docs, queries_pages, queries_patterns  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
