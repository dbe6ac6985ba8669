"""All registered queries."""

from __future__ import annotations

from .registry import QUERIES, Query
from . import (queries_backtest, queries_captures, queries_games, queries_lines,  # noqa: F401
               queries_money, queries_published, queries_store)


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)
