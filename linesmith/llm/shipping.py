"""Sends modules along with the tasks that use them, so executors need no copy of the package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Call it in a module whose functions run in tasks: ``ship(__name__)``."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
