"""All registered queries and their oracles."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

SECTIONS = ["tables", "market", "series", "technical", "models", "streams"]


def _sections():
    return [import_module(f"tidewick.plans.queries_{s}") for s in SECTIONS]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q for m in _sections() for k, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for m in _sections() for k, s in m.ORACLES.items()}
