"""Registered queries, each with the SQL another engine runs on the same tables."""

from checks import analysis, shaping  # noqa: F401  (they register)
from checks import loading  # noqa: F401  (uses SQL of the ones above)
from checks import layouts, statistics, storage  # noqa: F401  (use SQL of the ones above)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
