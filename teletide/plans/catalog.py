"""All registered queries."""

from teletide.plans import grids, logs, metrics, streams, tables, traces  # noqa: F401  (they register)
from teletide.plans.logs import flagship
from teletide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
