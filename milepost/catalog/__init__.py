"""Registered queries: each callable with the SQL that must give the same rows."""

from milepost.catalog.registry import ORACLES, QUERIES
from milepost.catalog import geo, payouts, warehouse, experiment, describe, prepare, models, stream  # noqa: F401,E402

__all__ = ["ORACLES", "QUERIES"]
