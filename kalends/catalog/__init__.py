"""All named queries; importing the modules registers them."""

from kalends.catalog import analysis, calendars, comparisons, models, tables  # noqa: F401
from kalends.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
