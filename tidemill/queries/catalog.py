"""Imports every query module, so that they register themselves."""

from . import analysis, basics, flows, forecasts
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analysis", "basics", "flows", "forecasts"]
