"""Registered queries: every operator on the benchmark tables, with its SQL where there is one."""

from . import calendar_days, copies, intake, models, quality_checks, shaping, upkeep  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
