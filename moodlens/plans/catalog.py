"""Loads every section of the catalogue."""

from moodlens.plans import catalog_jobs, catalog_models, catalog_stats, catalog_tables  # noqa: F401
from moodlens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
