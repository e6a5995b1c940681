"""Registered queries over the given tables, each with its SQL twin where SQL can express it."""

from . import cleaning, deliveries, gold_star, jobs, onboarding, quality_checks, sources, warehouse  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
