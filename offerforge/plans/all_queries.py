"""Loads every query module, which fills the register."""

from offerforge.plans import (  # noqa: F401
    queries_features, queries_jobs, queries_models, queries_numeric, queries_offers, queries_relational,
)
from offerforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
