"""All registered queries; importing the modules registers them."""

from stayledger.plans import (  # noqa: F401
    cohort_queries,
    model_queries,
    score_queries,
)
from stayledger.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
