"""Registered queries over the given tables, and their SQL counterparts."""

from viewflow.plans.oracles import ORACLES
from viewflow.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
