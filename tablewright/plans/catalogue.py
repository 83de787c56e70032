"""All queries: importing the modules registers them."""

from tablewright.plans import aggregates, basics, database, files, joins, mutation  # noqa: F401
from tablewright.plans.registry import CATALOGUE

__all__ = ["CATALOGUE"]
