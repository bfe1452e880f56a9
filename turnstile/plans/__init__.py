"""Query bindings.  Importing this package registers every query."""

from turnstile.plans import basics, campaign, io, journey, models, staffing, survey, text  # noqa: F401
from turnstile.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
