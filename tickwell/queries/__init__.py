"""All registered queries."""

from tickwell.queries import checked, derived, reruns, staged  # noqa: F401  (registration)
from tickwell.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
