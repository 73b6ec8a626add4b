"""All registered queries; importing the modules registers them."""

from claimtrail.plans import (  # noqa: F401
    queries_joins,
    queries_ordered,
    queries_predicates,
    queries_scalar,
    queries_sources,
    queries_study,
)
from claimtrail.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
