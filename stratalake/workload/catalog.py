"""All registered queries."""

from stratalake.workload import (  # noqa: F401  (importing registers)
    capture_queries,
    projection_queries,
    scoring_queries,
    star_queries,
)
from stratalake.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
