"""All registered queries (importing the modules registers them)."""

from fieldgauge.queries import aggregates, basics, jobs, statistics  # noqa: F401
from fieldgauge.queries.registry import SPARK, SQL

__all__ = ["SPARK", "SQL"]
