"""Named queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLES``)."""

from releaseflow.plans import enrichment, history, ingest, monitoring, reports, table  # noqa: F401  (registration side effects)
from releaseflow.plans.common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
