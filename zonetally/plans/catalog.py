"""All registered queries; importing the modules fills the registry."""

from zonetally.plans import kpi_queries, queue_queries, report_queries, request_queries, stream_queries, zone_queries  # noqa: F401
from zonetally.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
