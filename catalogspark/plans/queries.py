"""All registered queries of the catalog engine."""

from catalogspark.plans import catalog, evidence, pages, payloads, reconciliation, release, scalars, works  # noqa: F401
from catalogspark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
