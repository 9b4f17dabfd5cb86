"""Import every query module so all queries and oracle statements are registered."""

from __future__ import annotations

from quakehouse.plans import catalog, catalog_io, catalog_ops, catalog_quality  # noqa: F401
from quakehouse.plans.catalog import QUERIES
from quakehouse.plans.queries_sql import ORACLE

__all__ = ["QUERIES", "ORACLE"]
