"""Registered queries over the driver's tables, each with the SQL it is compared with."""

from __future__ import annotations

from . import analysis, features, panels, registry

QUERIES = registry.QUERIES
ORACLE_SQL = registry.ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "analysis", "features", "panels"]
