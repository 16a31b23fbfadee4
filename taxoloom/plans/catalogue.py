"""All registered queries over the library's own operators, each with the SQL it must agree with."""

from __future__ import annotations

from taxoloom.plans import graphing, linking, scalars  # noqa: F401  registering is what importing them does
from taxoloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
