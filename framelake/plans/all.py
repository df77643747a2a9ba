"""Every motion-data query."""

from __future__ import annotations

from framelake.plans import array_queries, frame_queries, io_queries, report_queries, scalar_queries  # noqa: F401
from framelake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
