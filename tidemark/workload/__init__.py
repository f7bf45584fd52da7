"""The registered queries: each runs operators over the given tables and, where SQL can
say the same, carries the SQL text it is checked against."""

from tidemark.workload import analytics, cdc, cleaning, files, governance, scd, search, star, streams  # noqa: F401  (registers queries)
from tidemark.workload.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
