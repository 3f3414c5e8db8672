"""Named queries over the driver's tables, with equivalent DuckDB SQL."""

from timeloom.plans import composed, grouping, judging, kernels, notation, queries, reports, timing
from timeloom.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "composed", "grouping", "judging", "kernels", "notation", "queries", "reports", "timing"]
