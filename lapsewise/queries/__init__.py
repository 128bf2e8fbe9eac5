"""Named queries over the driver tables, each with the SQL that gives the same rows."""

from lapsewise.queries import base, drawing, edge_cases, jobs, joining, kpis, portfolio, rule_sets, tables

QUERIES, ORACLES = base.QUERIES, base.ORACLES
__all__ = ["QUERIES", "ORACLES", "drawing", "edge_cases", "jobs", "joining", "kpis", "portfolio", "rule_sets", "tables"]
