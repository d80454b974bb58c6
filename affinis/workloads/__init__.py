"""The operators applied to the order database, and the same results in SQL."""

from affinis.workloads.oracle import ORACLE
from affinis.workloads.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
