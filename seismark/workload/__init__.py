from seismark.workload import analytics, loads, quality, transforms  # noqa: F401
from seismark.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
