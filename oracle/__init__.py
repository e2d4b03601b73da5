"""Independent SQL (DuckDB dialect) for every query whose result SQL can express."""

from oracle.queries import ORACLE

__all__ = ["ORACLE"]
