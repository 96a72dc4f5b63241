"""Every registered query with the DuckDB SQL that must give the same rows."""

from catalog import cleaning, files, jobs, loading, quality, reports, shaping  # noqa: F401
from catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
