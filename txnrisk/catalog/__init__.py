"""Registry of named queries: a Spark builder and (when SQL can say it) the
equivalent DuckDB SQL used as an independent oracle."""

from .registry import QUERIES, ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]
