"""DuckDB SQL oracle for the registered queries (used only for checking, never by the engine)."""
from .duckdb_sql import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
