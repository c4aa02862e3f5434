"""Sources and sinks: JDBC databases, SQLite files, several connections at once, SQL dumps."""

from .dump import to_insert_statements
from .jdbc import append_once, key_ranges, open_database, read_query, read_table, write_table
from .multi import copy_resumable, copy_table, read_all, read_source, write_source
from .sqlite import read_sqlite, use_sqlite, write_sqlite

__all__ = [
    "append_once",
    "copy_resumable",
    "copy_table",
    "key_ranges",
    "open_database",
    "read_all",
    "read_query",
    "read_source",
    "read_sqlite",
    "read_table",
    "to_insert_statements",
    "use_sqlite",
    "write_source",
    "write_sqlite",
    "write_table",
]
