"""SQL dump: a table as INSERT statements."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from ..functions.literals import sql_literal


def to_insert_statements(df: DataFrame, table: str, dialect: str = "postgres") -> DataFrame:
    """One statement ``INSERT INTO table (columns) VALUES (...);`` per row in column ``stmt``; write it with ``write.text``.

    A line break in a value is kept, so such a statement takes several lines. The table's name is taken as given; column
    names that are no plain lower-case names are quoted. A map-only projection of built-in expressions.
    """
    values = [
        sql_literal(F.col("`" + field.name.replace("`", "``") + "`"), field.dataType, dialect) for field in df.schema
    ]
    head = f"INSERT INTO {table} ({', '.join(_identifier(name, dialect) for name in df.columns)}) VALUES ("
    return df.select(F.concat(F.lit(head), F.concat_ws(", ", *values), F.lit(");")).alias("stmt"))


def _identifier(name: str, dialect: str) -> str:
    if re.fullmatch("[a-z_][a-z0-9_]*", name):
        return name
    return f"[{name.replace(']', ']]')}]" if dialect == "mssql" else '"' + name.replace('"', '""') + '"'
