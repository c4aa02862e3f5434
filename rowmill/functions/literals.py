"""SQL literal text for a column, per database dialect."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

DIALECTS = ("postgres", "sqlite", "mssql")


def sql_literal(column: Column, data_type: T.DataType, dialect: str = "postgres") -> Column:
    """``column`` rendered as a SQL literal: numbers bare, text quoted with doubled quotes, NULL for nulls.

    Booleans are TRUE/FALSE on PostgreSQL and 1/0 on SQLite and SQL Server. Values without a literal form of their
    own (arrays, maps, structs) are quoted JSON text. Doubles use the shortest text that reads back as the same
    value; NaN and infinities use the spelling of the dialect, and SQL Server, which cannot store them, fails the job.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}, expected one of {DIALECTS}")
    return F.when(column.isNull(), F.lit("NULL")).otherwise(_value(column, data_type, dialect))


def _value(column: Column, data_type: T.DataType, dialect: str) -> Column:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return _fraction(column, dialect)
    if isinstance(data_type, T.NumericType):
        return column.cast("string")
    if isinstance(data_type, T.BooleanType):
        yes, no = ("TRUE", "FALSE") if dialect == "postgres" else ("1", "0")
        return F.when(column, F.lit(yes)).otherwise(F.lit(no))
    if isinstance(data_type, T.BinaryType):
        before, after = {"postgres": ("'\\x", "'"), "sqlite": ("X'", "'"), "mssql": ("0x", "")}[dialect]
        return F.concat(F.lit(before), F.hex(column), F.lit(after))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return _quoted(F.to_json(column), dialect)
    return _quoted(column.cast("string"), dialect)


def _quoted(text: Column, dialect: str) -> Column:
    # N'...' keeps characters outside the code page of the SQL Server database
    opening = "N'" if dialect == "mssql" else "'"
    return F.concat(F.lit(opening), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def _fraction(column: Column, dialect: str) -> Column:
    not_finite = F.isnan(column) | (F.abs(column) == F.lit(float("inf")))
    if dialect == "postgres":
        special = F.concat(F.lit("'"), column.cast("string"), F.lit("'::double precision"))
    elif dialect == "sqlite":
        special = F.when(F.isnan(column), F.lit("NULL")).when(column > 0, F.lit("9e999")).otherwise(F.lit("-9e999"))
    else:
        special = F.raise_error(F.lit("SQL Server cannot store NaN or infinite values")).cast("string")
    return F.when(not_finite, special).otherwise(column.cast("string"))
