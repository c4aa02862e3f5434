"""Typing jobs: find the narrowest column type that fits every value, then cast.

Four ladders, one aggregate pass each (combined per task, then one row per column; the data is not shuffled):

- ``sqlite``  bigint, double, string
- ``mssql``   int, bigint, double, boolean, string
- ``input``   bigint, double, string over JSON values; mixed whole and fractional numbers widen to double,
  any text makes the column string
- ``stored``  bigint, double, string, binary, variant over values in the classes in which a file stores them

``sqlite`` and ``mssql`` judge text columns by content: the text must be the number and nothing else (no blanks, no
words such as ``NaN``), written so that the number gives the text back: ``00501``, ``+1``, ``1.50`` and numbers with
more digits than their type holds are text. ``loose=True`` takes those for numbers too, and loses how they were written.
``input`` judges each VARIANT value by its kind: ``69`` is a number, ``"69"`` is text; text columns are text.

``stored`` also judges VARIANT values by their kind and keeps every one of them: whole numbers are bigint, also beside
reals double as long as a double holds them; where it does not, and beside any text, the column is string; bytes alone
are binary, and bytes beside anything else leave the column VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WHOLE = r"\A[+-]?[0-9]+\z"
_FRACTION = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

_PLAIN_WHOLE = r"\A(0|-?[1-9][0-9]*)\z"
_PLAIN_FRACTION = r"\A-?(0|[1-9][0-9]*)(\.(0|[0-9]*[1-9]))?([eE][+-]?[0-9]+)?\z"

# Declared PostgreSQL type names and the column types they become.
POSTGRES_TYPES = {
    "INT2": "smallint",
    "SMALLINT": "smallint",
    "INT4": "int",
    "INT": "int",
    "INTEGER": "int",
    "INT8": "bigint",
    "BIGINT": "bigint",
    "FLOAT4": "float",
    "REAL": "float",
    "FLOAT8": "double",
    "DOUBLE PRECISION": "double",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
}

# For each ladder, the column type by the highest rank among its values. Ranks are those of _text_rank and _json_rank.
_TYPES_BY_RANK = {
    "sqlite": ["bigint", "bigint", "double", "string", "string"],
    "mssql": ["int", "bigint", "double", "string", "string"],
    "input": ["bigint", "double", "string"],
    "stored": ["bigint", "bigint", "double", "string", "binary"],
}
#: Ranks of ``stored`` that decide together: whole numbers beyond a double's reach, reals, text, bytes.
_WIDE, _REAL, _TEXT, _BYTES = 1, 2, 3, 4
_BOOLEAN_RANK = 3


def infer_types(
    df: DataFrame, ladder: str = "sqlite", columns: list[str] | None = None, loose: bool = False
) -> DataFrame:
    """One row ``(column_name, type)`` per column, from a single pass over every value.

    ``loose`` takes any text that can be read as a number for one, also where the number would not give it back. A column without non-null values gets the first type of the ladder.
    """
    names = list(columns or df.columns)
    cells = cells_of(df, names, ladder, loose)
    every_column = df.sparkSession.range(len(names)).select(F.col("id").cast("int"), F.lit(None).cast("int"))
    ends = cells.select("column", "rank").union(every_column).groupBy("column").agg(*state_of("rank"))
    name = F.get(F.array(*[F.lit(name) for name in names]), F.col("column"))
    return ends.select(name.alias("column_name"), kind_of(ladder).alias("type"))


def cells_of(df: DataFrame, names: list[str], ladder: str, loose: bool, *more: Column) -> DataFrame:
    """``(more.., column, rank)`` for every value.

    One small expression over (column, value) rows instead of one per column: its generated code stays compilable
    however many columns there are, and states are combined before the few groups are shuffled.
    """
    if ladder not in _TYPES_BY_RANK:
        raise ValueError(f"unknown ladder {ladder!r}, expected one of {sorted(_TYPES_BY_RANK)}")
    values = F.array(*[_source(df, name, ladder) for name in names])
    cells = df.select(*more, F.posexplode(values).alias("column", "value"))
    ranked = {"input": _json_rank, "stored": _stored_rank}.get(ladder, lambda value: _text_rank(value, loose))
    return cells.withColumn("rank", ranked(F.col("value"))).drop("value")


def state_of(rank: str) -> list[Column]:
    """What is known of a column after some of its values; states of parts are merged by :func:`merged_states`."""
    seen = F.bit_or(F.expr(f"shiftleft(1, {rank})"))
    return [F.min(rank).alias("low"), F.max(rank).alias("high"), seen.alias("seen")]


def merged_states() -> list[Column]:
    return [F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("seen").alias("seen")]


def kind_of(ladder: str) -> Column:
    """The type for a state; of a column without values the first one."""
    high = F.coalesce("high", F.lit(0))
    kind = F.get(F.array(*[F.lit(kind) for kind in _TYPES_BY_RANK[ladder]]), high)
    if ladder == "mssql":
        return F.when((F.col("low") == _BOOLEAN_RANK) & (high == _BOOLEAN_RANK), F.lit("boolean")).otherwise(kind)
    if ladder == "stored":
        wide_and_real = (1 << _WIDE) | (1 << _REAL)
        both = F.col("seen").bitwiseAND(F.lit(wide_and_real)) == wide_and_real
        mixed = (high == _BYTES) & (F.col("low") < _BYTES)
        return F.when(mixed, F.lit("variant")).when((high == _REAL) & both, F.lit("string")).otherwise(kind)
    return kind


def apply_types(df: DataFrame, types: DataFrame | dict[str, str], ladder: str = "sqlite") -> DataFrame:
    """Cast the columns named in ``types``; a value that does not fit fails the job instead of becoming NULL.

    ``types`` is the result of :func:`infer_types` (one row per column is fetched) or a plain dict.
    """
    chosen = types if isinstance(types, dict) else {row.column_name: row.type for row in types.collect()}
    convert = {"input": _json_value, "stored": _stored_value}.get(ladder, _text_value)
    return df.select(
        *[
            convert(_source(df, name, ladder), chosen[name]).alias(name) if name in chosen else _quote(name)
            for name in df.columns
        ]
    )


def map_types(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Cast columns to the types their declared PostgreSQL names stand for; unknown names give string."""
    wanted = {name: POSTGRES_TYPES.get(kind.strip().upper(), "string") for name, kind in declared.items()}
    missing = set(wanted) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(
        *[(_quote(name).cast(wanted[name]).alias(name) if name in wanted else _quote(name)) for name in df.columns]
    )


def _quote(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _source(df: DataFrame, name: str, ladder: str) -> Column:
    """The column as the ladder reads it: text, or for ``input`` a VARIANT; a text column becomes one of strings."""
    column = _quote(name)
    if ladder not in ("input", "stored"):
        return column
    if isinstance(df.schema[name].dataType, T.VariantType):
        return column
    return F.try_variant_get(F.to_variant_object(F.struct(column.alias("text"))), "$.text", "variant")


def _text_value(text: Column, kind: str) -> Column:
    return text if kind == "string" else text.cast(kind)


def _text_rank(text: Column, loose: bool) -> Column:
    """0 fits int, 1 fits bigint, 2 is another number, 3 is true or false, 4 is other text; NULL for NULL.

    The range of a whole number is judged by its length or by a cast that it fits for sure: a failed ``try_cast``
    costs as much as a hundred that succeed.
    """
    digits = F.length(text)
    beyond = 2 if loose else 4
    whole = (
        F.when(digits < 10, 0)
        .when(digits < 19, _width_rank(text.try_cast("bigint"), beyond))
        .when(digits < 38, _width_rank(text.try_cast("decimal(38,0)"), beyond))
        .otherwise(_width_rank(text.try_cast("bigint"), beyond))
    )
    fraction = F.lit(2)
    if not loose:
        # fifteen digits always come back from a double; of longer texts the double must give the same digits
        fraction = F.when((digits < 16) | (_digits(text) == _digits(text.try_cast("double").cast("string"))), 2).otherwise(4)
    return (
        F.when(text.rlike(_WHOLE if loose else _PLAIN_WHOLE), whole)
        .when(text.rlike(_FRACTION if loose else _PLAIN_FRACTION), fraction)
        .when(F.lower(text).isin("true", "false"), _BOOLEAN_RANK)
        .when(text.isNotNull(), 4)
    )


def _digits(number: Column) -> Column:
    """The significant digits of a number's text."""
    return F.regexp_replace(F.regexp_replace(number, "[eE].*$|[-.]", ""), "^0+|0+$", "")


def _width_rank(number: Column, beyond: int) -> Column:
    return F.when(number.between(-(2**31), 2**31 - 1), 0).when(number.between(-(2**63), 2**63 - 1), 1).otherwise(beyond)


def _json_rank(value: Column) -> Column:
    """0 is whole (or true, false), 1 another number, 2 text, object or array; NULL for NULL and JSON null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isin("BIGINT", "BOOLEAN"), 0)
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), 1)
        .when(kind != "VOID", 2)
    )


def _stored_rank(value: Column) -> Column:
    """0 is a whole number that a double holds, 1 another whole one, 2 a real, 3 text or what has a text, 4 bytes."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "bigint")
    return (
        F.when(kind == "BIGINT", F.when(number.between(-(2**53), 2**53), 0).otherwise(_WIDE))
        .when(kind.isin("DOUBLE", "FLOAT"), _REAL)
        .when(kind == "BINARY", _BYTES)
        .when(kind != "VOID", _TEXT)
    )


def _stored_value(value: Column, kind: str) -> Column:
    return value if kind == "variant" else F.variant_get(value, "$", kind)


def _json_value(value: Column, kind: str) -> Column:
    json_kind = F.schema_of_variant(value)
    bit = F.try_variant_get(value, "$", "boolean").cast("int")
    if kind in ("bigint", "double"):
        number = F.when(json_kind != "VOID", F.variant_get(value, "$", kind))
        return F.when(json_kind == "BOOLEAN", bit.cast(kind)).otherwise(number)
    return (
        F.when(json_kind == "VOID", F.lit(None).cast("string"))
        .when(json_kind == "BOOLEAN", bit.cast("string"))
        .when(json_kind.isin("DOUBLE", "FLOAT"), _plain(F.try_variant_get(value, "$", "double")))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def _plain(number: Column) -> Column:
    """A double with all its places and without an exponent, however large or small; whole ones without a point."""
    text = number.cast("string")
    small = F.regexp_replace(F.format_string("%.345f", number), "0+$", "")
    return (
        F.when(F.contains(text, F.lit("E-")), small)
        .when(F.contains(text, F.lit("E")) | F.endswith(text, F.lit(".0")), F.format_string("%.0f", number))
        .otherwise(text)
    )
