"""The same read over several connections, and copies between them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.files import Files
from ..operators.reads import Params, select
from . import jdbc, sqlite

FILE_FORMATS = ("parquet", "orc", "csv", "json")
_WIDTHS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

def read_source(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition: dict | None = None,
    columns: list[str] | None = None,
    source_where: str | None = None,
    source_params: list | None = None,
) -> DataFrame:
    """One table of one connection; the ``format`` option picks the source: ``jdbc`` (when absent), ``sqlite`` or a file
    format of Spark's, such as ``parquet``, whose tables are the folders or files ``table`` in the folder ``path``.

    ``partition`` splits a JDBC scan; without it the primary key does, or one task reads the table. SQLite files are
    always split; their option ``typing`` is that of :func:`read_sqlite`. Only ``columns`` leave the source.
    ``source_where`` is a condition in SQLite's own SQL, with ``?`` for each of ``source_params``, that the files apply
    before rows reach Spark; for the other sources Spark pushes filters down by itself.
    """
    kind = options.get("format", "jdbc")
    if kind == "sqlite":
        typing = options.get("typing", "declared")
        return sqlite.read_sqlite(spark, options["path"], table, columns, source_where, source_params, typing=typing)
    if source_where is not None:
        raise ValueError(f"source_where is for SQLite; Spark pushes filters down to {kind} by itself")
    if kind == "jdbc":
        rows = jdbc.read_table(spark, options, table, partition)
    elif kind in FILE_FORMATS:
        more = {k: v for k, v in options.items() if k not in ("format", "path")}
        rows = spark.read.format(kind).options(**more).load(f"{options['path'].rstrip('/')}/{table}")
    else:
        raise ValueError(f"unknown source format {kind!r}")
    return rows.select(*columns) if columns else rows


def write_source(df: DataFrame, options: dict[str, str], table: str) -> int:
    """Append to one table of one connection; returns the number of rows written."""
    kind = options.get("format", "jdbc")
    if kind == "sqlite":
        return sqlite.write_sqlite(df, options["path"], table)
    if kind == "jdbc":
        return jdbc.write_table(df, options, table)
    raise ValueError(f"unknown source format {kind!r}")


def copy_table(
    spark: SparkSession,
    src: tuple[dict[str, str], str],
    dst: tuple[dict[str, str], str],
    where: str | None = None,
    columns: Iterable[str] | None = None,
    params: Params = None,
    partition: dict | None = None,
    source_where: str | None = None,
    source_params: list | None = None,
) -> int:
    """Scan, filter, project and append in one job, partition by partition; returns the number of rows copied.

    ``source_where`` is applied by SQLite itself (see :func:`read_source`), ``where`` by Spark. Without ``where``, a
    list of plain column names is all that is read.
    """
    named = None if columns is None else list(columns)
    plain = named if where is None and named and all(isinstance(c, str) and c.isidentifier() for c in named) else None
    rows = read_source(spark, *src, partition, plain, source_where, source_params)
    return write_source(select(rows, named, where, params), *dst)


def copy_resumable(
    spark: SparkSession,
    src: tuple[dict[str, str], str],
    dst: tuple[dict[str, str], str],
    manifest: str,
    key: list[str] | None = None,
    columns: Iterable[str] | None = None,
    where: str | None = None,
    params: Params = None,
    num_ranges: int = 64,
    at_once: int = 16,
    most_groups: int | None = None,
) -> int:
    """A copy that can be broken off and called again; returns the rows that all calls together have copied.

    The first call cuts the source into ``num_ranges`` ranges of equally many rows, by ``key`` (JDBC; the primary key
    where none is given) or by row id or primary key (SQLite), and writes them down in the folder ``manifest``, which
    every later call must name too. Groups of ``at_once`` ranges are then copied one after the other, each as a load of
    its own that the target takes once (:func:`append_once`, or ``load`` of :func:`write_sqlite`), and noted when they
    are done; a later call goes on with the open ones. ``most_groups`` ends a call after so many of them.

    The source should not change between the calls: rows that come in later belong to the range of their key and are
    copied only if it is still open.
    """
    files = Files(spark, manifest)
    plan = files.read(f"{manifest}/plan.json")
    if plan is None:
        plan = json.dumps({"load": uuid.uuid4().hex, "ranges": _ranges(spark, *src, key, num_ranges)})
        files.write(f"{manifest}/plan.json", plan)
    told = json.loads(plan)
    total, groups = 0, [told["ranges"][k : k + at_once] for k in range(0, len(told["ranges"]), at_once)]
    for number, group in enumerate(groups):
        note = f"{manifest}/done-{number}.json"
        done = files.read(note)
        if done is None:
            if most_groups == 0:
                break
            most_groups = None if most_groups is None else most_groups - 1
            rows = select(_read_ranges(spark, *src, group), None if columns is None else list(columns), where, params)
            done = json.dumps(_load(rows, *dst, f"{told['load']}-{number}"))
            files.write(note, done)
        total += json.loads(done)
    return total


def _ranges(spark: SparkSession, options: dict[str, str], table: str, key: list[str] | None, num_ranges: int) -> list:
    kind = options.get("format", "jdbc")
    if kind == "sqlite":
        return sqlite.ranges_of(options["path"], table, num_ranges)
    if kind != "jdbc":
        raise ValueError(f"a copy from {kind!r} cannot be cut into ranges")
    key = key or jdbc.primary_key(spark, options, table)
    if not key:
        raise ValueError(f"{table} has no primary key: name the columns to cut it by")
    return jdbc.key_ranges(spark, options, table, key, num_ranges)


def _read_ranges(spark: SparkSession, options: dict[str, str], table: str, ranges: list) -> DataFrame:
    if options.get("format", "jdbc") == "sqlite":
        return sqlite.read_sqlite(spark, options["path"], table, ranges=ranges)
    return jdbc.read_table(spark, options, table, ranges)


def _load(df: DataFrame, options: dict[str, str], table: str, load: str) -> int:
    if options.get("format", "jdbc") == "sqlite":
        return sqlite.write_sqlite(df, options["path"], table, load)
    return jdbc.load_once(df, options, table, load)[1]


def read_all(
    spark: SparkSession,
    sources: Iterable[tuple[str, dict[str, str]]],
    table: str,
    where: str | Column | None = None,
    params: Params = None,
    tag: str = "source",
    partition: dict | None = None,
    columns: list[str] | None = None,
    source_where: str | None = None,
    source_params: list | None = None,
) -> DataFrame:
    """The same table and filter on every connection, one result with the connection's name in ``tag``.

    Columns are matched by name; one that a connection lacks is NULL for its rows. Where connections give a column
    different types it gets the least type that keeps every value as it is (see :func:`common_type`); where there is
    none the read is refused and the column and its types are named. ``columns`` and ``source_where`` are as for
    :func:`read_source`; ``where`` needs the columns that it names, and sees each connection's own types.
    """
    parts = []
    for name, options in sources:
        rows = read_source(spark, options, table, partition, columns, source_where, source_params)
        parts.append((name, select(rows, where=where, params=params)))
    kinds: dict[str, list[tuple[str, T.DataType]]] = {}
    for name, rows in parts:
        for field in rows.schema:
            kinds.setdefault(field.name.lower(), []).append((name, field.dataType))
    agreed = {column: _agreed(column, found) for column, found in kinds.items()}
    typed = []
    for name, rows in parts:
        of = {field.name: agreed[field.name.lower()] for field in rows.schema}
        same = [_quoted(c) if rows.schema[c].dataType == kind else _quoted(c).cast(kind).alias(c) for c, kind in of.items()]
        typed.append(rows.select(*same).withColumn(tag, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _agreed(column: str, found: list[tuple[str, T.DataType]]) -> T.DataType:
    kind = found[0][1]
    if any(k == T.StringType() for _, k in found):  # text may hold what no number type does
        kind = T.StringType()
    for _, other in found:
        wider = common_type(kind, other)
        if wider is None:
            told = ", ".join(f"{k.simpleString()} in {name}" for name, k in found)
            raise ValueError(f"column {column} has no common type that keeps its values: {told}")
        kind = wider
    return kind


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds every value of both without changing it, or None.

    Whole numbers widen to the larger one, to decimals with room for both, and to doubles that hold them all (int, not
    bigint); decimals to the digits of both before and behind the point. Dates become timestamps, and anything with one
    clear text becomes text beside text. Doubles beside decimals or bigint, bytes beside text and nested values are not
    brought together.
    """
    if a == b:
        return a
    if isinstance(b, T.NullType) or isinstance(a, T.NullType):
        return a if isinstance(b, T.NullType) else b
    ranks = [_WIDTHS.get(type(kind)) for kind in (a, b)]
    if all(ranks):
        return a if ranks[0] > ranks[1] else b
    digits = [_digits(kind) for kind in (a, b)]
    if all(digits):
        whole, places = max(p - s for p, s in digits), max(s for _, s in digits)
        return T.DecimalType(whole + places, places) if whole + places <= 38 else None
    fraction = next((k for k in (a, b) if isinstance(k, (T.FloatType, T.DoubleType))), None)
    other = b if fraction is a else a
    if fraction is not None and isinstance(other, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if fraction is not None and (isinstance(other, (T.ByteType, T.ShortType)) or (isinstance(other, T.IntegerType))):
        return fraction if not isinstance(other, T.IntegerType) else T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        later = [k for k in (a, b) if not isinstance(k, T.DateType)]
        return later[0] if len(later) == 1 else None  # with and without time zone do not mix
    text = T.StringType()
    clear = (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)
    if text in (a, b) and isinstance(b if a == text else a, clear):
        return text
    return None


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Decimal digits of a number type, and those behind the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    return (_WHOLE_DIGITS[type(kind)], 0) if type(kind) in _WHOLE_DIGITS else None
