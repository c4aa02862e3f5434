"""Projection, filter, limit and SQL text with bound parameters."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Params = list | tuple | dict | None


def execute(
    spark: SparkSession, sql: str, params: Params = None, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Run one SQL statement; ``?`` markers take a list, ``:name`` markers a dict. Values are bound, never spliced.

    ``tables`` gives DataFrames names for this statement; views that the caller has under such a name are back after it.
    """
    before = {name: spark.table(name) if _is_view(spark, name) else None for name in tables or {}}
    try:
        for name, df in (tables or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql, args=list(params) if isinstance(params, tuple) else params)
    finally:
        for name, view in before.items():
            if view is None:
                spark.catalog.dropTempView(name)
            else:
                view.createOrReplaceTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def select(
    df: DataFrame,
    columns: Iterable[str | Column] | None = None,
    where: str | Column | None = None,
    params: Params = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows where ``where`` is true (NULL counts as false), ``columns`` of them (SQL text or Columns, all when
    absent), at most ``limit`` of them in no promised order.

    SQL text is trusted; put values in ``params``.
    """
    rows = filter_rows(df, where, params)
    if columns is not None:
        rows = rows.select(*[F.expr(c) if isinstance(c, str) else c for c in columns])
    return rows if limit is None else rows.limit(limit)


def filter_rows(df: DataFrame, where: str | Column | None, params: Params = None) -> DataFrame:
    """Plain filter, kept in a form that reaches the scan as a pushed predicate."""
    if where is None:
        if params:
            raise ValueError("params given without a where text")
        return df
    if isinstance(where, Column) or not params:
        return df.where(where)
    return over_view(df, "SELECT * FROM ", params, f" WHERE {where}")


def over_view(df: DataFrame, before: str, params: Params = None, after: str = "") -> DataFrame:
    """Run ``before``, a view of ``df`` and ``after`` as one statement; the view lives only until the plan is analysed."""
    view = f"v_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return execute(df.sparkSession, before + view + after, params)
    finally:
        df.sparkSession.catalog.dropTempView(view)


def recent(df: DataFrame, ts: str, interval: str, anchor: Column | DataFrame | None = None) -> DataFrame:
    """Rows whose ``ts`` lies after ``anchor`` minus ``interval`` (``'7 days'``); the anchor is now when absent.

    An anchor taken from data is a one-row DataFrame, such as ``df.agg(F.max(ts))``. It becomes a scalar subquery that
    yields the start itself, so that the scan can use the comparison to skip row groups.
    """
    span = F.expr(f"INTERVAL {interval}")
    kind = df.schema[ts].dataType
    if isinstance(anchor, DataFrame):
        start = anchor.select((F.col(anchor.columns[0]) - span).cast(kind)).scalar()
    else:
        start = ((F.current_timestamp() if anchor is None else anchor) - span).cast(kind)
    return df.where(F.col(ts) > start)
