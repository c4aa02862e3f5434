"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.shared import run_folder



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back, so that lost executors cost no recomputation."""
    folder = run_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def packed(df: DataFrame, **extra) -> DataFrame:
    """The row as one column ``row`` beside new columns, so that no name of ``df`` can clash with them."""
    row = F.struct(*(df[f"`{name}`"] for name in df.columns)) if df.columns else F.struct(F.lit(1))
    return df.select(row.alias("row"), *(column.alias(name) for name, column in extra.items()))


def unpacked(df: DataFrame, names: list[str], **extra) -> DataFrame:
    """The original columns and the new ones; an original column of a new one's name gives way to it."""
    kept = [F.col(f"row.`{name}`").alias(name) for name in names if name not in extra]
    return df.select(*kept, *(column.alias(name) for name, column in extra.items()))


def remembered(function: Callable) -> Callable:
    """``function`` with its results kept, for few different arguments; travels by value, unlike those of functools."""
    known = {}

    @wraps(function)
    def looked_up(*arguments):
        if arguments not in known:
            known[arguments] = function(*arguments)
        return known[arguments]

    return looked_up


def utf8(column) -> F.Column:
    """The bytes of a text for Python, which then need not be valid UTF-8."""
    return F.col(column).cast("string").cast("binary") if isinstance(column, str) else column.cast("binary")
