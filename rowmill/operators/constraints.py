"""NOT NULL and unique-key checks of a batch, before it is inserted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..shared import settle


class ConstraintViolation(ValueError):
    """A batch was refused; ``violations`` is the full report as a DataFrame."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def check_constraints(
    table: str | DataFrame, df: DataFrame, not_null: Sequence[str] = (), key: Sequence[str] = ()
) -> DataFrame:
    """Report what in ``df`` breaks NOT NULL columns or the unique ``key``, within the batch and against ``table``.

    One row per violated constraint and key: ``constraint`` (``not_null``, ``unique_in_batch``, ``unique_in_table``),
    ``columns``, the key's values and ``n_rows``, the batch rows concerned. An empty report means the batch may go in.
    As in SQL, a key with a NULL in it equals no other key.

    Keys are pre-aggregated on the map side, so a key that fills a third of the batch or the table costs one row per
    task. A small batch is joined to the table's key columns without shuffling the table.
    """
    if not not_null and not key:
        raise ValueError("no constraint given")
    reports = []
    if not_null:
        reports.append(_nulls(df, list(not_null), list(key)))
    if key:
        reports += _repeated(table, df, list(key))
    return reduce(DataFrame.unionByName, reports)


def _nulls(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    broken = df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))
    return (
        broken.select(F.lit("not_null").alias("constraint"), F.explode(missing).alias("columns"), *key)
        .groupBy("constraint", "columns", *key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _repeated(table: str | DataFrame, df: DataFrame, key: list[str]) -> list[DataFrame]:
    stored = df.sparkSession.table(table) if isinstance(table, str) else table
    given, small = settle(df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")))

    def report(rows: DataFrame, constraint: str) -> DataFrame:
        return rows.select(
            F.lit(constraint).alias("constraint"), F.lit(", ".join(key)).alias("columns"), *key, "n_rows"
        )

    keys = stored.select(*key)
    # against a broadcast side the table stays where it is; otherwise its keys are reduced before they are shuffled
    present = keys.join(given, key).distinct() if small else keys.distinct().join(given, key)
    return [report(given.where("n_rows > 1"), "unique_in_batch"), report(present, "unique_in_table")]
