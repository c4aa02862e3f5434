"""Global order and running totals from per-partition totals, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.llm.common import written

#: ``monotonically_increasing_id`` holds the partition in the bits above these.
ROW_BITS = 33


def laid_out(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` in a global order by the columns ``order``, which are dropped, written once with column ``at``.

    ``at`` grows along the order: range partition in the upper bits, position in it in the lower ones. Rows that tie
    are spread over partitions by the column ``tie``, so a key that holds a third of all rows is no hot partition;
    ``order`` should therefore tell rows apart that differ, else their order is any. Rows that come out of a shuffle
    should bring a ``tie`` of their own, taken before it (see :func:`tie`): when a task runs again it must find each row
    with the same one, or ranges of two attempts could overlap.
    """
    rows = rows if "tie" in rows.columns else rows.withColumn("tie", tie())
    keep = [name for name in rows.columns if name not in (*order, "tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "tie"]
    ranged = rows.repartitionByRange(parts, *keys)
    placed = ranged.sortWithinPartitions(*keys).select(*keep, F.monotonically_increasing_id().alias("at"))
    return written(placed, "layout")


def tie() -> Column:
    """A number that tells rows apart, the same for a row whenever it is read from a table again."""
    return F.monotonically_increasing_id()


def partition_of(at: str) -> Column:
    return F.shiftright(at, ROW_BITS)


def position_of(at: str) -> Column:
    return F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def partition_totals(rows: DataFrame, value: str, group: list[str]) -> DataFrame:
    """One row per group and partition: rows and sum of ``value`` in it (``own_*``) and in the group's earlier ones."""
    totals = rows.groupBy(*group, partition_of("at").alias("part")).agg(
        F.count("*").alias("own_rows"), F.sum(value).alias("own_sum"), F.min("at").alias("first_at")
    )
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "*",
        F.coalesce(F.sum("own_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("own_sum").over(earlier), F.lit(0)).alias("sum_before"),
    )


def running(rows: DataFrame, value: str, group: list[str], totals: DataFrame) -> DataFrame:
    """``(group.., at, value, before)``: the sum of ``value`` over the group's earlier rows.

    A row needs only its partition's rows and the totals of the others, so a hot group is worked on in as many tasks as
    it has partitions. ``totals`` has one row per group and partition.
    """
    here = Window.partitionBy(*group, "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(*group, "at", value, partition_of("at").alias("part")).withColumn(
        "here", F.coalesce(F.sum(value).over(here), F.lit(0))
    )
    offsets = totals.select(*(F.col(g).alias(f"of_{g}") for g in group), F.col("part").alias("of_part"), "sum_before")
    same = F.col("part") == F.col("of_part")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"of_{g}"))
    return local.join(offsets, same).select(*group, "at", value, (F.col("here") + F.col("sum_before")).alias("before"))
