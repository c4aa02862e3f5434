"""Contiguous shards of nearly equal size from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.llm.common import packed, unpacked
from rowmill.llm.layout import laid_out, partition_of, partition_totals, position_of, running

#: Bytes that a row costs besides its text.
ROW_OVERHEAD = 16


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (none for null) plus the row's own cost."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")


def shard_by_bytes(df: DataFrame, shards: int, size: Column, order: list[Column]) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Rows are laid out in ``order``; totals per range partition give every partition its place in the global prefix sum;
    the sum is cut at equal targets. A row lies in the shard that holds its middle byte, so a shard differs from the
    target by at most half of the rows at its two ends, and shards are contiguous in the order. Null or negative sizes
    count as 0; if all sizes are 0, shard 0 gets all rows. Nulls in the order come first; rows alike in the order are
    told apart by nothing but their place. An empty table gives no rows. Columns of ``df`` named shard or slot give way.

    Rows with their texts are shuffled once and written once; the prefix sum works on ``(at, size)`` alone. What is
    broadcast has one row per shard or per range partition.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    keys = {f"key{i}": column for i, column in enumerate(order)}
    sized = packed(df, size=F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)), **keys)
    rows = laid_out(sized, list(keys))
    totals = partition_totals(rows, "size", [])
    total = totals.agg(F.sum("own_sum")).first()[0] or 0
    placed = running(rows, "size", [], totals)
    exact = "cast({} as decimal(38,0))"
    middle = exact.format("2 * before + size")
    cut = f"cast(least({shards - 1}, ({middle} * {shards}) div {exact.format(max(1, 2 * total))}) as int)"
    # the first place of every shard: one row per shard, so bounded by the number of shards
    firsts = placed.groupBy(F.expr(cut).alias("shard")).agg(F.min("at").alias("start"))
    return unpacked(
        rows.withColumn("part", partition_of("at"))
        .join(F.broadcast(_parts_with_cuts(totals, firsts)), "part")
        .withColumn("cut", F.expr("element_at(filter(cuts, c -> c.start <= at), -1)")),
        df.columns,
        shard=F.col("cut.shard"),
        slot=(F.col("rows_before") + position_of("at") - F.col("cut.start_rank")).cast("long"),
    )


def _parts_with_cuts(totals: DataFrame, firsts: DataFrame) -> DataFrame:
    """One row per range partition: its rank offset and the shards that begin in it, after the one it begins in."""
    starts = (
        firsts.withColumn("part", partition_of("start"))
        .join(totals.select("part", "rows_before"), "part")
        .groupBy("part")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("start", "shard", (F.col("rows_before") + position_of("start")).alias("start_rank"))
                )
            ).alias("own")
        )
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.last(F.element_at("own", -1), ignorenulls=True).over(earlier)
    return (
        totals.select("part", "rows_before")
        .join(starts, "part", "left")
        .withColumn("begun", begun)
        .select(
            "part", "rows_before", F.expr("filter(concat(array(begun), coalesce(own, array())), c -> c is not null)").alias("cuts")
        )
    )
