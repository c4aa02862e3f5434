"""Window forms that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..shared import stored

_BEFORE, _PIECE = "__before", "__piece"


def running_total(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``keys`` up to this one in ``order``.

    ``order`` must be unique within the keys. ``value`` should be an exact type (integer or decimal), as partial sums
    are added in another order than the rows.

    A plain window sorts all rows of a key in one task. Here the rows are range-partitioned by keys and order, so a
    hot key (or a hot moment of it) spreads over many pieces, and each piece of a key is a window of its own. What
    comes before a piece, the pre-aggregated sums of the earlier ones, joins its window as a row that sorts first.
    The pieces are stored because both uses must see the same range bounds, also when an executor is lost.
    """
    ranged = df.withColumn("__value", value).repartitionByRange(*keys, *order)
    pieces = stored(ranged.withColumn("__piece", F.spark_partition_id()), "pieces")
    earlier = W.partitionBy(*keys).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    before = (
        pieces.groupBy("__piece", *keys)
        .agg(F.sum("__value").alias("__total"))
        .select("__piece", *keys, F.sum("__total").over(earlier).alias("__value"), F.lit(0).alias("__is_row"))
    )
    rows = pieces.withColumn("__is_row", F.lit(1)).unionByName(before, allowMissingColumns=True)
    upto = W.partitionBy("__piece", *keys).orderBy("__is_row", *order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn(name, F.sum("__value").over(upto)).where("__is_row = 1").select(*df.columns, name)


def ranked(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
) -> DataFrame:
    """Add places in ``order`` among the rows of the same ``keys``, under the names given.

    ``lag`` and ``lead`` name for each new column the one whose value of the row before or after it takes. ``order``
    must be unique within the keys for these two and for ``row_number``; rows that tie have the same ``rank`` and
    ``dense_rank``. Nulls come first and are equal to each other, in keys as well.

    The rows are range-partitioned by keys and order, as in :func:`running_total`, and each piece of a key is a window
    of its own. From every piece one row is gathered: its rows, its different places in the order, its first and last
    values. Added up over the earlier pieces of the key these give what the piece's own numbers lack, and the edges are
    what its first and last rows see beyond the piece. So a key that holds a third of all rows is worked on in as many
    tasks as a third of the data; only rows that tie in the whole order stay together.
    """
    lag, lead = lag or {}, lead or {}
    pieces = stored(df.repartitionByRange(*keys, *order).withColumn(_PIECE, F.spark_partition_id()), "pieces")
    place = F.struct(*(F.col(c) for c in order))
    edges = {f"last {name}": F.max_by(F.struct(F.col(c).alias("v")), place) for name, c in lag.items()}
    edges |= {f"first {name}": F.min_by(F.struct(F.col(c).alias("v")), place) for name, c in lead.items()}
    # ties never lie in two pieces, so different places add up
    places = [F.count_distinct(place).alias("places")] if dense_rank else []
    told = pieces.groupBy(_PIECE, *keys).agg(F.count("*").alias("rows"), *places, *(column.alias(name) for name, column in edges.items()))
    near = W.partitionBy(*keys).orderBy(_PIECE)
    earlier = near.rowsBetween(W.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in told.columns if name in ("rows", "places")]
    before += [F.lag(name).over(near).alias(name) for name in edges if name.startswith("last ")]
    before += [F.lead(name).over(near).alias(name) for name in edges if name.startswith("first ")]
    told = told.select(F.col(_PIECE).alias("of_piece"), *(F.col(k).alias(f"of {k}") for k in keys), F.struct(*before).alias(_BEFORE))
    same = F.col(_PIECE) == F.col("of_piece")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"`of {k}`"))
    rows = pieces.join(told, same)
    here = W.partitionBy(_PIECE, *keys).orderBy(*order)
    new = {}
    if row_number:
        new[row_number] = F.row_number().over(here) + F.col(f"{_BEFORE}.rows")
    if rank:
        new[rank] = F.rank().over(here) + F.col(f"{_BEFORE}.rows")
    if dense_rank:
        new[dense_rank] = F.dense_rank().over(here) + F.col(f"{_BEFORE}.places")
    for beside, edge, which in ((lag, "last", F.lag), (lead, "first", F.lead)):
        for name, c in beside.items():
            inside = which(F.struct(F.col(c).alias("v"))).over(here)
            new[name] = F.coalesce(inside, F.col(f"{_BEFORE}.`{edge} {name}`"))["v"]
    return rows.select(*df.columns, *(column.alias(name) for name, column in new.items()))
