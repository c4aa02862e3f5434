"""A Bloom filter as a column: which rows may have one of many keys, told without a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the filter for each key, and bits that a key sets: one row in 400 is let through wrongly.
BITS_PER_KEY, PROBES = 16, 4
#: Largest filter (16 MB, sent to every task). With more keys than it has room for, more rows are let through.
MOST_BITS = 1 << 27


def might_hold(keys: DataFrame, pairs: list[tuple[Column, Column]] | None, most_bits: int = MOST_BITS) -> Column | None:
    """A condition that is true for every row whose columns equal those of some row of ``keys``, and few others.

    ``pairs`` has for each key column the tested one and that of ``keys``, in one type; without pairs there is none.
    The filter is an aggregate over ``keys`` (one row per 64 bits and task is shuffled), looked up as a constant.
    """
    if pairs is None:
        return None
    bits = 1 << 12
    count = keys.count()
    while bits < min(BITS_PER_KEY * count, most_bits):
        bits *= 2
    probed = keys.select(F.explode(F.array(*_probes([own for _, own in pairs], bits))).alias("bit"))
    words = probed.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = dense.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    filter_ = ordered.select(F.transform("words", lambda w: w["bits"])).scalar()
    held = None
    for bit in _probes([tested for tested, _ in pairs], bits):
        word = F.get(filter_, F.shiftright(bit, 6).cast("int"))
        found = F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1
        held = found if held is None else held & found
    return F.coalesce(held, F.lit(False))


def _probes(key: list[Column], bits: int) -> list[Column]:
    last = F.lit(bits - 1).cast("long")
    first, step = (h.bitwiseAND(last) for h in (F.xxhash64(*key), F.xxhash64(*key, F.lit("step"))))
    return [(first + k * step).bitwiseAND(last) for k in range(PROBES)]
