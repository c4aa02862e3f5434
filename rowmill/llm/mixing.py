"""Mix sources to target weights: budgets down a tree, then a prefix of every leaf's shuffled stream."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowmill.llm.common import packed, unpacked, written
from rowmill.llm.layout import laid_out, partition_totals, running, tie
from rowmill.shared import settle

#: Bytes that one token is counted as.
BYTES_PER_TOKEN = 4


def token_estimate(text: Column) -> Column:
    """Tokens of a text by its UTF-8 bytes, rounded up; null has none."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / F.lit(BYTES_PER_TOKEN)).cast("long")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[tuple[str, ...], float],
    budget: int,
    epochs: int,
    default_weight: float = 1.0,
) -> DataFrame:
    """``leaves(levels.., supply)`` with ``budget``, the tokens that each leaf shall give.

    The tree's nodes are the distinct prefixes of ``levels``; null is a name of its own. A node passes its budget to
    its children by weight, but to none more than it can give, which is ``epochs`` times the supply below it. What a
    child cannot take goes to its siblings by weight, and only what all of them cannot take stays with the parent's own
    siblings. Since a child's capacity counts all that lies below it, one pass from the root finds this: at each node
    the children are taken in the order of capacity per weight, and while the next one's share exceeds its capacity it
    is filled and leaves the sharing. Unnamed nodes weigh ``default_weight``; a weight of 0 gives nothing. If the whole
    tree cannot give ``budget``, every leaf gives all its epochs. Budgets are whole tokens, rounded down.
    """
    nodes = leaves.withColumn("capacity", (F.col("supply") * epochs).cast("double"))
    given = None
    for depth in range(1, len(levels) + 1):
        prefix = list(levels[:depth])
        own = nodes.groupBy(*prefix).agg(F.sum("capacity").alias("cap"))
        if depth > 1:
            above = [F.col(c).alias(f"of_{c}") for c in prefix[:-1]]
            own = own.join(
                given.select(*above, F.col("given").alias("to_share")), _same(prefix[:-1])
            ).select(*prefix, "cap", "to_share")
        else:
            own = own.withColumn("to_share", F.lit(float(budget)))
        named = {"\x1f".join(path): float(w) for path, w in weights.items() if len(path) == depth}
        weight = _weight(F.concat_ws("\x1f", *(F.coalesce(F.col(c), F.lit("")) for c in prefix)), named, default_weight)
        siblings = Window.partitionBy(*prefix[:-1]).orderBy(F.col("cap") / F.col("weight"), *prefix)
        before = siblings.rowsBetween(Window.unboundedPreceding, -1)
        rest = siblings.rowsBetween(0, Window.unboundedFollowing)
        own = own.withColumn("weight", weight).where("weight > 0")
        own = own.select(
            *prefix,
            "cap",
            "weight",
            "to_share",
            F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("filled"),
            F.sum("weight").over(rest).alias("sharing"),
        )
        level = (F.col("to_share") - F.col("filled")) / F.col("sharing")
        own = own.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
        # all that are not full share what the full ones leave at the level of the first of them
        all_siblings = Window.partitionBy(*prefix[:-1])
        rise = F.min(F.when(~F.col("full"), F.struct(F.col("filled"), F.col("level")))).over(all_siblings)["level"]
        given = own.withColumn("rise", rise).select(
            *prefix, F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("rise")).alias("given")
        )
        given = written(given, "budgets")
    above = [F.col(c).alias(f"of_{c}") for c in levels]
    return leaves.join(given.select(*above, "given"), _same(levels), "left").select(
        *leaves.columns, F.floor(F.coalesce("given", F.lit(0.0))).cast("long").alias("budget")
    )


def _same(names: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"of_{name}"))
    return same


def _weight(path: Column, named: Mapping[str, float], default: float) -> Column:
    if not named:
        return F.lit(float(default))
    table = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))
    return F.coalesce(table[path], F.lit(float(default)))


def mix(
    df: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[tuple[str, ...], float],
    tokens: Column,
    key: Column,
    budget_share: float,
    epochs: int,
    seed: int,
) -> DataFrame:
    """``df`` with ``epoch`` (from 0): each row as often as its leaf's budget reaches over it.

    ``levels`` are the tree's levels from the top (expressions over ``df``), ``weights`` the weights of named nodes, the
    budget is ``budget_share`` of all tokens of ``df``. A leaf's stream is its rows once per epoch, each epoch shuffled
    anew by a hash of seed, epoch and ``key``; the leaf gives the longest prefix of its stream that its budget covers,
    at most ``epochs`` epochs. So whole epochs give every row, and only the last, partial one is cut: rows are kept
    while their running tokens fit the rest. Rows that share a key follow one another, in any order. Null names are a
    leaf of their own; null tokens count as 0; a leaf without any tokens gives no rows. Columns of ``df`` named epoch
    give way. An empty table gives no rows.

    The running sums come from per-partition totals, so a leaf that holds most rows is spread over many tasks. Rows are
    shuffled once, with their texts, and written once. The tables of leaves are broadcast only if they measure small.
    """
    names = list(levels)
    size = F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0))
    supplies = df.select(*(c.cast("string").alias(n) for n, c in levels.items()), size.alias("size"))
    leaves = written(supplies.groupBy(*names).agg(F.sum("size").alias("supply")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0))).first()[0]
    plan = leaf_budgets(leaves, names, weights, int(total * budget_share), epochs).where("budget > 0")
    plan = plan.withColumn("whole", F.least(F.expr("budget div supply"), F.lit(epochs)).cast("int"))
    rest = F.when(F.col("whole") < epochs, F.col("budget") - F.col("whole") * F.col("supply")).otherwise(0)
    plan = plan.select(_leaf(F.col(n) for n in names).alias("of"), "whole", rest.cast("long").alias("rest"))
    plan, _ = settle(plan)
    tagged = packed(df, leaf=_leaf(levels.values()), size=size, key=F.coalesce(key.cast("string"), F.lit("")), tie=tie())
    tagged = tagged.join(plan, F.col("leaf") == F.col("of"))
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), "key").cast("binary"))
    rows = laid_out(tagged.withColumns({"shuffled": shuffled, "by": F.col("leaf")}).drop("key", "of"), ["by", "shuffled"])
    group = ["leaf", "rest"]
    placed = running(rows, "size", group, partition_totals(rows, "size", group))
    # the place of the first row of each leaf that its rest does not cover: at most one row per leaf
    stops = placed.where("before + size > rest").groupBy("leaf").agg(F.min("at").alias("stop"))
    stops, _ = settle(stops.select(F.col("leaf").alias("of"), "stop"))
    reached = (F.col("rest") > 0) & (F.col("stop").isNull() | (F.col("at") < F.col("stop")))
    chosen = (
        rows.join(stops, F.col("leaf") == F.col("of"), "left")
        .withColumn("times", F.col("whole") + reached.cast("int"))
        .where("times > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    )
    return unpacked(chosen, df.columns, epoch=F.col("epoch"))


def _leaf(names: Iterable[Column]) -> Column:
    """One text per leaf; null differs from the empty name."""
    return F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), n.cast("string")), F.lit("")) for n in names))
