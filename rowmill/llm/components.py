"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowmill.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node that can be reached.

    Alternating large-star and small-star steps: each hangs the neighbours of a node on the smallest of them. The links
    stay distributed; every step is written to the shared folder. A hub's links are reduced to one minimum per task
    before they are shuffled, and its join is an ordinary one, whose large partitions Spark splits. Links with a null
    end or from a node to itself say nothing. No links give no rows.
    """
    links = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        links = written(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash"), F.sum(F.col("b").cast("decimal(38,0)")).alias("b")
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them (here ``a > b`` in every link)."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.union(smallest.select("a", F.col("m").alias("b"))).distinct()
