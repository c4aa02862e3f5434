"""Loading of the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_views(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: load(spark, folder, name) for name in names}


def registry() -> tuple[dict, dict, Callable]:
    """Queries and their SQL by name, both empty, and a decorator that adds to them."""
    queries, oracles = {}, {}

    def query(name: str, oracle: str) -> Callable:
        def register(function: Callable) -> Callable:
            queries[name], oracles[name] = function, oracle
            return function

        return register

    return queries, oracles, query
