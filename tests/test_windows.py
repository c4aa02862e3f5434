"""Ranks, numbers and neighbours over hot keys, against plain windows."""

import pytest
from pyspark.sql import Window, functions as F

from rowmill.operators import ranked


@pytest.fixture
def hot(spark):
    """A third of the rows have one key, some have none; the order ties and holds nulls."""
    rows = spark.range(6000).selectExpr(
        "id", "if(id % 3 = 0, 'hot', if(id % 17 = 0, NULL, concat('k', id % 400))) AS k", "if(id % 50 = 7, NULL, id * 7919 % 997) AS t"
    )
    return rows.repartition(11)


def test_against_plain_windows(spark, hot):
    own = ranked(hot, ["k"], ["t", "id"], "n", lag={"before": "t"}, lead={"after": "id", "after t": "t"})
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = hot.select(
        "*", F.row_number().over(w).alias("n"), F.lag("t").over(w).alias("before"), F.lead("id").over(w).alias("after"), F.lead("t").over(w).alias("after t")
    )
    assert own.columns == plain.columns
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))
    tied = ranked(hot, ["k"], ["t"], rank="r", dense_rank="d")
    w = Window.partitionBy("k").orderBy("t")
    plain = hot.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert sorted(map(tuple, tied.collect())) == sorted(map(tuple, plain.collect()))


def test_a_hot_key_is_spread(spark, hot):
    own = ranked(hot, ["k"], ["t", "id"], "n")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = ranked(hot, ["k"], ["t", "id"], "n").where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert own.where("k = 'hot'").count() == 2000
    assert len(pieces) >= 2 and max(r["count"] for r in pieces) <= 2 * 6000 / 8


def test_no_rows_and_no_keys(spark, hot):
    assert ranked(hot.limit(0), ["k"], ["id"], "n").collect() == []
    own = ranked(hot.limit(100), [], ["id"], "n", lag={"before": "id"}).orderBy("n").collect()
    assert [r.n for r in own] == list(range(1, 101)) and [r.before for r in own] == [None, *(r.id for r in own[:-1])]
