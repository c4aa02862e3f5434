"""Tables in buckets of their key, and the Bloom condition of large batches."""

import pytest
from pyspark.sql import functions as F

from rowmill.operators import BUCKET, delete, execute_many, insert, might_hold, update
from rowmill.operators import tables as changes


@pytest.fixture
def wide(spark, table, tmp_path):
    name = table()
    rows = spark.range(4000).selectExpr("id", "concat('n', id) AS name", "id * 2 AS v")
    insert(name, rows, create=True, key=["id"], buckets=64, location=str(tmp_path / name))
    return name


def folders(spark, name):
    return {row.f.rsplit("/", 1)[0] for row in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}


def content(spark, name):
    return sorted(map(tuple, spark.table(name).drop(BUCKET).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_change_by_key_rewrites_one_folder(spark, wide):
    before = folders(spark, wide)
    assert len(before) == 64
    assert update(wide, {"v": "v + 1"}, "id = 77", spark=spark) == 1
    now = folders(spark, wide)
    assert len(before & now) == 63
    assert delete(wide, "id = :id AND name <> 'x'", {"id": 78}, spark) == 1
    assert len(now & folders(spark, wide)) >= 62
    assert content(spark, wide) == [(i, f"n{i}", 2 * i + (i == 77)) for i in range(4000) if i != 78]


def test_a_key_reads_one_bucket(spark, wide):
    target = changes._describe(spark, wide)
    one = changes._in_bucket(target, spark.table(wide).where("id = 77"))
    text = plan(one)
    number = spark.table(wide).where("id = 77").first()[BUCKET]
    assert f"{BUCKET}" in text and f"= {number})" in text.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_a_changed_key_moves_to_its_bucket(spark, wide):
    assert update(wide, {"id": "id + 10000"}, "id < 10", spark=spark) == 10
    assert update(wide, {"v": 0}, "id = 10003", spark=spark) == 1
    assert update(wide, {"v": 0}, "id = 3", spark=spark) == 0
    assert content(spark, wide) == sorted((i + 10000 * (i < 10), f"n{i}", 0 if i == 3 else 2 * i) for i in range(4000))
    with pytest.raises(ValueError, match="cannot be set"):
        update(wide, {BUCKET: 1}, spark=spark)


def test_rows_with_a_bucket_of_their_own_are_put_into_the_right_one(spark, wide):
    insert(wide, spark.sql(f"SELECT 5000L AS id, 'x' AS name, 1L AS v, 99 AS {BUCKET}"))
    assert update(wide, {"v": 2}, "id = 5000", spark=spark) == 1


@pytest.mark.parametrize("key", [["name"], ["id", "name"]])
def test_other_keys(spark, table, tmp_path, key):
    name = table()
    rows = spark.range(50).selectExpr("cast(id AS int) AS id", "if(id = 9, NULL, concat('ü', id)) AS name", "0 AS v")
    insert(name, rows, create=True, key=key, buckets=4, location=str(tmp_path / name))
    assert update(name, {"v": 1}, "name = 'ü7' AND id = 7", spark=spark) == 1
    assert update(name, {"v": 2}, "name IS NULL", spark=spark) == 1
    assert update(name, {"v": 3}, "id IN (1, 2)", spark=spark) == 2
    assert {r.id: r.v for r in spark.table(name).where("v > 0").collect()} == {7: 1, 9: 2, 1: 3, 2: 3}


def test_keys_that_cannot_be_hashed(spark, table, tmp_path):
    with pytest.raises(ValueError, match="buckets need a key"):
        insert(table(), spark.sql("SELECT 1.5D AS x"), create=True, key=["x"], buckets=4)
    with pytest.raises(ValueError, match="buckets need a key"):
        insert(table(), spark.sql("SELECT 1 AS x"), create=True, buckets=4)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_batches_over_buckets(spark, wide, join_kind, kind):
    sets = spark.range(0, 8000, 3).selectExpr(f"cast(id AS {kind}) AS id", "id AS place", "-id AS v")
    assert execute_many(wide, "update", sets, ["id"], "place") == len(range(0, 4000, 3))
    assert execute_many(wide, "delete", sets.where("cast(id AS bigint) % 2 = 0").select("id"), ["id"]) == len(range(0, 4000, 6))
    assert content(spark, wide) == [(i, f"n{i}", -i if i % 3 == 0 else 2 * i) for i in range(4000) if i % 6]


def test_a_batch_too_large_to_broadcast_shuffles_rows_once(spark, table, tmp_path, monkeypatch):
    """Partitioned by something else than the key: touched partitions are found without a join."""
    name = table()
    rows = spark.range(3000).selectExpr("id", "id % 10 AS part", "0L AS v")
    insert(name, rows, create=True, partition_by=["part"], location=str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = {}
    change = changes._change

    def watched(spark, target, matching, moved, marked, result, look_first=False):
        now = spark.table(target.name)
        seen["matching"], seen["marked"] = plan(matching(now)), plan(marked(now))
        return change(spark, target, matching, moved, marked, result, look_first)

    monkeypatch.setattr(changes, "_change", watched)
    try:
        sets = spark.range(0, 3000, 20).selectExpr("id", "id AS place", "1L AS v")  # two partitions
        files = {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}
        assert execute_many(name, "update", sets, ["id"], "place") == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" not in seen["matching"] and "Exchange" not in seen["matching"].split("Subquery")[0]
    assert seen["marked"].count("SortMergeJoin") == 1
    now = {r.f for r in spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files - now) <= 2  # only what was touched was written anew
    assert spark.table(name).where("v = 1").count() == 150 and spark.table(name).count() == 3000


@pytest.mark.parametrize("most_bits", [1 << 27, 1 << 12])
def test_the_condition_lets_every_key_through(spark, most_bits):
    keys = spark.range(0, 20000, 2).selectExpr("id AS k", "concat('x', id) AS t")
    rows = spark.range(20000).selectExpr("id", "concat('x', id) AS name").union(spark.sql("SELECT NULL, NULL"))
    condition = might_hold(keys, [(F.col("id"), F.col("k")), (F.col("name"), F.col("t"))], most_bits)
    through = {r.id for r in rows.where(condition).collect()}
    assert set(range(0, 20000, 2)) <= through and (most_bits < 1 << 20 or len(through) < 10000 * 1.02)
    assert rows.where(might_hold(keys.limit(0), [(F.col("id"), F.col("k"))])).count() == 0
