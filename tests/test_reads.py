import pytest
from pyspark.sql import functions as F

from rowmill.operators import execute, recent, running_total, select


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "Ann", 30, "NYC"), (2, "Bob", None, "NYC"), (3, "O'Neil", 17, "LA"), (4, None, 45, "LA")],
        "id int, name string, age int, city string",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_null_predicate_counts_as_false(people):
    assert ids(select(people, where="age > 18")) == [1, 4]
    assert ids(select(people, where="NOT (age > 18)")) == [3]


def test_positional_and_named_parameters(people):
    assert ids(select(people, where="age > ? AND city = ?", params=[18, "NYC"])) == [1]
    assert ids(select(people, where="name = :name", params={"name": "O'Neil"})) == [3]


def test_parameters_are_values_not_text(people):
    assert ids(select(people, where="name = ?", params=["x' OR '1'='1"])) == []


def test_where_text_may_hold_braces(people):
    assert ids(select(people, where="concat('{', id, '}') = ?", params=["{2}"])) == [2]


def test_columns_are_expressions(people):
    row = select(people, ["id * 2 AS twice", F.upper("name").alias("loud")], where="id = 1").first()
    assert tuple(row) == (2, "ANN")


def test_limit(people):
    assert select(people, limit=2).count() == 2
    assert select(people, limit=0).count() == 0


def test_unknown_keyword_is_an_error(people):
    with pytest.raises(TypeError):
        select(people, where_clause="id = 1")
    with pytest.raises(ValueError):
        select(people, params=[1])


def test_execute_over_registered_tables(spark, people):
    rows = execute(spark, "SELECT id FROM folk WHERE age > :age", {"age": 18}, {"folk": people})
    assert ids(rows) == [1, 4]


def test_views_of_parameter_filters_do_not_stay(spark, people):
    before = {t.name for t in spark.catalog.listTables()}
    select(people, where="id = ?", params=[1]).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_filter_and_columns_reach_the_scan(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    select(df, ["l_orderkey"], where="l_quantity > ?", params=[40]).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(l_quantity,40.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_top_k_is_no_full_sort(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    select(df.orderBy(F.desc("o_totalprice")), limit=5).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_recent(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-10 00:00:00' - make_dt_interval(id) AS ts FROM range(10)")
    newest = df.agg(F.max("ts"))
    assert ids(recent(df, "ts", "7 days", newest)) == list(range(7))
    assert ids(recent(df, "ts", "2 days", F.lit("2024-01-05").cast("timestamp_ntz"))) == list(range(7))
    assert ids(recent(df, "ts", "7 days")) == []


@pytest.mark.parametrize("partitions", ["3", "8"])
def test_running_total_equals_a_plain_window(spark, partitions):
    # one key holds most rows, all at one moment; keys and values may be null
    df = spark.range(3000).selectExpr(
        "id",
        "CASE WHEN id % 3 < 2 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 5) END AS k",
        "CASE WHEN id % 3 < 2 THEN 0 ELSE id % 11 END AS ts",
        "CASE WHEN id % 13 = 0 THEN NULL ELSE cast(id AS decimal(12,2)) END AS v",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = running_total(df, ["k"], ["ts", "id"], F.col("v"), "total").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted = df.selectExpr("*", "sum(v) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS total")
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted.collect()))
