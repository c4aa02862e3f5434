from pyspark.sql import functions as F

from rowmill.shared import ensure_checkpoint_dir, run_folder, settle


def test_the_session_names_the_shared_folder(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = run_folder(spark, "x"), run_folder(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_only_measured_small_sides_are_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        df = spark.range(1000).select("id", F.expr("repeat('x', 1000)").alias("text"))
        assert settle(df)[1]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000000")
        assert not settle(df)[1] and settle(df.select("id"))[1] and settle(df.limit(0))[1]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not settle(df.limit(0))[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_settled_rows_are_all_there(spark):
    settled, _ = settle(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert settled.agg(F.sum("count")).first()[0] == 100
    assert "FileScan parquet" in settled._jdf.queryExecution().executedPlan().toString()
