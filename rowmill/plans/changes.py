"""Table changes: each query builds a Spark table from the input, changes it and returns it as it is afterwards.

``n_changed`` is the count the change reported.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import BUCKET, check_constraints, delete, execute, execute_many, insert, update
from ..shared import run_folder
from .tables import load, registry

QUERIES, ORACLES, query = registry()

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def fresh_table(df: DataFrame, partition_by: Sequence[str] = (), key: Sequence[str] = (), buckets: int | None = None) -> str:
    """A new Spark table with the rows of ``df``, its files in the shared folder."""
    name = f"changes_{uuid.uuid4().hex}"
    location = run_folder(df.sparkSession, name)
    insert(name, df, create=True, partition_by=partition_by, location=location, key=key, buckets=buckets)
    return name


def after(spark: SparkSession, table: str, changed: int) -> DataFrame:
    return spark.table(table).withColumn("n_changed", F.lit(changed).cast("long"))


@query(
    "insert",
    f"""SELECT {_ORDERS}, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS n_changed FROM (
        SELECT {_ORDERS} FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, NULL, NULL, NULL FROM orders WHERE o_orderstatus <> 'F')""",
)
def insert_(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    table = fresh_table(orders.where("o_orderstatus = 'F'"))
    batch = orders.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey", "o_orderstatus")
    return after(spark, table, insert(table, batch))


@query(
    "update",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 1.1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
        CASE WHEN o_orderstatus = 'P' THEN o_orderpriority || '!' ELSE o_orderpriority END AS o_orderpriority,
        (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS n_changed
    FROM orders""",
)
def update_(spark: SparkSession, folder: str) -> DataFrame:
    table = fresh_table(load(spark, folder, "orders"))
    values = {"o_totalprice": "o_totalprice * 1.1", "o_orderpriority": "concat(o_orderpriority, '!')"}
    return after(spark, table, update(table, values, "o_orderstatus = ?", ["P"], spark))


@query(
    "update_old_row",
    """SELECT event_id, ts, CASE WHEN value > 10 THEN event_id ELSE user_id END AS user_id, event_type, value,
        CASE WHEN value > 10 THEN CAST(user_id AS VARCHAR) ELSE props END AS props,
        (SELECT count(*) FROM events WHERE value > 10) AS n_changed
    FROM (SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
        props FROM events) events""".replace(
        "(SELECT count(*) FROM events WHERE value > 10)",
        "(SELECT count(*) FROM events WHERE value > 10 AND event_type <> 'error')",
    ),
)
def update_old_row(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").withColumn("value", F.expr("if(event_type = 'error', NULL, value)"))
    table = fresh_table(events)
    return after(spark, table, update(table, {"user_id": "event_id", "props": "user_id"}, "value > 10", spark=spark))


@query(
    "update_partitioned",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
        CASE WHEN o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS o_orderpriority,
        o_orderstatus, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS n_changed
    FROM orders""",
)
def update_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Rows move to another partition and leave an empty one behind."""
    table = fresh_table(load(spark, folder, "orders"), ["o_orderpriority"])
    changed = update(table, {"o_orderpriority": "'2-HIGH'"}, "o_orderpriority = '1-URGENT'", spark=spark)
    return after(spark, table, changed)


@query(
    "update_keyed",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (7, 64) THEN 0 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice,
        o_orderdate, o_orderpriority, (SELECT count(*) FROM orders WHERE o_orderkey IN (7, 64)) AS n_changed
    FROM orders WHERE o_orderkey <> 33""",
)
def update_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Changes by key of a table in buckets: each rewrites the key's bucket."""
    table = fresh_table(load(spark, folder, "orders"), key=["o_orderkey"], buckets=16)
    changed = sum(update(table, {"o_custkey": 0}, "o_orderkey = ?", [key], spark) for key in (7, 64))
    delete(table, "o_orderkey = 33", spark=spark)
    return after(spark, table, changed).drop(BUCKET)


@query(
    "delete",
    f"""SELECT {_ORDERS}, (SELECT count(*) FROM orders WHERE o_totalprice > 200000 AND o_orderstatus <> 'O') AS n_changed
    FROM (SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS o_totalprice) FROM orders)
    WHERE NOT coalesce(o_totalprice > 200000, false)""",
)
def delete_(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").withColumn(
        "o_totalprice", F.expr("if(o_orderstatus = 'O', NULL, o_totalprice)")
    )
    table = fresh_table(orders)
    return after(spark, table, delete(table, "o_totalprice > ?", [200000], spark))


@query(
    "delete_partitioned",
    f"""SELECT {_ORDERS}, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 1000) AS n_changed
    FROM orders WHERE NOT (o_orderstatus = 'P' OR o_totalprice < 1000)""",
)
def delete_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    table = fresh_table(load(spark, folder, "orders"), ["o_orderstatus"])
    return after(spark, table, delete(table, "o_orderstatus = 'P' OR o_totalprice < 1000", spark=spark))


# every order is a parameter set for the customer it names; the latest order wins
@query(
    "execute_many",
    """WITH sets AS (
        SELECT o_custkey, count(*) AS n, max_by(o_totalprice, o_orderkey) AS price, max_by(o_orderstatus, o_orderkey) AS status
        FROM orders GROUP BY o_custkey)
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN n IS NULL THEN c_acctbal ELSE price END AS c_acctbal,
        CASE WHEN n IS NULL THEN c_mktsegment ELSE status END AS c_mktsegment,
        (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS n_changed
    FROM customer LEFT JOIN sets ON o_custkey = c_custkey""",
)
def execute_many_(spark: SparkSession, folder: str) -> DataFrame:
    table = fresh_table(load(spark, folder, "customer"))
    sets = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").alias("position"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderstatus").alias("c_mktsegment"),
    )
    return after(spark, table, execute_many(table, "update", sets, ["c_custkey"], "position"))


@query(
    "execute_many_delete",
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey,
        (SELECT count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) AS n_changed
    FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def execute_many_delete(spark: SparkSession, folder: str) -> DataFrame:
    table = fresh_table(load(spark, folder, "customer"), ["c_nationkey"])
    sets = load(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return after(spark, table, execute_many(table, "delete", sets, ["c_custkey"]))


@query(
    "execute_many_keyed",
    """WITH sets AS (SELECT o_custkey, count(*) AS n, max_by(o_totalprice, o_orderkey) AS price FROM orders
        WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN n IS NULL THEN c_acctbal ELSE price END AS c_acctbal, c_mktsegment,
        (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT') AS n_changed
    FROM customer LEFT JOIN sets ON o_custkey = c_custkey""",
)
def execute_many_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of keyed changes over a table in buckets."""
    table = fresh_table(load(spark, folder, "customer"), key=["c_custkey"], buckets=8)
    urgent = load(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    sets = urgent.selectExpr("o_custkey AS c_custkey", "o_orderkey AS position", "o_totalprice AS c_acctbal")
    return after(spark, table, execute_many(table, "update", sets, ["c_custkey"], "position")).drop(BUCKET)


# stored: the finished orders. batch: the urgent finished orders again, all other orders, the pending ones twice and
# with the customer missing, and the orders of low priority without a key
_BATCH = """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT NULL, o_custkey FROM orders WHERE o_orderpriority = '5-LOW'"""


@query(
    "constraint_check",
    f"""WITH batch AS ({_BATCH}), given AS (
        SELECT o_orderkey, count(*) AS n_rows FROM batch WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)
    SELECT 'not_null' AS "constraint", 'o_custkey' AS "columns", o_orderkey, count(*) AS n_rows FROM batch
        WHERE o_custkey IS NULL GROUP BY o_orderkey
    UNION ALL SELECT 'not_null', 'o_orderkey', NULL, count(*) FROM batch WHERE o_orderkey IS NULL
    UNION ALL SELECT 'unique_in_batch', 'o_orderkey', o_orderkey, n_rows FROM given WHERE n_rows > 1
    UNION ALL SELECT 'unique_in_table', 'o_orderkey', o_orderkey, n_rows FROM given
        WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def constraint_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders")
    stored = fresh_table(orders.where("o_orderstatus = 'F'"))
    batch = execute(spark, _BATCH, tables={"orders": orders})
    return check_constraints(stored, batch, not_null=["o_orderkey", "o_custkey"], key=["o_orderkey"])
