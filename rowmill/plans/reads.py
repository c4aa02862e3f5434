"""Reads: projection, filter, limit, SQL with parameters, JSON, arrays, aggregates, windows, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions import json_contains
from ..operators import execute, recent, ranked, running_total, select
from .tables import load, load_views, registry

QUERIES, ORACLES, query = registry()


def same_sql(name: str, sql: str, *tables: str) -> None:
    """A query whose Spark SQL text is also its check."""
    QUERIES[name] = lambda spark, folder: execute(spark, sql, tables=load_views(spark, folder, *tables))
    ORACLES[name] = sql


# --- projection, filter, limit, parameters ------------------------------------------------------------------------

_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity * 2 AS double_quantity", "upper(l_returnflag) AS flag"]


@query("project", f"SELECT {', '.join(_LINE_COLUMNS)} FROM lineitem")
def project(spark: SparkSession, folder: str) -> DataFrame:
    return select(load(spark, folder, "lineitem"), _LINE_COLUMNS)


@query(
    "filter",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'",
)
def filter_(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        load(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_shipdate"],
        where="l_quantity > 30 AND l_returnflag = 'R'",
    )


@query(
    "filter_params",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'A'",
)
def filter_params(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        load(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_quantity"],
        where="l_quantity > ? AND l_returnflag = ?",
        params=[45, "A"],
    )


@query("limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def limit(spark: SparkSession, folder: str) -> DataFrame:
    return select(load(spark, folder, "orders").orderBy("o_orderkey"), ["o_orderkey", "o_totalprice"], limit=100)


same_sql(
    "execute",
    """SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS richest
    FROM customer GROUP BY c_mktsegment ORDER BY c_mktsegment""",
    "customer",
)

same_sql("execute_literal", "SELECT count(*) AS n_customers, 42 AS answer, 'hello' AS message FROM customer", "customer")


@query("execute_pos", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'")
def execute_pos(spark: SparkSession, folder: str) -> DataFrame:
    return execute(
        spark,
        "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > ? AND c_mktsegment = ?",
        [5000, "BUILDING"],
        load_views(spark, folder, "customer"),
    )


@query("execute_named", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0 AND c_nationkey <> 7")
def execute_named(spark: SparkSession, folder: str) -> DataFrame:
    return execute(
        spark,
        "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < :floor AND c_nationkey <> :nation",
        {"floor": 0, "nation": 7},
        load_views(spark, folder, "customer"),
    )


@query(
    "chain_filter_sort",
    "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 1000 ORDER BY s_acctbal DESC, s_suppkey",
)
def chain_filter_sort(spark: SparkSession, folder: str) -> DataFrame:
    return (
        load(spark, folder, "supplier")
        .filter(F.col("s_acctbal") > 1000)
        .sort(F.desc("s_acctbal"), "s_suppkey")
        .select("s_suppkey", "s_name", "s_acctbal")
    )


# --- CTE, intervals, JSON, arrays ---------------------------------------------------------------------------------

same_sql(
    "cte",
    """WITH busy AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
    SELECT n, count(*) AS n_users FROM busy GROUP BY n""",
    "events",
)


@query(
    "recent_interval",
    """SELECT event_id, ts, user_id FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def recent_interval(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return recent(events, "ts", "7 days", events.agg(F.max("ts").alias("newest"))).select("event_id", "ts", "user_id")


@query(
    "json_contains",
    """WITH docs AS (
        SELECT event_id, event_type, CAST(props AS JSON) AS props,
            CAST('{"a": ' || props || ', "tags": ["' || event_type || '", ' || CAST(user_id AS VARCHAR) || ']}' AS JSON) AS doc
        FROM events)
    SELECT event_id, 'top' AS match FROM docs WHERE json_extract(props, '$.k') = '69'
    UNION ALL
    SELECT event_id, 'nested' FROM docs WHERE json_extract(doc, '$.a.k') = '7'
        AND (event_type = 'click')
    UNION ALL
    SELECT event_id, 'text is no number' FROM docs WHERE json_type(props, '$.k') = 'VARCHAR'""",
)
def json_contains_(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "events").select(
        "event_id",
        F.try_parse_json("props").alias("props"),
        F.try_parse_json(
            F.concat(
                F.lit('{"a": '), "props", F.lit(', "tags": ["'), "event_type", F.lit('", '), "user_id", F.lit("]}")
            )
        ).alias("doc"),
    )
    tests = {
        "top": json_contains("props", '{"k": 69}'),
        "nested": json_contains("doc", '{"a": {"k": 7}, "tags": ["click"]}'),
        "text is no number": json_contains("props", '{"k": "69"}'),
    }
    # one pass: every test that holds gives a row
    held = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return docs.select("event_id", F.explode(held).alias("match"))


@query(
    "array_ops",
    """SELECT label, count(*) AS n_values, count(CASE WHEN v > 0 THEN 1 END) AS n_positive, max(v) AS largest,
        count(DISTINCT CASE WHEN v > 0.3 THEN vec_id END) AS n_vectors_above
    FROM (SELECT vec_id, label, unnest(embedding) AS v FROM embeddings) GROUP BY label""",
)
def array_ops(spark: SparkSession, folder: str) -> DataFrame:
    # the arrays are folded in place; exploding them would multiply the rows by their length
    per_vector = load(spark, folder, "embeddings").select(
        "label",
        F.size("embedding").alias("n"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("positive"),
        F.array_max("embedding").alias("top"),
        F.exists("embedding", lambda x: x > F.lit(0.3)).alias("above"),
    )
    return per_vector.groupBy("label").agg(
        F.sum("n").alias("n_values"),
        F.sum("positive").alias("n_positive"),
        F.max("top").alias("largest"),
        F.count_if("above").alias("n_vectors_above"),
    )


@query("array_explode", "SELECT vec_id, unnest(embedding) AS value, label FROM embeddings")
def array_explode(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "embeddings").select("vec_id", F.explode("embedding").alias("value"), "label")


# --- aggregates, top-k, windows, joins ----------------------------------------------------------------------------


@query(
    "avg_by_group",
    """SELECT o_orderpriority,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(o_totalprice) AS avg_price
    FROM orders GROUP BY o_orderpriority ORDER BY avg_price DESC""",
)
def avg_by_group(spark: SparkSession, folder: str) -> DataFrame:
    # the sum is exact in decimal, so the result does not depend on the order in which partitions are added
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return (
        load(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg((total / F.count("o_totalprice")).alias("avg_price"))
        .orderBy(F.desc("avg_price"))
    )


same_sql("count_all", "SELECT count(*) AS n FROM lineitem", "lineitem")

same_sql(
    "top_k",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "orders",
)


@query(
    "window",
    """SELECT o_orderpriority, o_orderkey, o_totalprice, place FROM (
        SELECT o_orderpriority, o_orderkey, o_totalprice,
            row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place
        FROM orders) WHERE place <= 10""",
)
def window(spark: SparkSession, folder: str) -> DataFrame:
    # the bound on the rank is also applied before the shuffle, so few rows of a large group reach its task
    highest = W.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return (
        load(spark, folder, "orders")
        .withColumn("place", F.row_number().over(highest))
        .where("place <= 10")
        .select("o_orderpriority", "o_orderkey", "o_totalprice", F.col("place").cast("long").alias("place"))
    )


@query(
    "window_running",
    """SELECT o_orderkey, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (
        PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_price
    FROM orders""",
)
def window_running(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    totals = running_total(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], price, "running_price")
    return totals.select("o_orderkey", "o_orderstatus", F.col("running_price").cast("double").alias("running_price"))


@query(
    "window_ranks",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER w AS place, rank() OVER t AS tied, dense_rank() OVER t AS moment,
        lag(o_totalprice) OVER w AS price_before, lead(o_orderkey) OVER w AS next_order
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey),
        t AS (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE))""",
)
def window_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Places and neighbours in three large groups, each worked on in many pieces."""
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    placed = ranked(
        orders,
        ["o_orderstatus"],
        ["o_orderdate", "o_orderkey"],
        row_number="place",
        lag={"price_before": "o_totalprice"},
        lead={"next_order": "o_orderkey"},
    )
    days = ranked(placed.drop("o_orderdate", "o_totalprice"), ["o_orderstatus"], ["day"], rank="tied", dense_rank="moment")
    return days.drop("day").withColumns({c: F.col(c).cast("long") for c in ("place", "tied", "moment")})


same_sql(
    "report_join",
    """SELECT n_name, count(*) AS n_customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n_name""",
    "customer",
    "nation",
)

# --- any SQL: instances that show what execute reaches ------------------------------------------------------------
# The many orders of one customer are reduced to one row before a join, on the map side, so a hot customer costs little.

same_sql(
    "sql_left_join",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "customer",
    "orders",
)
same_sql(
    "sql_semi_join",
    """SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)""",
    "customer",
    "orders",
)
same_sql(
    "sql_anti_join",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) WHERE o_custkey = c_custkey)""",
    "customer",
    "orders",
)
same_sql(
    "sql_full_join",
    """SELECT s_suppkey, c_custkey FROM supplier FULL OUTER JOIN customer
    ON s_suppkey = c_custkey AND s_nationkey = c_nationkey""",
    "supplier",
    "customer",
)
same_sql("sql_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem", "lineitem")
same_sql(
    "sql_union",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
    "customer",
    "supplier",
)
same_sql(
    "sql_intersect",
    "SELECT DISTINCT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0",
    "orders",
    "customer",
)
same_sql(
    "sql_except",
    "SELECT c_custkey AS k FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'",
    "customer",
    "orders",
)
same_sql(
    "sql_rollup",
    """SELECT l_returnflag, l_linestatus, count(*) AS n,
        CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "lineitem",
)
same_sql(
    "sql_scalar_subquery",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 1.5 * (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) FROM orders)""",
    "orders",
)
same_sql(
    "sql_having",
    """SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM lineitem
    GROUP BY l_suppkey HAVING count(*) > 500""",
    "lineitem",
)
same_sql(
    "sql_case_string",
    """SELECT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
        upper(substring(p_name, 1, 1)) AS initial, count(*) AS n, CAST(min(length(p_name)) AS BIGINT) AS shortest
    FROM part GROUP BY 1, 2""",
    "part",
)
same_sql(
    "sql_dates",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, count(*) AS n,
        max(CAST(o_orderdate AS DATE)) AS last_day
    FROM orders GROUP BY 1, 2""",
    "orders",
)
