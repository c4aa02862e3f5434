"""Database sources and sinks, filled from the input tables by Spark and read back.

The SQLite queries keep their files in the shared folder and work on any cluster that mounts it. The JDBC queries need
a database: set ``spark.rowmill.jdbc.url`` to one that every executor reaches. Without it they use a database inside
the session's own JVM, which exists in local mode only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import apply_types, infer_types
from ..operators import execute
from ..shared import in_one_process, run_folder
from ..sources import (
    copy_resumable,
    copy_table,
    read_all,
    read_query,
    read_sqlite,
    read_table,
    to_insert_statements,
    write_sqlite,
    write_table,
)
from .tables import load, registry

QUERIES, ORACLES, query = registry()

JDBC_URL = "spark.rowmill.jdbc.url"
_TEXT_COLUMNS = {
    "orders": "o_orderstatus VARCHAR(10), o_orderpriority VARCHAR(40)",
    "customer": "c_name VARCHAR(100), c_mktsegment VARCHAR(40)",
}


def jdbc_options(spark: SparkSession) -> dict[str, str]:
    url = spark.conf.get(JDBC_URL, None)
    if not url:
        if not in_one_process(spark):
            raise RuntimeError(f"executors cannot see a database inside the driver: set {JDBC_URL}")
        url = f"jdbc:derby:memory:rowmill_{spark.sparkContext.applicationId};create=true"  # one per session
    return {"url": url, "preferTimestampNTZ": "true"}


def jdbc_copy(spark: SparkSession, folder: str, name: str) -> tuple[dict[str, str], str, int]:
    """The input table ``name`` written to the database by parallel tasks: options, table name, rows written."""
    options = jdbc_options(spark)
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    written = write_table(
        load(spark, folder, name), {**options, "createTableColumnTypes": _TEXT_COLUMNS[name]}, table
    )
    return options, table, written


def sqlite_copy(spark: SparkSession, folder: str, name: str) -> str:
    """The input table ``name`` written to SQLite files by parallel tasks."""
    path = run_folder(spark, f"sqlite-{name}")
    write_sqlite(load(spark, folder, name), path, name)
    return path


@query(
    "scan_jdbc",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def scan_jdbc(spark: SparkSession, folder: str) -> DataFrame:
    options, table, _ = jdbc_copy(spark, folder, "orders")
    orders = read_table(spark, options, table, {"column": "o_orderkey", "num_partitions": 8})
    return orders.where("o_orderstatus = 'F' AND o_totalprice > 100000").select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query(
    "scan_query",
    "SELECT o_custkey AS custkey, count(*) AS n, max(o_totalprice) AS highest FROM orders GROUP BY o_custkey",
)
def scan_query(spark: SparkSession, folder: str) -> DataFrame:
    options, table, _ = jdbc_copy(spark, folder, "orders")
    sql = (
        'SELECT "o_custkey" AS "custkey", CAST(COUNT(*) AS BIGINT) AS "n", MAX("o_totalprice") AS "highest" '
        f'FROM {table} GROUP BY "o_custkey"'
    )
    return read_query(spark, options, sql, {"column": "custkey", "num_partitions": 4})


@query(
    "insert_jdbc",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, (SELECT count(*) FROM customer) AS n_changed FROM customer",
)
def insert_jdbc(spark: SparkSession, folder: str) -> DataFrame:
    options, table, written = jdbc_copy(spark, folder, "customer")
    stored = read_table(spark, options, table, {"column": "c_custkey", "num_partitions": 4})
    return stored.selectExpr("*", f"CAST({written} AS BIGINT) AS n_changed")


@query(
    "insert_jdbc_again",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
        (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS n_changed FROM customer""",
)
def insert_jdbc_again(spark: SparkSession, folder: str) -> DataFrame:
    """An append that an earlier run left half done: the rows already there are not written twice."""
    options, table = jdbc_options(spark), f"customer_{uuid.uuid4().hex[:12]}"
    customer = load(spark, folder, "customer")
    split = {"column": "c_custkey", "num_partitions": 4}
    write_table(
        customer.where("c_acctbal < 0"), {**options, "createTableColumnTypes": _TEXT_COLUMNS["customer"]}, table
    )
    written = write_table(customer, options, table, ["c_custkey"], split)
    return read_table(spark, options, table, split).selectExpr("*", f"CAST({written} AS BIGINT) AS n_changed")


@query(
    "scan_sqlite",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderkey > 100 AND o_orderstatus <> 'P'""",
)
def scan_sqlite(spark: SparkSession, folder: str) -> DataFrame:
    path = sqlite_copy(spark, folder, "orders")
    return read_sqlite(
        spark, path, "orders", where="o_orderkey > ? AND o_orderstatus <> ?", params=[100, "P"], num_partitions=8
    )


@query(
    "scan_sqlite_inferred",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def scan_sqlite_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Every value read as text, the column types found from the values."""
    text = read_sqlite(spark, sqlite_copy(spark, folder, "customer"), "customer", typing="text")
    return apply_types(text, infer_types(text, "sqlite"))


@query(
    "scan_sqlite_keyed",
    """SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders
    WHERE o_orderpriority >= '2-HIGH' AND o_orderpriority < '5-LOW'""",
)
def scan_sqlite_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Files without row ids, in the order of a key of text and number, cut into tasks by it."""
    path, key = run_folder(spark, "sqlite-keyed"), ["o_orderpriority", "o_orderkey"]
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    write_sqlite(orders, path, "orders", key=key)
    where = "o_orderpriority >= ? AND o_orderpriority < ?"
    return read_sqlite(spark, path, "orders", where=where, params=["2-HIGH", "5-LOW"], num_partitions=8)


@query(
    "scan_sqlite_merged",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name, c_acctbal,
        CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
)
def scan_sqlite_merged(spark: SparkSession, folder: str) -> DataFrame:
    """A folder whose files differ in their columns."""
    path, customer = run_folder(spark, "sqlite-merged"), load(spark, folder, "customer")
    write_sqlite(customer.where("c_acctbal < 0").select("c_custkey", "c_acctbal", "c_mktsegment"), path, "customer")
    write_sqlite(customer.where("c_acctbal >= 0").select("c_name", "c_custkey", "c_acctbal"), path, "customer")
    return read_sqlite(spark, path, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


_CLASSES = {
    "id": "c_custkey",
    "code": "CAST(c_nationkey AS {text})",
    "amount": "CASE WHEN c_custkey % 2 = 0 THEN {whole} ELSE {real} END",
    "label": "CASE WHEN c_custkey % 3 = 0 THEN {whole} WHEN c_custkey % 3 = 1 THEN {real} ELSE {words} END",
    "bytes": "{blob}",
    "rare": "CASE WHEN c_custkey = 7 THEN {words} ELSE {whole} END",
    "nothing": "{null}",
}


def _stored_copy(spark: SparkSession, folder: str) -> str:
    """Customers in files whose columns hold whole numbers, reals, text and bytes beside each other."""
    parts = {
        "whole": "CAST(c_nationkey AS variant)",
        "real": "CAST(c_nationkey + 0.5D AS variant)",
        "words": "CAST(c_name AS variant)",
        "blob": "CAST(CAST(c_name AS binary) AS variant)",
        "null": "CAST(NULL AS variant)",
        "text": "string",
    }
    columns = [f"CAST({sql.format(**parts)} AS variant) AS {name}" for name, sql in _CLASSES.items()]
    path = run_folder(spark, "sqlite-classes")
    write_sqlite(load(spark, folder, "customer").selectExpr(*columns), path, "customer")
    return path


@query(
    "infer_stored",
    """SELECT * FROM (VALUES ('id', 'bigint'), ('code', 'string'), ('amount', 'double'), ('label', 'string'), ('bytes', 'binary'),
        ('rare', (SELECT CASE WHEN count(*) > 0 THEN 'string' ELSE 'bigint' END FROM customer WHERE c_custkey = 7)),
        ('nothing', 'bigint')) AS t(column_name, type)""",
)
def infer_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Column types by the classes in which the values are stored: text that looks like a number stays text."""
    return infer_types(read_sqlite(spark, _stored_copy(spark, folder), "customer", typing="stored"), "stored")


@query(
    "scan_sqlite_stored",
    """SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS code,
        CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE c_nationkey + CAST(0.5 AS DOUBLE) END AS amount,
        CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR)
          WHEN c_custkey % 3 = 1 THEN CAST(c_nationkey + CAST(0.5 AS DOUBLE) AS VARCHAR) ELSE c_name END AS label,
        c_name AS bytes, CASE WHEN c_custkey = 7 THEN c_name ELSE CAST(c_nationkey AS VARCHAR) END AS rare,
        CAST(NULL AS BIGINT) AS nothing FROM customer""",
)
def scan_sqlite_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Values in the classes in which they are stored, the columns typed by them."""
    values = read_sqlite(spark, _stored_copy(spark, folder), "customer", typing="stored")
    typed = apply_types(values, infer_types(values, "stored"), "stored")
    return typed.withColumn("bytes", typed["bytes"].cast("string"))


@query(
    "copy_table",
    """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_totalprice > 50000) AS n_changed
    FROM orders WHERE o_totalprice > 50000""",
)
def copy_table_(spark: SparkSession, folder: str) -> DataFrame:
    source = {"format": "sqlite", "path": sqlite_copy(spark, folder, "orders")}
    target = {"format": "sqlite", "path": run_folder(spark, "sqlite-copy")}
    copied = copy_table(
        spark,
        (source, "orders"),
        (target, "big_orders"),
        columns=["o_orderkey", "o_totalprice"],
        source_where="o_totalprice > ?",
        source_params=[50000],
    )
    return read_sqlite(spark, target["path"], "big_orders").selectExpr("*", f"CAST({copied} AS BIGINT) AS n_changed")


@query(
    "copy_restarted",
    """SELECT o_orderkey, o_orderstatus, (SELECT count(*) FROM orders WHERE o_totalprice > 20000) AS n_changed
    FROM orders WHERE o_totalprice > 20000""",
)
def copy_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """A copy that ends early and is called again: each row arrives once."""
    source = {"format": "sqlite", "path": sqlite_copy(spark, folder, "orders")}
    target, manifest = {"format": "sqlite", "path": run_folder(spark, "sqlite-restarted")}, run_folder(spark, "manifest")

    def call(most_groups: int | None) -> int:
        wanted = ["o_orderkey", "o_orderstatus"]
        return copy_resumable(
            spark, (source, "orders"), (target, "orders"), manifest, None, wanted, "o_totalprice > 20000", None, 12, 4, most_groups
        )

    call(1)
    copied = call(None)
    return read_sqlite(spark, target["path"], "orders").selectExpr("*", f"CAST({copied} AS BIGINT) AS n_changed")


@query(
    "read_all",
    """SELECT c_custkey, c_name, c_acctbal, source FROM (
        SELECT *, 'first' AS source FROM customer UNION ALL SELECT *, 'second' FROM customer)
    WHERE c_acctbal > 2500""",
)
def read_all_(spark: SparkSession, folder: str) -> DataFrame:
    sources = [
        (name, {"format": "sqlite", "path": sqlite_copy(spark, folder, "customer")}) for name in ("first", "second")
    ]
    wanted = ["c_custkey", "c_name", "c_acctbal"]
    rows = read_all(spark, sources, "customer", columns=wanted, source_where="c_acctbal > ?", source_params=[2500])
    return rows.select(*wanted, "source")


@query(
    "read_all_mixed",
    """SELECT p_partkey, CASE WHEN source = 'numbers' THEN CAST(p_size AS VARCHAR) ELSE p_brand END AS label,
        CASE WHEN source = 'decimals' THEN p_size / CAST(4 AS DOUBLE) ELSE p_size END AS amount, source
    FROM part, (VALUES ('numbers'), ('texts'), ('decimals')) s(source)""",
)
def read_all_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """One table over connections whose types disagree: whole numbers, decimals and text."""
    part, path = load(spark, folder, "part"), run_folder(spark, "mixed")
    write_sqlite(part.selectExpr("p_partkey", "p_size AS label", "p_size AS amount"), f"{path}/numbers", "part")
    part.selectExpr("p_partkey", "p_brand AS label", "p_size AS amount").write.parquet(f"{path}/texts/part")
    decimals = part.selectExpr("cast(p_partkey AS int) AS p_partkey", "p_brand AS label", "cast(p_size / 4 AS decimal(12, 2)) AS amount")
    decimals.write.parquet(f"{path}/decimals/part")
    sources = [
        ("numbers", {"format": "sqlite", "path": f"{path}/numbers"}),
        ("texts", {"format": "parquet", "path": f"{path}/texts"}),
        ("decimals", {"format": "parquet", "path": f"{path}/decimals"}),
    ]
    return read_all(spark, sources, "part").withColumn("amount", F.col("amount").cast("double"))


@query(
    "report_sources",
    """WITH per_customer AS (
        SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders GROUP BY o_custkey)
    SELECT n_name, CAST(sum(n) AS BIGINT) AS n_orders, CAST(sum(total) AS DOUBLE) AS turnover
    FROM per_customer JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def report_sources(spark: SparkSession, folder: str) -> DataFrame:
    """A join over tables of two connections and a parquet table."""
    tables = {
        "orders": read_sqlite(
            spark, sqlite_copy(spark, folder, "orders"), "orders", ["o_custkey", "o_totalprice"], num_partitions=8
        ),
        "customer": read_sqlite(spark, sqlite_copy(spark, folder, "customer"), "customer", ["c_custkey", "c_nationkey"]),
        "nation": load(spark, folder, "nation"),
    }
    return execute(spark, ORACLES["report_sources"], tables=tables)


@query(
    "sql_dump",
    """SELECT 'INSERT INTO part (p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) VALUES ('
        || p_partkey || ', ''' || replace(p_name, '''', '''''') || ''', ''' || p_brand || ''', ''' || p_type || ''', '
        || p_size || ', ' || p_retailprice || ');' AS stmt
    FROM part""",
)
def sql_dump(spark: SparkSession, folder: str) -> DataFrame:
    return to_insert_statements(load(spark, folder, "part"), "part")


@query(
    "sql_dump_documents",
    """SELECT 'INSERT INTO documents (doc_id, text, lang, source, n_chars) VALUES ('
        || doc_id || ', N''' || replace(text, '''', '''''') || ''', N''' || lang || ''', N''' || source || ''', '
        || n_chars || ');' AS stmt
    FROM documents""",
)
def sql_dump_documents(spark: SparkSession, folder: str) -> DataFrame:
    return to_insert_statements(load(spark, folder, "documents"), "documents", "mssql")


