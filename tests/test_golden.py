"""The worked cases of the guides: users, products, employees."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from rowmill.operators import delete, execute, insert, select, update
from rowmill.sources import read_sqlite

# The rows that the expected averages and raises below are worked out from.
EMPLOYEES = [
    (1, "Alice Johnson", "Engineering", 95000.0),
    (2, "Bob Smith", "Sales", 75000.0),
    (3, "Charlie Brown", "Engineering", 85000.0),
    (4, "Diana Prince", "Marketing", 80000.0),
]


# The other rows that expected results are known for.
USERS = [(1, "Alice"), (2, "Bob"), (3, "Charlie")]
PRODUCTS = [(1, "Widget", 9.99), (2, "Gadget", 19.99)]


@pytest.fixture
def employees(spark, table):
    name = table()
    df = spark.createDataFrame(EMPLOYEES, "id int, name string, department string, salary double")
    assert insert(name, df, create=True) == 4
    return name


def test_users(spark, table):
    users = table()
    df = spark.createDataFrame(USERS, "id int, name string")
    assert insert(users, df, create=True) == 3
    rows = select(spark.table(users))
    assert rows.count() == 3 and "name" in rows.columns
    assert select(spark.table(users), where="id > 1").count() == 2
    assert select(spark.table(users), where="name = ?", params=["Alice"]).count() == 1


def test_products(spark, table):
    products = table()
    execute(spark, f"CREATE TABLE {products} (id INT, name STRING, price DOUBLE) USING parquet")
    for row in PRODUCTS:
        execute(spark, f"INSERT INTO {products} VALUES (?, ?, ?)", params=list(row))
    assert [r.name for r in execute(spark, f"SELECT * FROM {products} WHERE price > 10").collect()] == ["Gadget"]


def test_products_in_a_sqlite_file(spark, tmp_path):
    path = str(tmp_path / "shop.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE products (id INTEGER, name TEXT, price REAL)")
        db.executemany("INSERT INTO products VALUES (?, ?, ?)", PRODUCTS)
    products = read_sqlite(spark, path, "products")
    assert products.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double")]
    assert [r.name for r in select(products, where="price > 10").collect()] == ["Gadget"]


def test_average_salary(spark, employees):
    rows = execute(
        spark,
        f"SELECT e.department, mean(e.salary) AS mean_pay FROM {employees} e GROUP BY 1 ORDER BY 2 DESC",
    ).collect()
    assert [tuple(r) for r in rows] == [("Engineering", 90000.0), ("Marketing", 80000.0), ("Sales", 75000.0)]


def test_raise_then_delete(spark, employees):
    assert update(employees, {"salary": "salary * 1.1"}, "id = 1", spark=spark) == 1
    assert spark.table(employees).where("id = 1").first().salary == pytest.approx(104500)
    assert delete(employees, "id = 4", spark=spark) == 1
    assert spark.table(employees).count() == 3


def test_empty_insert(spark, employees):
    assert insert(employees, spark.table(employees).where("false")) == 0
    assert spark.table(employees).count() == 4


def test_update_without_values(spark, employees):
    with pytest.raises(ValueError):
        update(employees, {}, spark=spark)


def test_ten_thousand_rows(spark, table):
    name = table()
    df = spark.range(10_000).select(F.col("id"), F.col("id").alias("value"))
    assert insert(name, df, create=True) == 10_000
    assert spark.table(name).agg(F.sum("value")).first()[0] == sum(range(10_000))


def test_literal_row(spark):
    row = execute(spark, "SELECT 'Hello' AS message, ? AS name, 42 AS answer", ["you"]).first()
    assert tuple(row) == ("Hello", "you", 42)
