import datetime
import sqlite3

import pytest

from rowmill.sources import to_insert_statements

ROWS = [
    (1, "it's", 0.1, True, datetime.date(2024, 1, 2), b"\x00\xff"),
    (-5, 'say "hi"\nthere', 1e300, False, None, b""),
    (None, None, None, None, None, None),
    (7, "", 1.23456789125e8, True, datetime.date(1970, 1, 1), None),
    (8, "ünïcode ☃", -2.5e-7, None, None, b"x"),
    (9, "\\", float("inf"), None, None, None),
]
SCHEMA = "id int, s string, x double, f boolean, d date, b binary"


def statements(df, dialect):
    return [r.stmt for r in to_insert_statements(df, "t", dialect).collect()]


def test_sqlite_accepts_and_returns_every_value(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE t (id INTEGER, s TEXT, x REAL, f BOOLEAN, d DATE, b BLOB)")
    db.executescript("\n".join(statements(df, "sqlite")))
    got = db.execute("SELECT * FROM t ORDER BY rowid").fetchall()
    assert got == [(i, s, x, f, None if d is None else d.isoformat(), b) for i, s, x, f, d, b in ROWS]


def test_dialects(spark):
    df = spark.createDataFrame(ROWS[:1], SCHEMA)
    head = "INSERT INTO t (id, s, x, f, d, b) VALUES "
    assert statements(df, "postgres") == [head + "(1, 'it''s', 0.1, TRUE, '2024-01-02', '\\x00FF');"]
    assert statements(df, "sqlite") == [head + "(1, 'it''s', 0.1, 1, '2024-01-02', X'00FF');"]
    assert statements(df, "mssql") == [head + "(1, N'it''s', 0.1, 1, N'2024-01-02', 0x00FF);"]
    with pytest.raises(ValueError):
        to_insert_statements(df, "t", "oracle")


def test_values_that_are_no_finite_number(spark):
    df = spark.sql("SELECT double('NaN') AS a, double('-Infinity') AS b")
    assert statements(df, "postgres")[0].endswith("('NaN'::double precision, '-Infinity'::double precision);")
    assert statements(df, "sqlite")[0].endswith("(NULL, -9e999);")
    with pytest.raises(Exception, match="cannot store"):
        statements(df, "mssql")


def test_nested_values_are_json_text(spark):
    df = spark.sql("SELECT array(1, 2) AS a, named_struct('k', 'it''s') AS b, CAST(1.50 AS decimal(5,2)) AS c")
    assert statements(df, "postgres")[0].endswith("""('[1,2]', '{"k":"it''s"}', 1.50);""")


def test_dump_is_one_map_only_stage(spark, tmp_path, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    dump = to_insert_statements(df, "orders")
    dump.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan
    dump.write.text(str(tmp_path / "dump"))
    assert spark.read.text(str(tmp_path / "dump")).count() == df.count()


def test_odd_column_names_are_quoted(spark):
    df = spark.sql("SELECT 1 AS `a b`, 2 AS `C\"d]`, 3 AS plain_1")
    assert to_insert_statements(df, "s.t").first().stmt == 'INSERT INTO s.t ("a b", "C""d]", plain_1) VALUES (1, 2, 3);'
    assert to_insert_statements(df, "t", "mssql").first().stmt == 'INSERT INTO t ([a b], [C"d]]], plain_1) VALUES (1, 2, 3);'
