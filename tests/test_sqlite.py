import glob
import os
import sqlite3
from contextlib import closing

import pytest
from pyspark.sql import functions as F

from rowmill.functions import apply_types, infer_types
from rowmill.sources import read_all, read_sqlite, write_sqlite
from rowmill.sources.sqlite import database_files


@pytest.fixture
def make(tmp_path):
    def create(*statements, rows=None, name="x.db"):
        path = str(tmp_path / name)
        with sqlite3.connect(path) as db:
            for statement in statements:
                db.execute(statement)
            if rows:
                db.executemany(f"INSERT INTO t VALUES ({', '.join('?' * len(rows[0]))})", rows)
        return path

    return create


def test_parallel_read_covers_each_row_once(spark, make):
    path = make("CREATE TABLE t (id INTEGER, v REAL)", rows=[(i, i / 2) for i in range(1000)])
    df = read_sqlite(spark, path, "t", num_partitions=7)
    assert df.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, df.collect())) == [(i, i / 2) for i in range(1000)]


@pytest.mark.parametrize("ids", [[-5, 0, 7], [-(2**63), 5, 2**63 - 1], [3], list(range(10)) + [10**12]])
def test_sparse_and_extreme_row_ids(spark, make, ids):
    path = make("CREATE TABLE t (id INTEGER PRIMARY KEY, s TEXT)", rows=[(i, str(i)) for i in ids])
    df = read_sqlite(spark, path, "t", num_partitions=4)
    assert sorted(r.id for r in df.collect()) == sorted(ids)
    assert df.rdd.getNumPartitions() <= 4


def test_tables_without_row_ids(spark, make):
    path = make(
        "CREATE TABLE t (k TEXT PRIMARY KEY, v INTEGER) WITHOUT ROWID",
        "CREATE VIEW big AS SELECT k, v FROM t WHERE v > 1",
        "CREATE TABLE empty (a INTEGER)",
        "CREATE TABLE odd (rowid TEXT, _rowid_ TEXT, v INTEGER)",
        "INSERT INTO odd VALUES ('a', 'b', 1), ('c', 'd', 2)",
        rows=[("a", 1), ("b", 2), ("c", 3)],
    )
    assert sorted(map(tuple, read_sqlite(spark, path, "t", num_partitions=3).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(r.k for r in read_sqlite(spark, path, "big", num_partitions=3).collect()) == ["b", "c"]
    assert read_sqlite(spark, path, "empty").collect() == []
    assert sorted(map(tuple, read_sqlite(spark, path, "odd", num_partitions=2).collect())) == [("a", "b", 1), ("c", "d", 2)]


def test_declared_types_and_nulls(spark, make):
    path = make(
        "CREATE TABLE t (i INT, s VARCHAR(9), r DOUBLE, b BLOB, f BOOLEAN, d DATE, ts TIMESTAMP, n DECIMAL(9,2), x)",
        rows=[
            (1, "a'b", 0.1, b"\x00\xff", 1, "2024-02-29", "2024-02-29 12:30:00.5", 12, "anything"),
            (None,) * 9,
        ],
    )
    df = read_sqlite(spark, path, "t")
    assert [t for _, t in df.dtypes] == [
        "bigint", "string", "double", "binary", "boolean", "date", "timestamp_ntz", "double", "string",
    ]
    first, second = sorted(df.collect(), key=lambda r: r.i is None)
    assert first.asDict()["b"] == b"\x00\xff" and first.f is True and first.n == 12.0
    assert str(first.d) == "2024-02-29" and str(first.ts) == "2024-02-29 12:30:00.500000"
    assert tuple(second) == (None,) * 9


def test_a_value_of_another_kind_is_an_error_and_text_typing_reads_it(spark, make):
    rows = [(1, "1.5"), ("word", 2), (3, None), (0.1 + 0.2, "x")]
    path = make("CREATE TABLE t (a INTEGER, b)", rows=rows)
    with pytest.raises(Exception, match="typing="):
        read_sqlite(spark, path, "t").collect()
    text = read_sqlite(spark, path, "t", typing="text")
    assert sorted(r.a for r in text.collect()) == sorted(["1", "word", "3", repr(0.1 + 0.2)])
    found = infer_types(text.where("a <> 'word'"), "sqlite")
    assert {r.column_name: r.type for r in found.collect()} == {"a": "double", "b": "string"}
    assert sorted(r.a for r in apply_types(text.where("a <> 'word'"), found).collect()) == sorted([1.0, 3.0, 0.1 + 0.2])


def test_conditions_run_in_sqlite(spark, make):
    # the value that cannot be read shows that SQLite leaves its row out
    rows = [(i, f"n{i % 3}", i / 4 if i % 5 else None) for i in range(100)] + [(100, "bad", "no number")]
    path = make("CREATE TABLE t (id INTEGER, s TEXT, v REAL)", rows=rows)
    given = read_sqlite(spark, path, "t", where="id < ? AND s = ? OR id = 99", params=[10, "n1"], num_partitions=3)
    assert sorted(r.id for r in given.collect()) == [1, 4, 7, 99]
    with pytest.raises(Exception, match="typing="):
        read_sqlite(spark, path, "t", where="id > 90").collect()


def test_filters_of_one_query_do_not_reach_another(spark, make):
    path = make("CREATE TABLE t (id INTEGER, s TEXT, v REAL)", rows=[(i, f"n{i % 3}", i / 4 if i % 5 else None) for i in range(100)])
    df = read_sqlite(spark, path, "t", num_partitions=3)
    low, high = df.where("id < 10"), df.where("id >= 90 AND s = 'n1'")
    assert low.count() == 10 and df.count() == 100 and high.count() == 3
    assert low.union(high).count() == 13
    assert df.where("v IS NULL").count() == 20 and df.where("v > 24 OR id = 0").count() == 4


def test_column_list_limits_the_query(spark, make):
    path = make("CREATE TABLE t (id INTEGER, s TEXT, bad INTEGER)", rows=[(1, "a", "no number"), (2, "b", "either")])
    assert sorted(map(tuple, read_sqlite(spark, path, "t", columns=["s", "id"]).collect())) == [("a", 1), ("b", 2)]


def test_write_and_read_back(spark, tmp_path):
    df = spark.range(100).selectExpr(
        "id", "cast(id AS int) AS i", "if(id % 3 = 0, NULL, concat('it''s ', id)) AS s", "id / 7 AS r", "id % 2 = 0 AS f",
        "DATE '2024-01-01' + cast(id AS int) AS d", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 8) AS ts",
        "unhex(hex(id)) AS b",
    )
    path = str(tmp_path / "out")
    assert write_sqlite(df.repartition(3), path, "t") == 100
    assert len(glob.glob(path + "/*.db")) == len(os.listdir(path)) == 3
    back = read_sqlite(spark, path, "t", num_partitions=6)
    assert back.rdd.getNumPartitions() >= 6
    key = lambda r: r[0]
    assert sorted(map(tuple, back.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)
    assert write_sqlite(df, path, "t") == 100
    assert read_sqlite(spark, path, "t").count() == 200


def test_instants_are_stored_in_utc(spark, tmp_path):
    path = str(tmp_path / "instants")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT 1L AS id, TIMESTAMP '2024-07-01 08:00:00' AS ts UNION ALL SELECT 2, NULL")
        write_sqlite(df.coalesce(1), path, "t")
        with sqlite3.connect(glob.glob(path + "/*.db")[0]) as db:
            assert [r[0] for r in db.execute("SELECT ts FROM t ORDER BY id")] == ["2024-07-01 12:00:00.000000", None]
        back = spark.read.schema("id long, ts timestamp").format("sqlite").option("path", path).option("table", "t").load()
        assert back.exceptAll(df).isEmpty() and back.count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_that_are_none(spark, make):
    path = make("CREATE TABLE t (d DATE)", rows=[("2024-01-01",), ("yesterday",)])
    with pytest.raises(Exception, match="typing="):
        read_sqlite(spark, path, "t").collect()
    path = make("CREATE TABLE t (d TIMESTAMP)", rows=[(1704067200,)], name="epochs.db")
    with pytest.raises(Exception, match="typing="):
        read_sqlite(spark, path, "t").collect()


def test_empty_write_keeps_the_schema(spark, tmp_path):
    path = str(tmp_path / "none")
    assert write_sqlite(spark.sql("SELECT 1L AS a, 'x' AS b WHERE false"), path, "t") == 0
    assert read_sqlite(spark, path, "t").dtypes == [("a", "bigint"), ("b", "string")]


def test_failed_write_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "failed")
    df = spark.range(0, 40, 1, 4).select(F.expr("if(id = 39, cast(raise_error('stop') AS bigint), id)").alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_sqlite(df, path, "t")
    assert glob.glob(path + "/*.db") == []


def test_unsupported_places_and_modes(spark, make, tmp_path):
    path = make("CREATE TABLE t (a INTEGER)")
    with pytest.raises(Exception, match="mounted file system"):
        read_sqlite(spark, "s3://bucket/x.db", "t")
    with pytest.raises(Exception, match="no SQLite database"):
        read_sqlite(spark, str(tmp_path / "absent"), "t")
    with pytest.raises(Exception, match="no table"):
        read_sqlite(spark, path, "absent")
    with pytest.raises(Exception, match="appends"):
        spark.range(1).write.format("sqlite").mode("overwrite").option("path", path).option("table", "t").save()
    with pytest.raises(Exception, match="no column type"):
        write_sqlite(spark.sql("SELECT array(1) AS a"), str(tmp_path / "arrays"), "t")


def test_read_all_with_different_columns(spark, make):
    one = make("CREATE TABLE t (id INTEGER, a TEXT)", rows=[(1, "x"), (2, "y")], name="one.db")
    two = make("CREATE TABLE t (id INTEGER, b REAL)", rows=[(2, 0.5), (3, 1.5)], name="two.db")
    sources = [("one", {"format": "sqlite", "path": one}), ("two", {"format": "sqlite", "path": two})]
    rows = read_all(spark, sources, "t", "id >= ?", [2]).collect()
    assert sorted((r.source, r.id, r.a, r.b) for r in rows) == [("one", 2, "y", None), ("two", 2, None, 0.5), ("two", 3, None, 1.5)]


def test_the_source_file_is_not_changed(spark, make):
    path = make("CREATE TABLE t (a INTEGER)", rows=[(1,), (2,)])
    before = os.stat(path).st_mtime_ns
    read_sqlite(spark, path, "t").collect()
    assert os.stat(path).st_mtime_ns == before and not glob.glob(path + "-*")


def test_small_files_share_tasks_and_large_files_are_split(spark, tmp_path):
    path = str(tmp_path / "many")
    df = spark.range(0, 20_000, 1, 10).selectExpr("id", "repeat('x', 20) AS s")
    write_sqlite(df, path, "t")
    size = os.path.getsize(glob.glob(path + "/*.db")[0])
    use = spark.read.format("sqlite").option("path", path).option("table", "t")
    for per_task, tasks in ((100 * size, [1]), (3 * size + size // 2, [4]), (size // 2, range(20, 31))):
        read = use.option("bytesPerPartition", str(per_task)).load()
        assert read.rdd.getNumPartitions() in tasks
        assert read.count() == 20_000 and read.select("id").distinct().count() == 20_000


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_files_of_a_folder_may_differ_in_columns(spark, tmp_path, order, monkeypatch):
    from rowmill.sources import sqlite as source

    tables = ["CREATE TABLE t (a INTEGER)", 'CREATE TABLE t (A INTEGER, "odd b" TEXT)']
    rows = ["INSERT INTO t VALUES (1)", "INSERT INTO t VALUES (2, 'x')"]
    for k, which in enumerate(order):
        connection = sqlite3.connect(tmp_path / f"{k}.db")
        connection.execute(tables[which])
        connection.execute(rows[which])
        connection.commit()
        connection.close()
    for limit in (64, 1):  # looked up here, or by a job
        monkeypatch.setattr(source, "FILES_FOR_A_JOB", limit)
        found = read_sqlite(spark, str(tmp_path), "t")
        assert [c.lower() for c in found.columns] == ["a", "odd b"]
        assert sorted((r[0], r[1]) for r in found.collect()) == [(1, None), (2, "x")]
    only = read_sqlite(spark, str(tmp_path), "t", columns=["odd b"])
    assert sorted(str(r[0]) for r in only.collect()) == ["None", "x"]


def test_conflicting_columns_are_refused(spark, tmp_path):
    write_sqlite(spark.sql("SELECT 1 AS a"), str(tmp_path), "t")
    with pytest.raises(ValueError, match="column a is"):
        write_sqlite(spark.sql("SELECT 'x' AS a"), str(tmp_path), "t")
    connection = sqlite3.connect(tmp_path / "z.db")
    connection.execute("CREATE TABLE t (a TEXT)")
    connection.close()
    with pytest.raises(ValueError, match="column a is"):
        read_sqlite(spark, str(tmp_path), "t")
    assert read_sqlite(spark, str(tmp_path), "t", typing="text").first().a == "1"


def test_conditions_and_columns_reach_the_files(spark, tmp_path, monkeypatch):
    """SQLite gets the two columns and the condition."""
    from rowmill.sources import copy_table, read_all
    from rowmill.sources import sqlite as source

    write_sqlite(spark.sql("SELECT id, id * 2 AS n, 'x' AS unused FROM range(10)"), str(tmp_path / "from"), "t")
    src = {"format": "sqlite", "path": str(tmp_path / "from")}
    asked = []
    real = source.read_sqlite
    monkeypatch.setattr(source, "read_sqlite", lambda *a, **k: asked.append(a[3:]) or real(*a, **k))
    dst = {"format": "sqlite", "path": str(tmp_path / "to")}
    assert copy_table(spark, (src, "t"), (dst, "t"), columns=["id", "n"], source_where="n > ?", source_params=[10]) == 4
    rows = read_all(spark, [("one", src)], "t", columns=["id"], source_where="id = ?", source_params=[3])
    assert [tuple(r) for r in rows.collect()] == [(3, "one")]
    assert asked == [(["id", "n"], "n > ?", [10]), (["id"], "id = ?", [3])]
    assert "Filter (" not in rows._jdf.queryExecution().executedPlan().toString()


def test_ranges_are_even_in_spite_of_far_row_ids(spark, tmp_path):
    path = str(tmp_path / "far.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT)")
        ids = [*range(10_000), 10**9, *range(10**15, 10**15 + 2000)]
        db.executemany("INSERT INTO t VALUES (?, 'x')", [(i,) for i in ids])
    df = read_sqlite(spark, path, "t", num_partitions=8)
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == len(ids) and max(sizes) <= 2 * len(ids) / 8
    assert sorted(r.id for r in df.collect()) == ids


def test_values_keep_their_stored_class(spark, tmp_path):
    path = str(tmp_path / "classes.db")
    columns = "whole INTEGER, loose, code TEXT, mixed, wide, bytes BLOB, some, none"
    rows = [
        (1, 1, "12", 1, 2**53 + 1, b"\x01", b"12", None),
        (-5, 2.5, "007", "12", 0.5, b"", 12, None),
        (None, None, None, 3.0, None, None, "12", None),
        (2**63 - 1, -7, "", None, 1, b"ab", None, None),
    ]
    with closing(sqlite3.connect(path)) as connection:
        connection.execute(f"CREATE TABLE t ({columns})")
        connection.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
        connection.commit()
    values = read_sqlite(spark, path, "t", typing="stored")
    assert {kind for _, kind in values.dtypes} == {"variant"}
    types = {r.column_name: r.type for r in infer_types(values, "stored").collect()}
    assert types == {
        "whole": "bigint", "loose": "double", "code": "string", "mixed": "string", "wide": "string", "bytes": "binary",
        "some": "variant", "none": "bigint",
    }
    typed = apply_types(values, types, "stored").drop("some").collect()
    assert [tuple(r) for r in typed] == [
        (1, 1.0, "12", "1", "9007199254740993", b"\x01", None),
        (-5, 2.5, "007", "12", "0.5", b"", None),
        (None, None, None, "3.0", None, None, None),
        (2**63 - 1, -7.0, "", None, "1", b"ab", None),
    ]
    kinds = [r[0] for r in values.selectExpr("schema_of_variant(some)").collect()]
    assert kinds == ["BINARY", "BIGINT", "STRING", None]


def test_variants_are_stored_in_their_class(spark, tmp_path):
    folder = str(tmp_path / "files")
    values = ["1", "2.5", '"7"', "true", "null", '{"a": [1, "b"]}', None, "1e300", "9007199254740993"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, json string").selectExpr("id", "parse_json(json) AS v")
    assert write_sqlite(df.coalesce(1), folder, "t") == 9
    with closing(sqlite3.connect(database_files(folder)[0])) as connection:
        stored = connection.execute("SELECT typeof(v), v FROM t ORDER BY id").fetchall()
    assert stored == [
        ("integer", 1), ("real", 2.5), ("text", "7"), ("integer", 1), ("null", None), ("text", '{"a":[1,"b"]}'), ("null", None),
        ("real", 1e300), ("integer", 9007199254740993),
    ]
    back = read_sqlite(spark, folder, "t", ["v"], "id <> ?", [5], typing="stored").selectExpr("to_json(v)")
    assert [r[0] for r in back.collect()] == ["1", "2.5", '"7"', "1", None, None, "1.0E300", "9007199254740993"]


def test_a_limit_reaches_the_file(spark, tmp_path):
    folder = str(tmp_path / "files")
    write_sqlite(spark.range(1000).repartition(4), folder, "t")
    few = read_sqlite(spark, folder, "t", where="id >= ?", params=[500], limit=7, num_partitions=4)
    rows = [r.id for r in few.collect()]
    assert len(rows) == len(set(rows)) == 7 and min(rows) >= 500
    assert read_sqlite(spark, folder, "t", limit=5000).count() == 1000
    assert read_sqlite(spark, folder, "t", limit=0).collect() == []
    with pytest.raises(ValueError, match="unknown typing"):
        read_sqlite(spark, folder, "t", typing="other")


@pytest.mark.parametrize("rows", [90_000, 400_000])
@pytest.mark.parametrize("kind", ["text", "pair", "blob"])
def test_tables_without_row_ids_are_split_evenly(spark, make, rows, kind):
    """Half of the keys lie close together; keys of any type."""
    values = {
        "text": lambda i: (f"a{i:09d}" if i % 2 else f"é{i * 977 % rows}", None),
        "pair": lambda i: (i % 3 if i % 2 else f"k{i % 5}", i),
        "blob": lambda i: (i.to_bytes(4, "little"), None),
    }[kind]
    key = "a, b" if kind == "pair" else "a"
    path = make(f"CREATE TABLE t (a NOT NULL, b, v INTEGER, PRIMARY KEY ({key})) WITHOUT ROWID", rows=[(*values(i), i) for i in range(rows)])
    df = read_sqlite(spark, path, "t", ["v"], num_partitions=4)
    sizes = df.rdd.glom().map(lambda part: (len(part), sum(r.v for r in part))).collect()
    assert len(sizes) == 4 and max(n for n, _ in sizes) <= 1.7 * rows / 4
    assert sum(n for n, _ in sizes) == rows and sum(v for _, v in sizes) == rows * (rows - 1) // 2


def test_views_are_split_by_the_columns_given(spark, make, monkeypatch):
    from rowmill.sources import sqlite as source

    monkeypatch.setattr(source, "KEYS_PER_STEP", 50)
    rows = [(i % 40 if i % 9 else None, None if i % 11 == 0 else str(i % 7), i) for i in range(1000)]
    path = make("CREATE TABLE t (a, b, v INTEGER)", "CREATE VIEW w AS SELECT a, b, v FROM t WHERE v >= 100", rows=None)
    with closing(sqlite3.connect(path)) as db:
        db.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
        db.commit()
    whole = read_sqlite(spark, path, "w", ["v"], num_partitions=5)
    assert whole.rdd.getNumPartitions() == 1
    for by in (["a"], ["a", "b"], ["b", "v"]):
        df = read_sqlite(spark, path, "w", ["v"], num_partitions=5, split_by=by)
        assert df.rdd.getNumPartitions() > 3
        assert sorted(r.v for r in df.collect()) == list(range(100, 1000)), by


def test_a_named_load_takes_the_place_of_an_earlier_one(spark, tmp_path):
    folder = str(tmp_path / "files")
    write_sqlite(spark.range(5), folder, "t")
    assert write_sqlite(spark.range(100, 110).repartition(3), folder, "t", load="day-1") == 10
    assert write_sqlite(spark.range(100, 120).repartition(2), folder, "t", load="day-1") == 20
    assert write_sqlite(spark.range(200, 201), folder, "t", load="day-10") == 1
    assert sorted(r.id for r in read_sqlite(spark, folder, "t").collect()) == [*range(5), *range(100, 120), 200]
    with pytest.raises(ValueError, match="load's name"):
        write_sqlite(spark.range(1), folder, "t", load="../x")


def test_keyed_files(spark, tmp_path, monkeypatch):
    from rowmill.sources import sqlite as source

    folder = str(tmp_path / "files")
    rows = spark.range(1000).selectExpr("concat('k', id % 9) AS k", "id", "id * 2 AS n")
    assert write_sqlite(rows.coalesce(1), folder, "t", key=["k", "id"]) == 1000
    monkeypatch.setattr(source, "KEYS_PER_STEP", 20)
    df = read_sqlite(spark, folder, "t", num_partitions=4)
    sizes = df.rdd.glom().map(len).collect()
    assert len(sizes) == 4 and max(sizes) <= 300
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(Exception, match="UNIQUE|NOT NULL"):
        write_sqlite(rows.coalesce(1), str(tmp_path / "bad"), "t", key=["k"])
