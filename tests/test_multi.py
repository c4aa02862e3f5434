"""One table over several connections whose types differ."""

import uuid

import pytest
from pyspark.sql import types as T

from rowmill.sources import copy_resumable, read_all, read_sqlite, read_table, write_sqlite, write_table
from rowmill.sources.multi import common_type


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a, b, wider",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "decimal(6,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,19)", "decimal(38,19)"),
        ("bigint", "decimal(38,20)", None),
        ("decimal(10,4)", "decimal(8,6)", "decimal(12,6)"),
        ("int", "double", "double"),
        ("int", "float", "double"),
        ("smallint", "float", "float"),
        ("float", "double", "double"),
        ("bigint", "double", None),
        ("decimal(4,1)", "double", None),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("timestamp", "timestamp_ntz", None),
        ("boolean", "string", "string"),
        ("double", "string", "string"),
        ("binary", "string", None),
        ("array<int>", "array<bigint>", None),
        ("void", "int", "int"),
    ],
)
def test_common_types(spark, a, b, wider):
    expected = None if wider is None else kind(wider)
    assert common_type(kind(a), kind(b)) == common_type(kind(b), kind(a)) == expected


def connection(spark, folder, name, sql):
    spark.sql(sql).write.parquet(f"{folder}/{name}/t")
    return name, {"format": "parquet", "path": f"{folder}/{name}"}


def test_types_that_disagree(spark, tmp_path):
    write_sqlite(spark.sql("SELECT 1L AS id, 9007199254740993L AS v, 5L AS w"), str(tmp_path / "files"), "t")
    sources = [
        ("file", {"format": "sqlite", "path": str(tmp_path / "files")}),
        connection(spark, tmp_path, "decimals", "SELECT 2 AS ID, 2.50BD AS v, 2.5BD AS w"),
        connection(spark, tmp_path, "texts", "SELECT 3S AS id, 'three' AS v, 7 AS extra"),
    ]
    df = read_all(spark, sources, "t")
    assert dict(df.dtypes) == {"id": "bigint", "v": "string", "w": "decimal(20,1)", "extra": "int", "source": "string"}
    assert sorted((r.source, r.id, r.v, r.w and float(r.w), r.extra) for r in df.collect()) == [
        ("decimals", 2, "2.50", 2.5, None), ("file", 1, "9007199254740993", 5.0, None), ("texts", 3, "three", None, 7),
    ]


def test_values_that_would_change_are_refused(spark, tmp_path):
    sources = [connection(spark, tmp_path, "a", "SELECT 1L AS v"), connection(spark, tmp_path, "b", "SELECT 1.5D AS v")]
    with pytest.raises(ValueError, match="column v has no common type .* bigint in a, double in b"):
        read_all(spark, sources, "t")
    both = read_all(spark, [*sources, connection(spark, tmp_path, "c", "SELECT 'x' AS v")], "t", columns=["v"])
    assert sorted(r.v for r in both.collect()) == ["1", "1.5", "x"]


def broken_copy(spark, monkeypatch, call, after):
    """Break a copy off while a group is being noted: its rows are written, the manifest does not know it."""
    from rowmill.sources import multi

    real, left = multi.Files.write, [after]

    def write(self, name, text):
        if "done-" in name:
            left[0] -= 1
            if left[0] < 0:
                raise KeyboardInterrupt
        real(self, name, text)

    with monkeypatch.context() as patched:
        patched.setattr(multi.Files, "write", write)
        with pytest.raises(KeyboardInterrupt):
            call()


def test_a_copy_between_files_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    source, target = ({"format": "sqlite", "path": str(tmp_path / name)} for name in ("from", "to"))
    write_sqlite(spark.range(1000).selectExpr("id", "id * 2 AS n").repartition(3), source["path"], "t")

    def call(**more):
        return copy_resumable(
            spark, (source, "t"), (target, "u"), str(tmp_path / "manifest"), columns=["id"], where="id >= :low", params={"low": 100}, num_ranges=9, at_once=2, **more
        )

    part = call(most_groups=1)
    assert 0 < part < 900 and read_sqlite(spark, target["path"], "u").count() == part
    broken_copy(spark, monkeypatch, call, after=1)
    assert read_sqlite(spark, target["path"], "u").count() > part
    assert call() == 900 and call() == 900
    assert sorted(r.id for r in read_sqlite(spark, target["path"], "u").collect()) == list(range(100, 1000))


def test_a_copy_between_databases_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    options = {"url": f"jdbc:derby:memory:copy_{uuid.uuid4().hex};create=true"}
    write_table(spark.range(500).selectExpr("id", "id % 7 AS n"), options, "from_here")

    def call(**more):
        return copy_resumable(spark, (options, "from_here"), (options, "to_there"), str(tmp_path / "manifest"), ["id"], num_ranges=6, at_once=2, **more)

    broken_copy(spark, monkeypatch, call, after=1)
    assert call() == 500
    rows = read_table(spark, options, "to_there").collect()
    assert sorted(r.id for r in rows) == list(range(500))
    with pytest.raises(ValueError, match="no primary key"):
        copy_resumable(spark, (options, "from_here"), (options, "x"), str(tmp_path / "other"))
