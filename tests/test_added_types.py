"""Types of files that come in one after the other."""

import os

from rowmill.functions import added, infer_types, infer_types_of_files


def types(df):
    return {r.column_name: r.type for r in df.collect()}


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    path, state, read = str(tmp_path / "files"), str(tmp_path / "state"), []
    real = added.cells_of

    def counting(rows, *rest):
        read.append(len(rows.inputFiles()))
        return real(rows, *rest)

    monkeypatch.setattr(added, "cells_of", counting)
    add = lambda sql: spark.sql(sql).coalesce(1).write.mode("append").parquet(path)
    add("SELECT '1' AS a, '2' AS b, CAST(NULL AS string) AS c")
    assert types(infer_types_of_files(spark, path, state)) == {"a": "bigint", "b": "bigint", "c": "bigint"}
    add("SELECT '1.5' AS a, '7' AS b, 'x' AS c UNION ALL SELECT '2', NULL, NULL")
    assert types(infer_types_of_files(spark, path, state)) == {"a": "double", "b": "bigint", "c": "string"}
    assert types(infer_types_of_files(spark, path, state)) == {"a": "double", "b": "bigint", "c": "string"}
    add("SELECT 'word' AS b, 'only here' AS d")
    found = types(infer_types_of_files(spark, path, state))
    assert found == {"a": "double", "b": "string", "c": "string", "d": "string"} == types(infer_types(spark.read.option("mergeSchema", "true").parquet(path)))
    add("SELECT '1' AS a, '2' AS b WHERE false")
    assert types(infer_types_of_files(spark, path, state)) == found and types(infer_types_of_files(spark, path, state)) == found
    assert read == [1, 1, 1, 1]


def test_changed_and_lost_files(spark, tmp_path):
    path, state = tmp_path / "files", str(tmp_path / "state")
    path.mkdir()
    put = lambda name, text: (path / name).write_text(text)
    look = lambda: types(infer_types_of_files(spark, str(path), state, "mssql", format="csv", header="true"))
    put("one.csv", "a,b\n1,true\n2,false\n")
    put("two with blank.csv", "a,b\n5000000000,true\n")
    assert look() == {"a": "bigint", "b": "boolean"}
    put("one.csv", "a,b\nx,1\n2,false\n3,true\n")
    assert look() == {"a": "string", "b": "string"}
    os.remove(path / "one.csv")
    assert look() == {"a": "bigint", "b": "boolean"}
