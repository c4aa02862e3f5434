import glob

import pytest
from pyspark.sql import functions as F

from rowmill.operators import ConstraintViolation, delete, drop, execute_many, insert, recover, update, vacuum

ROWS = [(1, "a", 10, 1.5), (2, "b", None, 2.5), (3, None, 30, None), (4, "d", 40, 4.5)]


@pytest.fixture(params=["plain", "partitioned", "buckets"])
def letters(request, spark, table, tmp_path):
    name = table()
    df = spark.createDataFrame(ROWS, "id int, name string, n int, x double")
    by = ["name"] if request.param == "partitioned" else []
    own = {"key": ["id"], "buckets": 3} if request.param == "buckets" else {}
    insert(name, df, create=True, partition_by=by, location=str(tmp_path / name), **own)
    return name


def content(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("id", "name", "n", "x").collect()), key=lambda r: r[0])


def test_insert_by_name_and_missing_columns(spark, letters):
    assert insert(letters, spark.sql("SELECT 'z' AS name, 9 AS id")) == 1
    assert content(spark, letters)[-1] == (9, "z", None, None)


def test_insert_uses_defaults(spark, table):
    name = table()
    spark.sql(f"CREATE TABLE {name} (id INT, mood STRING DEFAULT 'fine') USING parquet")
    insert(name, spark.sql("SELECT 1 AS id"))
    assert tuple(spark.table(name).first()) == (1, "fine")
    update(name, {"id": "id + 1"}, spark=spark)
    insert(name, spark.sql("SELECT 5 AS id"))
    assert sorted(map(tuple, spark.table(name).collect())) == [(2, "fine"), (5, "fine")]


def test_insert_unknown_column(spark, letters):
    with pytest.raises(Exception, match="nope"):
        insert(letters, spark.sql("SELECT 1 AS id, 2 AS nope"))
    assert content(spark, letters) == ROWS


def test_create_only_if_absent(spark, letters):
    assert insert(letters, spark.sql("SELECT 7 AS id, 'g' AS name"), create=True) == 1
    assert len(content(spark, letters)) == 5


def test_update_leaves_null_predicates_alone(spark, letters):
    assert update(letters, {"x": "x + 1"}, "n < 35", spark=spark) == 2
    assert content(spark, letters) == [(1, "a", 10, 2.5), (2, "b", None, 2.5), (3, None, 30, None), (4, "d", 40, 4.5)]


def test_update_sees_the_old_row(spark, letters):
    assert update(letters, {"id": "n", "n": "id"}, "id = 4", spark=spark) == 1
    assert content(spark, letters)[-1] == (40, "d", 4, 4.5)


def test_update_constants_columns_and_parameters(spark, letters):
    values = {"N": 7, "x": F.col("id") / 2, "name": "'it''s'"}
    assert update(letters, values, "id = :id", {"id": 2}, spark) == 1
    assert content(spark, letters)[1] == (2, "it's", 7, 1.0)


def test_update_all_rows(spark, letters):
    assert update(letters, {"n": 0}, spark=spark) == 4
    assert {r[2] for r in content(spark, letters)} == {0}


def test_update_to_null(spark, letters):
    assert update(letters, {"n": None, "name": F.lit(None)}, "id < 3", spark=spark) == 2
    assert content(spark, letters)[:2] == [(1, None, None, 1.5), (2, None, None, 2.5)]


def test_update_that_does_not_fit_changes_nothing(spark, letters):
    with pytest.raises(Exception):
        update(letters, {"n": "'word'"}, "id = 1", spark=spark)
    assert content(spark, letters) == ROWS


def test_update_unknown_column(spark, letters):
    with pytest.raises(ValueError):
        update(letters, {"nope": 1}, spark=spark)


def test_no_match_writes_nothing(spark, letters, tmp_path):
    assert update(letters, {"n": 1}, "id = 99", spark=spark) == 0
    assert delete(letters, "id = 99", spark=spark) == 0
    assert content(spark, letters) == ROWS
    assert glob.glob(str(tmp_path / letters / "_snapshot-*")) == []


def test_delete_keeps_null_predicates(spark, letters):
    assert delete(letters, "n > 5 AND n < 35", spark=spark) == 2
    assert [r[0] for r in content(spark, letters)] == [2, 4]


@pytest.mark.parametrize("where", [None, "1 = 1", "id IS NOT NULL", F.lit])
def test_delete_everything(spark, letters, where):
    assert delete(letters, F.lit(True) if where is F.lit else where, spark=spark) == 4
    assert content(spark, letters) == []
    assert spark.table(letters).columns and insert(letters, spark.sql("SELECT 1 AS id, 'a' AS name")) == 1
    assert content(spark, letters) == [(1, "a", None, None)]


def test_delete_nothing_by_constant(spark, letters):
    assert delete(letters, "1 = 0", spark=spark) == 0
    assert content(spark, letters) == ROWS


def test_delete_with_parameters(spark, letters):
    assert delete(letters, "name = ? OR id = ?", ["a", 4], spark) == 2
    assert [r[0] for r in content(spark, letters)] == [2, 3]


def test_repeated_changes(spark, letters):
    for step in range(3):
        assert update(letters, {"n": "coalesce(n, 0) + 1"}, "id <= 2", spark=spark) == 2
        assert insert(letters, spark.createDataFrame([(10 + step, "a", step, 0.0)], "id int, name string, n int, x double")) == 1
        assert delete(letters, f"id = {10 + step}", spark=spark) == 1
    assert content(spark, letters) == [(1, "a", 13, 1.5), (2, "b", 3, 2.5), *ROWS[2:]]


def test_failed_writer_loses_to_the_first(spark, letters, monkeypatch):
    from rowmill.operators import tables

    real = tables._describe
    calls = []

    def moved_meanwhile(session, name, **how):
        found = real(session, name, **how)
        calls.append(name)
        if len(calls) == 3:  # the check just before the swap
            found.location += "/elsewhere"
        return found

    monkeypatch.setattr(tables, "_describe", moved_meanwhile)
    with pytest.raises(RuntimeError, match="written to meanwhile"):
        update(letters, {"n": 0}, "id = 1", spark=spark)
    monkeypatch.undo()
    assert content(spark, letters) == ROWS


# --- partitions ---------------------------------------------------------------------------------------------------


@pytest.fixture
def parted(spark, table, tmp_path):
    name = table()
    df = spark.range(40).selectExpr(
        "id", "cast(id % 4 AS int) AS p", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('a/b:c=%', id % 5) END AS q"
    )
    insert(name, df, create=True, partition_by=["p", "q"], location=str(tmp_path / name))
    return name


def pairs(spark, name):
    return sorted(map(tuple, spark.table(name).select("id", "p", "q").collect()))


def test_only_touched_partitions_are_rewritten(spark, parted):
    before = {f for f in spark.table(parted).inputFiles() if "p=1" not in f}
    assert update(parted, {"id": "id + 100"}, "p = 1", spark=spark) == 10
    after = {f for f in spark.table(parted).inputFiles() if "p=1" not in f}
    assert before == after
    assert sum(r[0] >= 100 for r in pairs(spark, parted)) == 10


def test_odd_partition_values(spark, parted):
    expected = [(i, i % 4, None if i % 5 == 0 else f"a/b:c=%{i % 5}") for i in range(40)]
    assert pairs(spark, parted) == expected
    assert delete(parted, "q IS NULL AND p = 0", spark=spark) == 2
    expected = [r for r in expected if not (r[2] is None and r[1] == 0)]
    assert pairs(spark, parted) == expected
    assert update(parted, {"id": "-id"}, "q = 'a/b:c=%3'", spark=spark) == 8
    expected = sorted((-i, p, q) if q == "a/b:c=%3" else (i, p, q) for i, p, q in expected)
    assert pairs(spark, parted) == expected


def test_emptied_partition_does_not_come_back(spark, parted):
    assert delete(parted, "p = 2", spark=spark) == 10
    assert not any(r[0].startswith("p=2") for r in spark.sql(f"SHOW PARTITIONS {parted}").collect())
    assert insert(parted, spark.sql("SELECT 1000L AS id, 2 AS p, 'a/b:c=%1' AS q")) == 1
    assert [r for r in pairs(spark, parted) if r[1] == 2] == [(1000, 2, "a/b:c=%1")]


def test_insert_into_a_moved_partition(spark, parted):
    update(parted, {"id": "id + 100"}, "p = 1", spark=spark)
    assert insert(parted, spark.sql("SELECT 7L AS id, 1 AS p, 'a/b:c=%1' AS q UNION ALL SELECT 8, 9, 'new'")) == 2
    assert [r for r in pairs(spark, parted) if r[0] < 100 and r[1] in (1, 9)] == [(7, 1, "a/b:c=%1"), (8, 9, "new")]
    assert len(pairs(spark, parted)) == 42


def test_rows_move_between_partitions(spark, parted):
    assert update(parted, {"p": "p + 1"}, "p >= 2", spark=spark) == 20
    expected = sorted((i, i % 4 + (i % 4 >= 2), None if i % 5 == 0 else f"a/b:c=%{i % 5}") for i in range(40))
    assert pairs(spark, parted) == expected


def test_date_partitions(spark, table):
    name = table()
    insert(name, spark.sql("SELECT id, DATE '2024-01-01' + cast(id % 3 AS int) AS d FROM range(9)"), create=True, partition_by=["d"])
    assert delete(name, "d = DATE '2024-01-02' OR id = 0", spark=spark) == 4
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3, 5, 6, 8]


def test_vacuum(spark, parted, tmp_path):
    for _ in range(2):
        update(parted, {"id": "id + 100"}, "p = 1", spark=spark)
    delete(parted, "p = 3", spark=spark)
    rows = pairs(spark, parted)
    folders = glob.glob(str(tmp_path / parted / "_snapshot-*"))
    assert len(folders) == 3
    assert vacuum(parted, spark) >= 1
    assert pairs(spark, parted) == rows
    assert len(glob.glob(str(tmp_path / parted / "_snapshot-*"))) < 3
    assert vacuum(parted, spark) == 0


def test_moving_to_empty_text_keeps_the_rows_of_null(spark, parted):
    # both lie in the partition of NULL
    assert update(parted, {"q": "''"}, "q = 'a/b:c=%1'", spark=spark) == 8
    expected = [(i, i % 4, None if i % 5 < 2 else f"a/b:c=%{i % 5}") for i in range(40)]
    assert pairs(spark, parted) == expected


def test_tables_that_cannot_be_changed(spark, table):
    name = table()
    spark.sql(f"CREATE TABLE {name} (id INT) USING parquet CLUSTERED BY (id) INTO 2 BUCKETS")
    assert insert(name, spark.sql("SELECT 1 AS id")) == 1
    with pytest.raises(ValueError, match="bucketed"):
        delete(name, spark=spark)
    spark.range(3).createOrReplaceTempView("just_a_view")
    with pytest.raises(ValueError, match="no table"):
        delete("just_a_view", spark=spark)
    spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    try:
        name = table()
        spark.sql(f"CREATE TABLE {name} (id INT, p INT) USING parquet PARTITIONED BY (p)")
    finally:
        spark.conf.unset("spark.sql.hive.manageFilesourcePartitions")
    with pytest.raises(ValueError, match="catalog"):
        update(name, {"id": 1}, spark=spark)


def test_only_touched_partitions_are_read(spark, parted, monkeypatch):
    from rowmill.operators import tables

    seen = []
    real = tables._in_partitions

    def spy(target, touched):
        condition = real(target, touched)
        plan = spark.table(parted).where(condition)._jdf.queryExecution().executedPlan().toString()
        seen.append((len(touched), plan))
        return condition

    monkeypatch.setattr(tables, "_in_partitions", spy)
    update(parted, {"id": "id + 100"}, "p = 1", spark=spark)
    touched, plan = seen[0]
    assert touched == 5 and "InMemoryFileIndex(5 paths)" in plan


# --- batch changes ------------------------------------------------------------------------------------------------


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_set_wins_and_all_sets_count(spark, letters, join_kind):
    sets = spark.createDataFrame(
        [(1, 3, 111, "x"), (1, 1, 100, "w"), (1, 2, 105, "v"), (4, 4, None, "u"), (9, 5, 1, "t"), (None, 6, 1, "s")],
        "id int, pos int, n int, name string",
    )
    assert execute_many(letters, "update", sets, ["id"], "pos") == 4
    assert content(spark, letters) == [(1, "x", 111, 1.5), ROWS[1], ROWS[2], (4, "u", None, 4.5)]


def test_a_set_touches_every_row_with_its_key(spark, table, join_kind):
    name = table()
    insert(name, spark.sql("SELECT if(id < 700, 1, id) AS k, id AS v FROM range(1000)"), create=True)
    sets = spark.sql("SELECT if(id < 300, 1L, id + 300) AS k, id AS pos, -id AS v FROM range(1000)")
    expected_hits = 300 * 700 + sum(1 for i in range(300, 1000) if 700 <= i + 300 < 1000)
    assert execute_many(name, "update", sets, ["k"], "pos") == expected_hits
    got = sorted(map(tuple, spark.table(name).collect()))
    last = {(1 if i < 300 else i + 300): -i for i in range(1000)}
    assert got == sorted((1 if i < 700 else i, last.get(1 if i < 700 else i, i)) for i in range(1000))


def test_composite_keys(spark, letters):
    sets = spark.sql("SELECT 1 AS id, 'a' AS name, 0 AS pos, 5 AS n UNION ALL SELECT 2, 'a', 1, 6 UNION ALL SELECT 3, NULL, 2, 7")
    assert execute_many(letters, "update", sets, ["id", "name"], "pos") == 1
    assert content(spark, letters)[0] == (1, "a", 5, 1.5)


def test_delete_many(spark, letters, join_kind):
    sets = spark.sql("SELECT cast(k AS int) AS id FROM VALUES (1), (1), (4), (9), (NULL) AS t(k)")
    assert execute_many(letters, "delete", sets, ["id"]) == 2
    assert content(spark, letters) == ROWS[1:3]


def test_insert_many(spark, letters):
    assert execute_many(letters, "insert", spark.sql("SELECT 5 AS id, 'e' AS name UNION ALL SELECT 6, 'f'")) == 2
    assert len(content(spark, letters)) == 6


def test_batch_changes_refuse_what_has_no_meaning(spark, letters):
    sets = spark.sql("SELECT 1 AS id, 2 AS n")
    with pytest.raises(ValueError, match="ordinal"):
        execute_many(letters, "update", sets, ["id"])
    with pytest.raises(ValueError, match="key"):
        execute_many(letters, "update", sets, ordinal="n")
    with pytest.raises(ValueError, match="at least one column"):
        execute_many(letters, "update", sets.select("id"), ["id"], "id")
    with pytest.raises(ValueError, match="kind"):
        execute_many(letters, "merge", sets, ["id"])


# --- constraints --------------------------------------------------------------------------------------------------


def test_checked_insert_is_all_or_nothing(spark, letters):
    good = spark.sql("SELECT 5 AS id, 'e' AS name")
    assert insert(letters, good, not_null=["name"], key=["id"]) == 1
    for bad in ("SELECT 6 AS id, 'f' AS name UNION ALL SELECT 6, 'g'", "SELECT 5 AS id, 'x' AS name", "SELECT 7 AS id, NULL AS name"):
        with pytest.raises(ConstraintViolation) as refused:
            insert(letters, spark.sql(bad), not_null=["name"], key=["id"])
        assert refused.value.violations.count() == 1
    assert len(content(spark, letters)) == 5


@pytest.mark.parametrize(
    "storage", ["csv OPTIONS (header 'true', sep '|')", "json OPTIONS (compression 'gzip')", "parquet OPTIONS (compression 'gzip')", "orc"]
)
def test_storage_options_hold_after_a_change(spark, table, storage):
    name = table()
    spark.sql(f"CREATE TABLE {name} (id INT, v STRING) USING {storage}")
    insert(name, spark.sql("SELECT cast(id AS INT) AS id, concat('v', id) AS v FROM range(0, 6, 1, 2)"))
    assert update(name, {"v": "concat(v, '|!')"}, "id = 2", spark=spark) == 1
    assert delete(name, "id = 3", spark=spark) == 1
    expected = [(i, f"v{i}|!" if i == 2 else f"v{i}") for i in (0, 1, 2, 4, 5)]
    assert sorted(tuple(r) for r in spark.table(name).collect()) == expected
    assert all("gz" in f for f in spark.table(name).inputFiles()) == ("gzip" in storage)


def test_formats_that_are_not_tested_are_refused(spark, table):
    name = table()
    spark.sql(f"CREATE TABLE {name} (v STRING) USING text")
    with pytest.raises(ValueError, match="stored as text"):
        update(name, {"v": "'x'"}, spark=spark)


def test_lengths_of_text_columns(spark, table):
    name = table()
    spark.sql(f"CREATE TABLE {name} (a VARCHAR(3), b CHAR(2), c INT) USING parquet")
    insert(name, spark.sql("SELECT 'ab' AS a, 'x' AS b, 1 AS c"))
    with pytest.raises(Exception, match="longer than varchar"):
        update(name, {"a": "'toolong'"}, spark=spark)
    assert update(name, {"a": "'abc  '", "b": "'y'"}, "c = 1", spark=spark) == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [("abc", "y ", 1)]


@pytest.mark.parametrize("by", [[], ["p"]])
def test_rows_that_come_in_between_are_not_lost(spark, table, monkeypatch, by):
    from rowmill.operators import tables

    name = table()
    insert(name, spark.sql("SELECT id, id % 2 AS p FROM range(10)"), create=True, partition_by=by)
    real = tables.Observation

    class Late(real):
        """Another writer adds a row after the scan began."""

        @property
        def get(self):
            spark.sql(f"INSERT INTO {name} SELECT 100 AS id, 1 AS p")
            return super().get

    monkeypatch.setattr(tables, "Observation", Late)
    with pytest.raises(RuntimeError, match="written to meanwhile"):
        update(name, {"id": "id + 1000"}, "p = 1", spark=spark)
    monkeypatch.undo()
    assert sorted(r.id for r in spark.table(name).collect()) == [*range(10), 100]


def test_one_change_at_a_time(spark, table):
    from rowmill.operators import tables

    name = table()
    insert(name, spark.range(3), create=True)
    target = tables._describe(spark, name)
    with tables._changing(spark, target):
        for change in (
            lambda: insert(name, spark.range(1)),
            lambda: delete(name, spark=spark),
            lambda: update(name, {"id": "1"}, spark=spark),
            lambda: vacuum(name, spark),
        ):
            with pytest.raises(RuntimeError, match="another change"):
                change()
    assert delete(name, "id = 1", spark=spark) == 1
    tables._Files(spark, target.root).create(target.root + tables._MARKER, "lost")  # its process is gone
    assert recover(name, spark) is False
    assert insert(name, spark.range(1)) == 1


@pytest.mark.parametrize("stop_after", range(5))
def test_a_swap_that_breaks_off_is_finished(spark, table, monkeypatch, stop_after):
    from rowmill.operators import tables

    name = table()
    rows = "SELECT id, id % 3 AS p FROM range(12)"
    insert(name, spark.sql(rows), create=True, partition_by=["p"])
    real, calls = spark.sql, []

    def breaking(text, *args, **kwargs):
        if text.startswith(f"ALTER TABLE {name}"):
            calls.append(text)
            if len(calls) > stop_after:
                raise OSError("the catalog is gone")
        return real(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", breaking)
    with pytest.raises(OSError):
        # partition 0 is emptied, 1 is rewritten, 7 is new
        update(name, {"id": "id + 100", "p": "CASE p WHEN 0 THEN 7 ELSE p END"}, "p < 2 OR id = 2", spark=spark)
    monkeypatch.undo()
    assert delete(name, "id = 105", spark=spark) == 0 or stop_after >= 0
    expected = sorted((i + 100 if i % 3 < 2 or i == 2 else i, 7 if i % 3 == 0 else i % 3) for i in range(12))
    after = sorted(tuple(r) for r in spark.table(name).collect())
    assert after in (expected, [r for r in expected if r[0] != 105])
    assert not tables._Files(spark, tables._describe(spark, name).root).read(tables._describe(spark, name).root + tables._INTENT)


def test_ordinals_must_order_the_sets(spark, letters):
    rows = sorted(tuple(r) for r in spark.table(letters).collect())
    for sets in ("SELECT 1 AS id, 5 AS n, NULL AS place", "SELECT 1 AS id, id AS n, 3 AS place FROM range(2)"):
        with pytest.raises(ValueError, match="NULL or repeated"):
            execute_many(letters, "update", spark.sql(sets), ["id"], "place")
    assert sorted(tuple(r) for r in spark.table(letters).collect()) == rows


@pytest.mark.parametrize("by", [[], ["p"]])
def test_vacuum_and_drop_free_everything(spark, table, tmp_path, by):
    name, root = table(), tmp_path / "files"
    insert(name, spark.sql("SELECT id, id % 2 AS p FROM range(10)"), create=True, partition_by=by, location=str(root))
    first = glob.glob(f"{root}/**/*.parquet", recursive=True)
    update(name, {"id": "id + 1"}, spark=spark)
    assert vacuum(name, spark) >= 1
    assert not set(first) & set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1, 11))
    drop(name, spark)
    assert not root.exists()
    assert insert(name, spark.range(2), create=True, location=str(root)) == 2


def test_checked_batches_are_inserted_as_checked(spark, table):
    name = table()
    insert(name, spark.sql("SELECT 1L AS id"), create=True)
    batch = spark.range(50).select((F.rand() * 1e9).cast("long").alias("id")).distinct()
    seen = insert(name, batch, key=["id"], not_null=["id"])
    assert spark.table(name).count() == seen + 1


def test_predicates_with_braces_and_views_of_the_caller(spark, letters):
    from rowmill.operators import execute

    assert update(letters, {"id": "id"}, "'{view}' = ? AND id = 1", ["{view}"], spark) >= 0
    spark.range(3).createOrReplaceTempView("mine")
    assert execute(spark, "SELECT count(*) AS n FROM mine JOIN other USING (id)", tables={"mine": spark.range(1), "other": spark.range(1)}).first().n == 1
    assert spark.table("mine").count() == 3 and not spark.catalog.tableExists("other")
    spark.catalog.dropTempView("mine")
