"""Random sequences of changes, with another database running the same statements."""

import random
import sqlite3

import pytest

from rowmill.operators import delete, execute_many, insert, update

COLUMNS = ["id", "g", "a", "b"]
PREDICATES = [
    "a > 5", "NOT (a > 5)", "g = 'x'", "g <> 'x'", "g IS NULL", "a IS NOT NULL AND b < 40", "a = b OR id % 3 = 0",
    "a + b > 60", "id IN (1, 2, 30)", "g = 'x' AND a < 20", "coalesce(a, 0) < coalesce(b, 0)", "id < 0", None,
]
ASSIGNMENTS = [
    {"a": "a + 1"}, {"a": "b", "b": "a"}, {"g": "'y'"}, {"g": "NULL"}, {"a": "id * 2", "g": "'z'"}, {"b": "coalesce(a, 7)"},
]


@pytest.mark.parametrize("seed,by", [(1, []), (2, ["g"]), (3, ["g"])])
def test_random_changes(spark, table, seed, by):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["x", "y", "q'1", None]), rng.choice([None, rng.randrange(50)]), rng.randrange(50)) for i in range(60)]
    schema = "id int, g string, a int, b int"
    name = table()
    insert(name, spark.createDataFrame(rows, schema), create=True, partition_by=by)
    other = sqlite3.connect(":memory:")
    other.execute("CREATE TABLE t (id INTEGER, g TEXT, a INTEGER, b INTEGER)")
    other.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)

    for step in range(12):
        kind = rng.choice(["insert", "update", "update", "delete", "many", "many delete"])
        if kind == "insert":
            new = [(100 + step, rng.choice(["x", "w", None]), rng.randrange(50), None)]
            count = insert(name, spark.createDataFrame(new, schema))
            expected = other.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", new).rowcount
        elif kind == "update":
            values, where = rng.choice(ASSIGNMENTS), rng.choice(PREDICATES)
            count = update(name, values, where, spark=spark)
            sets = ", ".join(f"{column} = {value}" for column, value in values.items())
            expected = other.execute(f"UPDATE t SET {sets}" + (f" WHERE {where}" if where else "")).rowcount
        elif kind == "delete":
            where = rng.choice(PREDICATES[:-1])
            where = f"({where}) AND id % 4 = 1"
            count = delete(name, where, spark=spark)
            expected = other.execute(f"DELETE FROM t WHERE {where}").rowcount
        elif kind == "many":
            sets = [(rng.choice([None, rng.randrange(70)]), pos, rng.randrange(100), rng.choice(["x", "v", None])) for pos in range(20)]
            df = spark.createDataFrame(sets, "id int, pos int, b int, g string").repartition(3)
            count = execute_many(name, "update", df, ["id"], "pos")
            expected = sum(other.execute("UPDATE t SET b = ?, g = ? WHERE id = ?", (b, g, i)).rowcount for i, _, b, g in sets)
        else:
            keys = [(rng.choice([None, rng.randrange(70)]),) for _ in range(5)] * 2
            count = execute_many(name, "delete", spark.createDataFrame(keys, "id int"), ["id"])
            expected = sum(other.execute("DELETE FROM t WHERE id = ?", key).rowcount for key in keys)
        assert count == expected, (step, kind)
        got = sorted(map(tuple, spark.table(name).select(*COLUMNS).collect()), key=repr)
        assert got == sorted(other.execute("SELECT id, g, a, b FROM t").fetchall(), key=repr), (step, kind)
