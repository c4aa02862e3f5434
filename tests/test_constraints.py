from collections import Counter

import pytest

from rowmill.operators import check_constraints

FAST = ["10485760", "-1"]


@pytest.mark.parametrize("threshold", FAST)
def test_report_against_brute_force(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        # a third of the batch and of the table is one key
        batch = [(1 if i % 3 == 0 else i if i % 7 else None, i % 4 if i % 5 else None, i) for i in range(300)]
        stored = [(1 if i % 3 == 0 else i + 150, i % 4) for i in range(300)]
        df = spark.createDataFrame(batch, "a int, b int, v int")
        table = spark.createDataFrame(stored, "a int, b int")
        got = sorted(
            (tuple(r) for r in check_constraints(table, df, not_null=["a", "v", "b"], key=["a", "b"]).collect()), key=repr
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    expected = []
    for position, column in enumerate(["a", "b"]):
        for key, n in Counter((a, b) for a, b, _ in batch if (a, b)[position] is None).items():
            expected.append(("not_null", column, *key, n))
    counts = Counter((a, b) for a, b, _ in batch if a is not None and b is not None)
    expected += [("unique_in_batch", "a, b", *key, n) for key, n in counts.items() if n > 1]
    expected += [("unique_in_table", "a, b", *key, n) for key, n in counts.items() if key in set(stored)]
    assert got == sorted(expected, key=repr)


def test_only_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    report = check_constraints(df, df, not_null=["a", "b"])
    assert sorted(map(tuple, report.collect())) == [("not_null", "a", 1), ("not_null", "b", 2)]


def test_clean_batch(spark):
    df = spark.range(5).toDF("a")
    assert check_constraints(df.where("a > 10"), df, ["a"], ["a"]).isEmpty()


def test_no_constraint(spark):
    with pytest.raises(ValueError):
        check_constraints(spark.range(1), spark.range(1))
