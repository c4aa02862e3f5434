import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowmill.functions import apply_types, infer_types, map_types


def types(df, ladder, columns=None, loose=False):
    return {r.column_name: r.type for r in infer_types(df, ladder, columns, loose).collect()}


def whole(text, bits):
    return re.fullmatch(r"[+-]?[0-9]+", text) is not None and -(2 ** (bits - 1)) <= int(text) < 2 ** (bits - 1)


def fraction(text):
    return re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text) is not None


def plain_whole(text, bits):
    return whole(text, bits) and str(int(text)) == text


def plain_fraction(text):
    """Whether the double gives back the digits and the places of the text."""
    if whole(text, 64):
        return plain_whole(text, 64)
    if not fraction(text) or re.match(r"[+.]|-?0[0-9]|-\.", text):
        return False
    head = re.split("[eE]", text)[0]
    if "." not in head:
        return whole(head, 64) and head != text and plain_whole(head, 64)
    behind = head.split(".")[1]
    return behind == "0" or bool(behind) and behind[-1] != "0" and Decimal(repr(float(text))) == Decimal(text)


LADDERS = {
    "sqlite": [("bigint", lambda t: whole(t, 64)), ("double", fraction)],
    "mssql": [
        ("int", lambda t: whole(t, 32)),
        ("bigint", lambda t: whole(t, 64)),
        ("double", fraction),
        ("boolean", lambda t: t.lower() in ("true", "false")),
    ],
}
PLAIN_LADDERS = {
    "sqlite": [("bigint", lambda t: plain_whole(t, 64)), ("double", plain_fraction)],
    "mssql": [
        ("int", lambda t: plain_whole(t, 32)),
        ("bigint", lambda t: plain_whole(t, 64)),
        ("double", plain_fraction),
        ("boolean", lambda t: t.lower() in ("true", "false")),
    ],
}
SAMPLES = [
    ["1.50", "0.1", "100.25", "-0.5", "1.0", "00501", "1e5"],
    ["0.12345678901234567", "123456789.12345678", "0.1234567890123456789"],
    ["1", "-7", "+3", "007"],
    ["2147483647", "-2147483648"],
    ["2147483648", "9223372036854775807"],
    ["9223372036854775808", "18446744073709551615"],
    ["-9223372036854775808", "0000000000000000000000000000000000000000000000007", "00000000000012345678901"],
    ["9" * 50],
    ["1.5", ".5", "2.", "1e10", "-3E-4"],
    ["true", "FALSE"],
    [" 7 ", "7\n", "", "1_000", "0x10", "NaN", "Infinity", "1e", "t", "yes", "word", "1,5"],
]


@pytest.mark.parametrize("loose", [True, False])
@pytest.mark.parametrize("ladder", ["sqlite", "mssql"])
def test_text_ladders_against_brute_force(spark, ladder, loose):
    rng = random.Random(5)
    columns = {"nothing": [None] * 12}
    for i in range(40):
        groups = rng.sample(SAMPLES, rng.choice([1, 1, 2, 3]))
        columns[f"c{i}"] = [rng.choice([None, *rng.choice(groups)]) for _ in range(12)]
    for i, text in enumerate(text for group in SAMPLES for text in group):
        columns[f"one{i}"] = [None] * 11 + [text]
    schema = ", ".join(f"{name} string" for name in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema)
    expected = {
        name: next(
            (kind for kind, fits in (LADDERS if loose else PLAIN_LADDERS)[ladder] if all(fits(v) for v in values if v is not None)), "string"
        )
        for name, values in columns.items()
    }
    assert types(df, ladder, loose=loose) == expected


@pytest.mark.parametrize("ladder,first", [("sqlite", "bigint"), ("mssql", "int"), ("input", "bigint")])
def test_empty_and_null_columns_take_the_first_type(spark, ladder, first):
    df = spark.createDataFrame([(None,), (None,)], "a string")
    assert types(df, ladder) == {"a": first}
    assert types(df.limit(0), ladder) == {"a": first}


def test_unknown_ladder(spark):
    with pytest.raises(ValueError):
        infer_types(spark.createDataFrame([("1",)], "a string"), "oracle")


def test_apply_keeps_every_value(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "true"), (None, "2", None, "FALSE")], "a string, b string, c string, d string")
    out = apply_types(df, infer_types(df, "mssql"))
    assert out.dtypes == [("a", "int"), ("b", "double"), ("c", "string"), ("d", "boolean")]
    assert [tuple(r) for r in out.collect()] == [(1, 1.5, "x", True), (None, 2.0, None, False)]


def test_apply_fails_on_a_value_that_does_not_fit(spark):
    df = spark.createDataFrame([("1",), ("word",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply_types(df, {"a": "bigint"}).collect()


def test_input_ladder_judges_kinds(spark):
    columns = {
        "whole": ["1", "-2", None, "null"],
        "flags": ["true", "false", "3", None],
        "mixed": ["1", "2.5", None, "null"],
        "huge": ["1", "99999999999999999999", None, None],
        "exponent": ["1", "1e3", "true", None],
        "quoted": ["1", '"2"', "2.50", "true"],
        "deep": ["1", '{"a": 1}', "[1, 2]", None],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns))
    df = df.select(*[F.parse_json(c).alias(c) for c in df.columns])
    found = infer_types(df, "input")
    assert {r.column_name: r.type for r in found.collect()} == {
        "whole": "bigint",
        "flags": "bigint",
        "mixed": "double",
        "huge": "double",
        "exponent": "double",
        "quoted": "string",
        "deep": "string",
    }
    rows = apply_types(df, found, "input").collect()
    assert [r.whole for r in rows] == [1, -2, None, None]
    assert [r.flags for r in rows] == [1, 0, 3, None]
    assert [r.mixed for r in rows] == [1.0, 2.5, None, None]
    assert [r.huge for r in rows] == [1.0, 1e20, None, None]
    assert [r.exponent for r in rows] == [1.0, 1000.0, 1.0, None]
    assert [r.quoted for r in rows] == ["1", "2", "2.5", "1"]
    assert [r.deep for r in rows] == ["1", '{"a":1}', "[1,2]", None]


def test_input_ladder_takes_text_as_text(spark):
    df = spark.createDataFrame([("12",), ("plain words",), ("{}",), (None,)], "a string")
    assert types(df, "input") == types(df.limit(1), "input") == {"a": "string"}
    assert [r.a for r in apply_types(df, {"a": "string"}, "input").collect()] == ["12", "plain words", "{}", None]


def test_doubles_are_written_without_exponents(spark):
    values = [1e17, 1e18, 1e19, 1.5e300, 1e-5, 2.5, -0.000123, 1e23, 123456789012345680.0, 0.0, -4.0, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "a double").select(F.to_variant_object(F.struct("a")).alias("v"))
    out = [r.a for r in apply_types(df.select(F.variant_get("v", "$.a", "variant").alias("a")), {"a": "string"}, "input").collect()]
    assert not any("e" in text.lower() for text in out)
    assert [float(text) for text in out] == values
    assert out[:3] == ["1" + "0" * 17, "1" + "0" * 18, "1" + "0" * 19] and out[4] == "0.00001" and out[5] == "2.5" and out[10] == "-4"


def test_one_pass_without_shuffling_rows(spark, capsys):
    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet").selectExpr("cast(p_size AS string) a", "p_name b")
    infer_types(df, "mssql").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    before_shuffle = plan[plan.index("Exchange") :]
    assert "partial_max" in before_shuffle


def test_declared_types(spark):
    df = spark.createDataFrame([("1", "2", "3", "4.5", "5.5", "true", "x")], "a string, b string, c string, d string, e string, f string, g string")
    out = map_types(df, {"a": "SMALLINT", "b": "integer", "c": "Bigint", "d": "REAL", "e": "FLOAT8", "f": "bool", "g": "JSONB"})
    assert [t for _, t in out.dtypes] == ["smallint", "int", "bigint", "float", "double", "boolean", "string"]
    assert tuple(out.first()) == (1, 2, 3, 4.5, 5.5, True, "x")
    with pytest.raises(ValueError):
        map_types(df, {"zz": "INT4"})


def test_wide_tables(spark):
    df = spark.range(50).select(*[F.col("id").cast("string").alias(f"c{i}") if i % 2 else F.lit("x").alias(f"c{i}") for i in range(200)])
    assert types(df, "sqlite") == {f"c{i}": "bigint" if i % 2 else "string" for i in range(200)}
