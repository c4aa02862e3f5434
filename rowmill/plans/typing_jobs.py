"""Typing jobs: inference over text and JSON columns, declared-type mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import apply_types, infer_types, infer_types_of_files, map_types
from ..shared import run_folder
from .tables import load

QUERIES = {}
ORACLES = {}

_LINE_TEXT = {
    "orderkey": "l_orderkey",
    "linenumber": "l_linenumber",
    "price": "l_extendedprice",
    "flag": "l_returnflag",
    "nothing": "NULL",
    "big_on_return": "CASE WHEN l_returnflag = 'R' THEN 5000000000 ELSE l_orderkey END",
    "late": "l_shipdate > TIMESTAMP '1998-01-01 00:00:00'",
    "mixed": "CASE WHEN l_linenumber = 7 THEN CAST(l_discount AS {text}) ELSE CAST(l_linenumber AS {text}) END",
    "padded": "lpad(CAST(l_linenumber AS {text}), 5, '0')",
    "word_on_seven": "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_linenumber AS {text}) END",
}
# numbers that give their text back: no leading zeros, no sign but a minus, no zeros at the end of a fraction
_WHOLE = "regexp_full_match({c}, '0|-?[1-9][0-9]*')"
_FRACTION = "regexp_full_match({c}, '-?(0|[1-9][0-9]*)(\\.(0|[0-9]*[1-9]))?([eE][+-]?[0-9]+)?')"
_CHECKS = {
    "int": f"({_WHOLE} AND TRY_CAST({{c}} AS INTEGER) IS NOT NULL)",
    "bigint": f"({_WHOLE} AND TRY_CAST({{c}} AS BIGINT) IS NOT NULL)",
    "double": _FRACTION,
    "boolean": "lower({c}) IN ('true', 'false')",
}


def _line_text(spark: SparkSession, folder: str) -> DataFrame:
    columns = [f"CAST({sql.format(text='string')} AS string) AS {name}" for name, sql in _LINE_TEXT.items()]
    return load(spark, folder, "lineitem").selectExpr(*columns)


def _ladder_oracle(rungs: list[str]) -> str:
    columns = ", ".join(f"CAST({sql.format(text='VARCHAR')} AS VARCHAR) AS {name}" for name, sql in _LINE_TEXT.items())
    rows = []
    for name in _LINE_TEXT:
        verdict = " ".join(
            f"WHEN coalesce(bool_and({name} IS NULL OR {_CHECKS[rung].format(c=name)}), true) THEN '{rung}'"
            for rung in rungs
        )
        rows.append(f"SELECT '{name}' AS column_name, CASE {verdict} ELSE 'string' END AS type FROM t")
    return f"WITH t AS (SELECT {columns} FROM lineitem) " + " UNION ALL ".join(rows)


QUERIES["infer_sqlite"] = lambda spark, folder: infer_types(_line_text(spark, folder), "sqlite")
ORACLES["infer_sqlite"] = _ladder_oracle(["bigint", "double"])

QUERIES["infer_mssql"] = lambda spark, folder: infer_types(_line_text(spark, folder), "mssql")
ORACLES["infer_mssql"] = _ladder_oracle(["int", "bigint", "double", "boolean"])


def infer_added(spark: SparkSession, folder: str) -> DataFrame:
    """Types over files that come in one after the other; each is read once."""
    path, state, text = run_folder(spark, "typed-files"), run_folder(spark, "typing-state"), _line_text(spark, folder)
    for part in ("linenumber < 4", "linenumber BETWEEN 4 AND 6", "linenumber = 7"):
        text.where(part.replace("linenumber", "CAST(linenumber AS int)")).write.mode("append").parquet(path)
        types = infer_types_of_files(spark, path, state)
    return types


QUERIES["infer_added"] = infer_added
ORACLES["infer_added"] = ORACLES["infer_sqlite"]


def apply_inferred(spark: SparkSession, folder: str) -> DataFrame:
    text = _line_text(spark, folder).select("orderkey", "linenumber", "price", "flag", "big_on_return", "mixed", "padded")
    return apply_types(text, infer_types(text, "sqlite"))


QUERIES["apply_types"] = apply_inferred
ORACLES["apply_types"] = """
    SELECT l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS linenumber, l_extendedprice AS price,
        l_returnflag AS flag, CASE WHEN l_returnflag = 'R' THEN 5000000000 ELSE l_orderkey END AS big_on_return,
        CASE WHEN l_linenumber = 7 THEN l_discount ELSE CAST(l_linenumber AS DOUBLE) END AS mixed,
        lpad(CAST(l_linenumber AS VARCHAR), 5, '0') AS padded
    FROM lineitem"""

# JSON values per event: the number in props, a mix of whole and fractional numbers, numbers with some text, flags
_EVENT_JSON = {
    "k": "{k}",
    "whole_or_fraction": "CASE WHEN event_type = 'error' THEN {k} ELSE CAST(value AS {text}) END",
    "number_or_text": "CASE WHEN event_type = 'error' THEN '\"' || event_type || '\"' ELSE {k} END",
    "flag_or_whole": "CASE WHEN event_type = 'error' THEN 'true' ELSE {k} END",
    "object": "props",
    "nothing": "CAST(NULL AS {text})",
}


def _event_json(spark: SparkSession, folder: str) -> DataFrame:
    k = "get_json_object(props, '$.k')"
    columns = [
        f"try_parse_json({sql.format(k=k, text='string')}) AS {name}" for name, sql in _EVENT_JSON.items()
    ]
    return load(spark, folder, "events").selectExpr("event_id", *columns)


def infer_input(spark: SparkSession, folder: str) -> DataFrame:
    return infer_types(_event_json(spark, folder), "input", list(_EVENT_JSON))


def _input_oracle() -> str:
    k = "CAST(json_extract(props, '$.k') AS VARCHAR)"
    columns = ", ".join(
        f"json_type(CAST({sql.format(k=k, text='VARCHAR')} AS JSON)) AS {name}" for name, sql in _EVENT_JSON.items()
    )
    whole = "{c} IS NULL OR {c} IN ('NULL', 'BIGINT', 'UBIGINT', 'BOOLEAN')"
    rows = [
        f"SELECT '{name}' AS column_name, CASE WHEN bool_and({whole.format(c=name)}) THEN 'bigint' "
        f"WHEN bool_and({whole.format(c=name)} OR {name} = 'DOUBLE') THEN 'double' ELSE 'string' END AS type FROM t"
        for name in _EVENT_JSON
    ]
    return f"WITH t AS (SELECT {columns} FROM events) " + " UNION ALL ".join(rows)


QUERIES["infer_input"] = infer_input
ORACLES["infer_input"] = _input_oracle()


def apply_input(spark: SparkSession, folder: str) -> DataFrame:
    values = _event_json(spark, folder).select("event_id", "k", "whole_or_fraction", "number_or_text", "flag_or_whole")
    wanted = ["k", "whole_or_fraction", "number_or_text", "flag_or_whole"]
    return apply_types(values, infer_types(values, "input", wanted), "input")


QUERIES["apply_input"] = apply_input
ORACLES["apply_input"] = """
    WITH t AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id, k, CASE WHEN event_type = 'error' THEN CAST(k AS DOUBLE) ELSE value END AS whole_or_fraction,
        CASE WHEN event_type = 'error' THEN event_type ELSE CAST(k AS VARCHAR) END AS number_or_text,
        CASE WHEN event_type = 'error' THEN 1 ELSE k END AS flag_or_whole
    FROM t"""


def map_declared(spark: SparkSession, folder: str) -> DataFrame:
    text = load(spark, folder, "lineitem").selectExpr(
        "CAST(l_orderkey AS string) AS a", "CAST(l_linenumber AS string) AS b", "CAST(l_linenumber AS string) AS c",
        "CAST(l_extendedprice AS string) AS d", "CAST(l_quantity > 25 AS string) AS e", "l_orderkey AS f",
    )
    return map_types(text, {"a": "INT8", "b": "INT4", "c": "int2", "d": "DOUBLE PRECISION", "e": "BOOL", "f": "UUID"})


QUERIES["map_types"] = map_declared
ORACLES["map_types"] = """
    SELECT l_orderkey AS a, CAST(l_linenumber AS INTEGER) AS b, CAST(l_linenumber AS SMALLINT) AS c,
        l_extendedprice AS d, l_quantity > 25 AS e, CAST(l_orderkey AS VARCHAR) AS f FROM lineitem"""
