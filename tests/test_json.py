"""JSON containment against a plain recursive definition."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from rowmill.functions import json_contains

DOCUMENTS = [
    '{"k": 69}', '{"k": "69"}', '{"k": null}', "{}", '{"k": 69.0}', '{"k": 69.5}', '{"k": 6.9e1}', '{"k": true}',
    '{"a": {"b": {"c": 1, "d": "x"}}, "k": 1}', '{"a": [1, 2, {"b": 3}]}', '{"a": [[1, 2], [3]]}', '{"a": []}',
    "[1, 2, 3]", '["x", {"k": 69}]', "69", '"text"', "true", "null", '{"odd key\'s": {"dot.ted": 5}}',
    '{"big": 9007199254740993}', '{"big": 9007199254740992}', '{"k": 99999999999999999999}', '{"k": [69]}',
    '{"big": 9007199254740993.0}', '{"big": 9007199254740992.5}', '{"k": 0.1}', '{"k": 0.10000000000000001}', '{"k": 1e2}',
    '{"a": {"b": [{"c": 1}, {"c": 2, "d": [5, 6]}]}}', '{"k": "it\'s"}',
    '{"a]b": 1, "q\\"uote": 2, "": 3, "what?": 4, "*": 5, "\\\\": 6, "it\'s \\"so\\"": 7}',
]
LITERALS = [
    '{"k": 69}', '{"k": "69"}', '{"k": null}', "{}", '{"k": 69.5}', '{"k": true}', '{"a": {"b": {}}}',
    '{"a": {"b": {"c": 1}}}', '{"a": [2]}', '{"a": [{"b": 3}, 1]}', '{"a": [[2]]}', '{"a": []}', "[3, 1]", "[]",
    '[{"k": 69}]', "69", '"text"', "2", '"x"', "null", '{"odd key\'s": {"dot.ted": 5}}', '{"big": 9007199254740993}',
    '{"k": 99999999999999999999}', '{"k": [69]}', '{"a": {"b": [{"d": [6]}]}}', '{"big": 9007199254740992}', '{"k": 0.1}',
    '{"big": 9007199254740992.0}', '{"big": 9007199254740992.5}', '{"k": 0.10000000000000001}', '{"k": 100}', '{"k": 1e2}', '{"k": "it\'s"}', '{"k": 69, "a": 1}',
    '{"a]b": 1}', '{"q\\"uote": 2}', '{"": 3}', '{"what?": 4}', '{"*": 5}', '{"\\\\": 6}', '{"it\'s \\"so\\"": 7}', '{"what?": 5}',
]


def contains(document, wanted, top=True):
    if isinstance(wanted, dict):
        return isinstance(document, dict) and all(
            name in document and contains(document[name], value, False) for name, value in wanted.items()
        )
    if isinstance(wanted, list):
        return isinstance(document, list) and all(any(contains(d, w, False) for d in document) for w in wanted)
    if top and isinstance(document, list):
        return any(not isinstance(d, (dict, list)) and contains(d, wanted, False) for d in document)
    numbers = (int, Decimal)
    if isinstance(document, bool) or isinstance(wanted, bool):
        return document is wanted
    if isinstance(document, numbers) and isinstance(wanted, numbers):
        return document == wanted
    return type(document) is type(wanted) and document == wanted


def test_against_the_definition(spark):
    df = spark.createDataFrame([(d,) for d in DOCUMENTS], "text string").withColumn("doc", F.parse_json("text"))
    tests = [json_contains("doc", literal).alias(f"t{i}") for i, literal in enumerate(LITERALS)]
    for row in df.select("text", *tests).collect():
        for i, literal in enumerate(LITERALS):
            expected = contains(json.loads(row.text, parse_float=Decimal), json.loads(literal, parse_float=Decimal))
            assert row[f"t{i}"] == expected, (row.text, literal)


def test_null_documents_give_null(spark):
    df = spark.createDataFrame([(None,), ("{bad",)], "text string")
    rows = df.select(json_contains(F.try_parse_json("text"), '{"k": 1}').alias("t")).collect()
    assert [r.t for r in rows] == [None, None]
