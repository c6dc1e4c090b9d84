import json

import pytest
from pyspark.sql import functions as F

from lodestone.functions.pointer import PointerError, paths, segments
from lodestone.plans.predicate import PredicateError, compile_predicate
from lodestone.plans.schema import SchemaError, compile_schema

RECORD = {"s": "abc", "n": 5, "f": 1.5, "whole": 1.0, "b": True, "z": None, "a": [1, "x", {"k": 2}], "o": {"x": 1, "y": [1, 2]}, "a/b": 1, "m~n": 2, "0": "zero", "e": "", "emoji": "😀"}

CASES = [
    ({"path": "/s", "equals": "abc"}, True), ({"path": "/s", "equals": "abd"}, False), ({"path": "/n", "equals": 5.0}, True), ({"path": "/n", "equals": "5"}, False),
    ({"path": "/whole", "equals": 1}, True), ({"path": "/b", "equals": True}, True), ({"path": "/b", "equals": 1}, False), ({"path": "/z", "equals": None}, True), ({"path": "/q", "equals": None}, False),
    ({"path": "/a", "equals": [1, "x", {"k": 2.0}]}, True), ({"path": "/o", "equals": {"y": [1, 2], "x": 1}}, True), ({"path": "/o", "equals": {"x": 1}}, False),
    ({"path": "/s", "notEquals": "x"}, True), ({"path": "/q", "notEquals": "x"}, False), ({"path": "/z", "notEquals": 1}, True),
    ({"path": "/n", "in": [1, 5]}, True), ({"path": "/n", "in": []}, False), ({"path": "/n", "notIn": [1]}, True), ({"path": "/q", "notIn": [1]}, False),
    ({"path": "/z", "exists": True}, True), ({"path": "/q", "exists": True}, False), ({"path": "/q", "missing": True}, True), ({"path": "/z", "missing": True}, False),
    ({"path": "/s", "type": "string"}, True), ({"path": "/n", "type": "number"}, True), ({"path": "/b", "type": "boolean"}, True), ({"path": "/o", "type": "object"}, True),
    ({"path": "/a", "type": "array"}, True), ({"path": "/z", "type": "null"}, True), ({"path": "/q", "type": "null"}, False),
    ({"path": "/s", "regex": "^a.c$"}, True), ({"path": "/s", "regex": "^a$"}, False), ({"path": "/n", "regex": "^5$"}, False),
    ({"path": "/s", "length": {"eq": 3, "gte": 9}}, True), ({"path": "/a", "length": {"gte": 3, "lte": 3}}, True), ({"path": "/s", "length": {}}, True), ({"path": "/n", "length": {}}, False), ({"path": "/emoji", "length": {"eq": 2}}, True),
    ({"path": "/n", "range": {"gt": 4, "lte": 5}}, True), ({"path": "/n", "range": {"lt": 5}}, False), ({"path": "/s", "range": {"gte": 0}}, False),
    ({"path": "/a/1", "equals": "x"}, True), ({"path": "/a/01", "exists": True}, False), ({"path": "/a/-1", "exists": True}, False), ({"path": "/a/2/k", "equals": 2}, True), ({"path": "/0", "equals": "zero"}, True), ({"path": "/s/0", "exists": True}, False),
    ({"path": "/a~1b", "equals": 1}, True), ({"path": "/m~0n", "equals": 2}, True),
    ({"all": []}, True), ({"any": []}, False), ({"not": {"path": "/q", "equals": 1}}, True), ({"all": [{"path": "/n", "equals": 5}, {"not": {"path": "/s", "equals": "abc"}}]}, False),
]


def test_truth_table(spark):
    row = spark.range(1).select(F.parse_json(F.lit(json.dumps(RECORD))).alias("r"))
    got = row.select(*[compile_predicate(F.col("r"), p).alias(f"c{i}") for i, (p, _) in enumerate(CASES)]).first()
    wrong = [(p, want, got[i]) for i, (p, want) in enumerate(CASES) if got[i] is not want]
    assert not wrong


def test_a_pattern_ends_at_the_very_end(spark):
    row = spark.range(1).select(F.parse_json(F.lit(json.dumps({"s": "abc\n"}))).alias("r"))
    assert row.select(compile_predicate(F.col("r"), {"path": "/s", "regex": "^abc$"})).first()[0] is False


@pytest.mark.parametrize("bad", [{"path": "/a", "like": 1}, {"path": "", "exists": True}, {"path": "a", "exists": True}, {"path": "/a", "regex": "abc"}, {"path": "/a", "regex": "^abc"}, {}, {"path": "/a", "type": "date"}, {"path": "/a", "range": {"above": 1}}])
def test_errors_when_built(spark, bad):
    with pytest.raises((PredicateError, PointerError)):
        compile_predicate(F.col("r"), bad)


def test_pointer_escapes():
    assert segments("/a~1b/m~0n/~01") == ["a/b", "m~n", "~1"]
    assert paths("/a/0") == ['$["a"][0]', '$["a"]["0"]']


SCHEMA = {"type": "object", "required": ["s"], "properties": {"s": {"type": "string", "minLength": 2, "pattern": "^a"}, "n": {"type": "integer", "minimum": 1}, "a": {"type": "array", "maxItems": 2, "items": {"type": ["integer", "null"]}}}, "additionalProperties": False}


def test_schema_subset(spark):
    cases = [({"s": "ab"}, True), ({"s": "a"}, False), ({"s": "ba"}, False), ({}, False), ({"s": "ab", "n": 1.5}, False), ({"s": "ab", "n": 2.0}, True), ({"s": "ab", "a": [1, None]}, True), ({"s": "ab", "a": ["x"]}, False), ({"s": "ab", "a": [1, 2, 3]}, False), ({"s": "ab", "x": 1}, False)]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(cases)], "i int, j string").select("i", F.parse_json("j").alias("r"))
    got = {r.i: r.ok for r in rows.select("i", compile_schema(F.col("r"), SCHEMA).alias("ok")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_schema_combinators_and_references(spark):
    schema = {"oneOf": [{"$ref": "#/$defs/t"}, {"type": "number"}], "not": {"const": 3}, "$defs": {"t": {"enum": ["x", "y"]}}}
    rows = spark.createDataFrame([(i, j) for i, j in enumerate(['"x"', '"z"', "2", "3"])], "i int, j string").select("i", F.parse_json("j").alias("r"))
    assert [r[0] for r in rows.orderBy("i").select(compile_schema(F.col("r"), schema)).collect()] == [True, False, True, False]
    with pytest.raises(SchemaError):
        compile_schema(F.col("r"), {"dependentRequired": {}})
