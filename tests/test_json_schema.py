"""Compiled schemas against a validator written here."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quarrylens.functions.json_schema import misfits
from quarrylens.sources import readers


def kind_of(x):
    return "null" if x is None else "boolean" if isinstance(x, bool) else "number" if isinstance(x, int | float) else {str: "string", list: "array", dict: "object"}[type(x)]


def same(a, b):
    return kind_of(a) == kind_of(b) and a == b


def paths(value, schema, root, at="$"):
    """Paths of what doesn't fit, one for each misfit."""
    if isinstance(schema, bool):
        return [] if schema else [at]
    out = []
    if "$ref" in schema:
        node = root
        for part in schema["$ref"][2:].split("/"):
            node = node[part]
        out += paths(value, node, root, at)
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    fits = lambda k: kind_of(value) == k or (k == "integer" and kind_of(value) == "number" and value % 1 == 0)
    out += [at] * (bool(kinds) and not any(map(fits, kinds)))
    out += [at] * ("enum" in schema and not any(same(value, w) for w in schema["enum"]))
    out += [at] * ("const" in schema and not same(value, schema["const"]))
    if isinstance(value, str):
        out += [at] * ("pattern" in schema and not re.search(schema["pattern"], value))
        out += [at] * (len(value) < schema.get("minLength", 0)) + [at] * (len(value) > schema.get("maxLength", 99))
    if kind_of(value) == "number":
        out += [at] * (value < schema.get("minimum", value)) + [at] * (value > schema.get("maximum", value))
        out += [at] * ("exclusiveMinimum" in schema and value <= schema["exclusiveMinimum"]) + [at] * ("exclusiveMaximum" in schema and value >= schema["exclusiveMaximum"])
    if isinstance(value, list):
        out += [at] * (len(value) < schema.get("minItems", 0)) + [at] * (len(value) > schema.get("maxItems", 99))
        out += [at] * (schema.get("uniqueItems", False) and any(same(x, y) for k, x in enumerate(value) for y in value[:k]))
        if "items" in schema:
            out += [p for k, x in enumerate(value) for p in paths(x, schema["items"], root, f"{at}[{k}]")]
    if isinstance(value, dict):
        out += [at for k in schema.get("required", []) if k not in value]
        for k, x in value.items():
            node = schema.get("properties", {}).get(k, schema.get("additionalProperties", True))
            out += paths(x, node, root, f"{at}.{k}")
    good = lambda s: not paths(value, s, root, at)
    out += [p for s in schema.get("allOf", []) for p in paths(value, s, root, at)]
    out += [at] * ("anyOf" in schema and not any(map(good, schema["anyOf"]))) + [at] * ("oneOf" in schema and sum(map(good, schema["oneOf"])) != 1) + [at] * ("not" in schema and good(schema["not"]))
    if "if" in schema:
        out += paths(value, schema.get("then" if good(schema["if"]) else "else", True), root, at)
    return out


SCHEMA = {
    "$defs": {"id": {"type": "string", "pattern": "^[a-c]+$", "maxLength": 3}, "pair": {"type": "array", "items": {"$ref": "#/$defs/id"}, "minItems": 1, "maxItems": 2, "uniqueItems": True}},
    "type": "object", "required": ["a"], "additionalProperties": {"type": ["integer", "null"], "minimum": 2},
    "properties": {
        "a": {"$ref": "#/$defs/id"}, "b": {"enum": ["a", 1, True, None]}, "c": {"type": "array", "items": {"$ref": "#/$defs/pair"}}, "d": {"anyOf": [{"type": "string", "minLength": 2}, {"type": "number", "exclusiveMaximum": 3}]},
        "e": {"oneOf": [{"type": "integer"}, {"type": "number", "exclusiveMinimum": 0}]}, "f": {"not": {"type": "object", "required": ["a"]}}, "g": {"allOf": [{"type": "integer"}, {"maximum": 3}]},
        "h": {"type": "object", "properties": {"a": {"const": 1}}, "additionalProperties": False}, "i": {"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"type": "boolean"}},
    },
}


def test_misfits_are_those_of_a_validator(spark):
    rng = random.Random(2)

    def value(depth):
        leaf = [None, True, False, rng.randrange(-2, 5), rng.choice([0.5, 2.0, -1.5]), rng.choice(["", "a", "ab", "abc", "abca", "x", "1"])]
        if depth == 0:
            return rng.choice(leaf)
        return rng.choice([*leaf, [value(depth - 1) for _ in range(rng.randrange(4))], {rng.choice("abcdefgh"): value(depth - 1) for _ in range(rng.randrange(4))}])

    data = [{k: value(3) for k in "abcdefghij" if rng.random() < 0.7} for _ in range(400)] + [value(2) for _ in range(60)] + [{"a": "abc"}, {"a": "b", "b": 1, "j": None, "c": [["a", "b"]], "h": {"a": 1}}]
    rows = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(data)], "k int, t string").repartition(2)
    found = {r.k: sorted(x.path for x in r.m) for r in rows.withColumn("m", misfits(F.col("t"), SCHEMA)).collect()}
    assert found == {k: sorted(paths(x, SCHEMA, SCHEMA)) for k, x in enumerate(data)}
    assert sum(map(len, found.values())) > 500 and any(not x for x in found.values())


def test_texts_that_are_no_json_and_schemas_that_are_refused(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{",), ("1",)], "t string").withColumn("m", misfits(F.col("t"), True)).collect()
    assert [None if r.m is None else [(x.path, x.problem) for x in r.m] for r in rows] == [None, [("$", "is no JSON")], [("$", "is no JSON")], []]
    for wrong in ({"$ref": "#/a", "a": {"$ref": "#/a"}}, {"$ref": "other.json"}, {"typo": "string"}, {"type": "text"}):
        with pytest.raises(ValueError):
            spark.range(1).select(misfits(F.lit("1"), wrong))


def test_settings_schema_is_wider_than_the_kinds(spark, tmp_path):
    good = {"settings": {"file_snippet": {"ranking_threshold": -1, "honour_file_exts": None}, "skip": {"sizes": {"fingerprinting": [{"patterns": ["a"], "min": 1}]}}}, "bom": {"remove": [{"path": "a"}]}, "self": {"name": "x"}}
    rows = spark.createDataFrame([(json.dumps(good),)], "value string")
    assert readers.settings_misfits(rows, F.col("value")).count() == 0
    (tmp_path / "s.json").write_text(json.dumps(good))
    assert readers.settings(str(tmp_path / "s.json")) == good
