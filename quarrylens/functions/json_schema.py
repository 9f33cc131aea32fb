"""JSON Schema as columns: a schema is compiled to an expression over a VARIANT that lists what doesn't fit, and where.

Understood are ``type``, ``enum``, ``const``, ``pattern``, ``minLength``, ``maxLength``, ``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``required``, ``properties``,
``additionalProperties``, ``items``, ``minItems``, ``maxItems``, ``uniqueItems``, ``anyOf``, ``oneOf``, ``allOf``, ``not``, ``if``/``then``/``else`` and references within the schema (``$ref`` to ``#/...``); titles,
descriptions, defaults, examples, formats and the like say nothing about a value. Other keywords, and references that lead to themselves, are refused when the schema is compiled. A keyword holds for
values of its kind only, as the standard has it.

The expression runs in the scan's stage, without Python, whatever the number of documents.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MISFITS = "array<struct<path:string,problem:string>>"
#: What a schema may say that no value depends on.
NOTES = frozenset("$schema $id $comment $defs definitions title description default examples format deprecated readOnly writeOnly".split())
_KINDS = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}

Check = Callable[[Column, Column], Column]


def _none() -> Column:
    return F.array().cast(MISFITS)


def _said(wrong: Column, path: Column, problem: str) -> Column:
    return F.when(F.coalesce(wrong, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(problem).alias("problem")))).otherwise(_none())


def _kind(value: Column) -> Column:
    """The name of a value's kind, such as ``OBJECT``, ``ARRAY``, ``STRING`` or a number's type."""
    return F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1)


def _is(value: Column, kind: str) -> Column:
    if kind in ("number", "integer"):
        number = _kind(value).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
        return number if kind == "number" else number & (F.try_variant_get(value, "$", "double") % 1 == 0)
    if kind not in _KINDS:
        raise ValueError(f"unknown type {kind!r} in a schema")
    return _kind(value) == _KINDS[kind]


def _joined(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else _none()


def _equals(value: Column, wanted) -> Column:
    """Whether a value is that one; objects and lists by their text with sorted keys as the variant writes it."""
    if wanted is None:
        return _is(value, "null")
    if isinstance(wanted, bool):
        return _is(value, "boolean") & (F.try_variant_get(value, "$", "boolean") == wanted)
    if isinstance(wanted, int | float):
        return _is(value, "number") & (F.try_variant_get(value, "$", "double") == float(wanted))
    if isinstance(wanted, str):
        return _is(value, "string") & (F.try_variant_get(value, "$", "string") == wanted)
    return F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(wanted))))


class _Compiler:
    def __init__(self, root: dict):
        self.root = root

    def found(self, reference: str):
        if not reference.startswith("#"):
            raise ValueError(f"a reference must stay within the schema: {reference}")
        node = self.root
        for part in filter(None, reference[1:].split("/")):
            node = node[part.replace("~1", "/").replace("~0", "~")]
        return node

    def check(self, schema, open_: tuple[str, ...] = ()) -> Check:
        """What a value must fulfil: a function of the value and its path."""
        if schema is True:
            return lambda value, path: _none()
        if schema is False:
            return lambda value, path: _said(F.lit(True), path, "must not be there")
        checks: list[Check] = []
        known = set(NOTES)

        def keyword(name: str):
            known.add(name)
            return schema.get(name)

        if (reference := keyword("$ref")) is not None:
            if reference in open_:
                raise ValueError(f"{reference} leads to itself")
            checks.append(self.check(self.found(reference), (*open_, reference)))
        inner = lambda s: self.check(s, open_)
        if (kinds := keyword("type")) is not None:
            listed = [kinds] if isinstance(kinds, str) else list(kinds)
            checks.append(lambda value, path: _said(~_any([_is(value, k) for k in listed]), path, f"must be of type {' or '.join(listed)}"))
        for name in ("enum", "const"):
            if keyword(name) is not None or name in schema:
                wanted = schema[name] if name == "enum" else [schema[name]]
                checks.append(lambda value, path, wanted=wanted: _said(~_any([_equals(value, w) for w in wanted]), path, f"must be one of {json.dumps(wanted)}"))
        text = lambda value: F.when(_is(value, "string"), F.try_variant_get(value, "$", "string"))
        number = lambda value: F.when(_is(value, "number"), F.try_variant_get(value, "$", "double"))
        items = lambda value: F.when(_is(value, "array"), F.try_variant_get(value, "$", "array<variant>"))
        fields = lambda value: F.when(_is(value, "object"), F.try_variant_get(value, "$", "map<string,variant>"))
        bounds = {
            "pattern": lambda v, x: ~text(v).rlike(x), "minLength": lambda v, x: F.length(text(v)) < x, "maxLength": lambda v, x: F.length(text(v)) > x,
            "minimum": lambda v, x: number(v) < x, "maximum": lambda v, x: number(v) > x, "exclusiveMinimum": lambda v, x: number(v) <= x, "exclusiveMaximum": lambda v, x: number(v) >= x,
            "minItems": lambda v, x: F.size(items(v)) < x, "maxItems": lambda v, x: F.size(items(v)) > x,
        }
        for name, wrong in bounds.items():
            if (bound := keyword(name)) is not None:
                checks.append(lambda value, path, name=name, wrong=wrong, bound=bound: _said(wrong(value, bound), path, f"{name} is {bound}"))
        if keyword("uniqueItems"):
            texts = lambda value: F.transform(items(value), lambda x: F.to_json(x))
            checks.append(lambda value, path: _said(F.size(F.array_distinct(texts(value))) < F.size(texts(value)), path, "items must differ"))
        for name in keyword("required") or ():
            checks.append(lambda value, path, name=name: _said(~F.map_contains_key(fields(value), name), path, f"must have {name}"))
        properties = keyword("properties") or {}
        for name, node in properties.items():
            checks.append(lambda value, path, name=name, c=inner(node): _within(F.try_element_at(fields(value), F.lit(name)), F.concat(path, F.lit(f".{name}")), c))
        others = keyword("additionalProperties")
        if others is not None and others is not True:
            def beside(value, path, c=inner(others)):
                rest = F.filter(F.map_entries(fields(value)), lambda e: ~e["key"].isin(*properties)) if properties else F.map_entries(fields(value))
                return F.coalesce(F.flatten(F.transform(rest, lambda e: c(e["value"], F.concat(path, F.lit("."), e["key"])))), _none())

            checks.append(beside)
        if (node := keyword("items")) is not None:
            checks.append(lambda value, path, c=inner(node): F.coalesce(F.flatten(F.transform(items(value), lambda x, k: c(x, F.concat(path, F.lit("["), k.cast("string"), F.lit("]"))))), _none()))
        fits = lambda c, value, path: F.size(c(value, path)) == 0
        for c in [inner(node) for node in keyword("allOf") or ()]:
            checks.append(c)
        if (nodes := keyword("anyOf")) is not None:
            checks.append(lambda value, path, cs=tuple(map(inner, nodes)): _said(~_any([fits(c, value, path) for c in cs]), path, "must fit one of several forms"))
        if (nodes := keyword("oneOf")) is not None:
            checks.append(lambda value, path, cs=tuple(map(inner, nodes)): _said(sum((fits(c, value, path).cast("int") for c in cs), F.lit(0)) != 1, path, "must fit exactly one of several forms"))
        if (node := keyword("not")) is not None:
            checks.append(lambda value, path, c=inner(node): _said(fits(c, value, path), path, "must not fit a form"))
        node, then, other = keyword("if"), keyword("then"), keyword("else")
        if node is not None:
            checks.append(lambda value, path, c=inner(node), a=inner(True if then is None else then), b=inner(True if other is None else other): F.when(fits(c, value, path), a(value, path)).otherwise(b(value, path)))
        if unknown := sorted(set(schema) - known):
            raise ValueError(f"a schema's keywords {unknown} are not understood")
        return lambda value, path: _joined([c(value, path) for c in checks])


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _within(value: Column, path: Column, check: Check) -> Column:
    """What doesn't fit in a field, if it is there."""
    return F.when(value.isNotNull(), check(value, path)).otherwise(_none())


def misfits(text: Column, schema: dict | bool, root: str = "$") -> Column:
    """``path`` and ``problem`` of all in a JSON text that doesn't fit the schema; a text that is no JSON has one problem, a null text is null."""
    value = F.try_parse_json(text)
    check = _Compiler(schema if isinstance(schema, dict) else {}).check(schema)
    broken = F.array(F.struct(F.lit(root).alias("path"), F.lit("is no JSON").alias("problem")))
    return F.when(text.isNull(), F.lit(None).cast(MISFITS)).when(value.isNull(), broken).otherwise(check(value, F.lit(root)))
