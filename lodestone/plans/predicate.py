"""The predicate language, compiled to boolean Columns over a VARIANT record.

Ten leaf operators and three combinators. Every leaf is a plain true or false, never NULL, so that ``not``
keeps two-valued logic; unknown operators, malformed pointers and unanchored patterns are errors when the
plan is built.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.plan import once
from lodestone.functions.pointer import kind, value_at

OPERATORS = ("equals", "notEquals", "in", "notIn", "exists", "missing", "type", "regex", "length", "range")
KINDS = ("string", "number", "boolean", "object", "array", "null")


class PredicateError(ValueError):
    """A predicate that cannot be compiled."""


def kind_of(value) -> str:  # noqa: ANN001
    """The kind of a JSON value in Python."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", dict: "object", list: "array"}[type(value)]


def equal(value: Column, expected, own: Column | None = None) -> Column:  # noqa: ANN001
    """Deep equality; scalars compare typed, containers by their canonical JSON. ``own``: the value's kind, if it is at hand."""
    wanted = kind_of(expected)
    if wanted == "null":
        same = F.is_variant_null(value)
    elif wanted in ("object", "array"):
        other = F.parse_json(F.lit(json.dumps(_plain(expected), ensure_ascii=False)))
        same = F.to_json(value) == F.to_json(other)
    else:
        spark_type = {"string": "string", "boolean": "boolean", "number": "double"}[wanted]
        same = F.try_variant_get(value, "$", spark_type) == F.lit(float(expected) if wanted == "number" else expected)
    return F.coalesce(((kind(value) if own is None else own) == wanted) & same, F.lit(False))


def _plain(value):  # noqa: ANN001, ANN202
    """Whole floats as integers, as records hold them."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else value


def _pattern(pattern: str) -> str:
    """An anchored pattern for Java: its last ``$`` means the very end, as it does in JavaScript."""
    if not isinstance(pattern, str) or not pattern.startswith("^") or not pattern.endswith("$") or pattern.endswith("\\$"):
        raise PredicateError(f"a pattern must be anchored by ^ and $: {pattern!r}")
    return pattern[:-1] + "\\z"


def _bounds(name: str, spec: dict, measure: Column, allowed: tuple[str, ...]) -> Column:
    if not isinstance(spec, dict) or set(spec) - set(allowed):
        raise PredicateError(f"{name} takes {allowed}: {spec!r}")
    tests = {"eq": measure == F.lit(spec.get("eq")), "gt": measure > F.lit(spec.get("gt")), "gte": measure >= F.lit(spec.get("gte")), "lt": measure < F.lit(spec.get("lt")), "lte": measure <= F.lit(spec.get("lte"))}
    if "eq" in spec:
        return tests["eq"]
    return reduce(lambda a, b: a & b, [tests[k] for k in spec], F.lit(True))


def _leaf(spec: dict, at) -> Column:  # noqa: ANN001
    value, own = at(spec["path"])
    found = value.isNotNull()
    if "equals" in spec:
        return equal(value, spec["equals"], own)
    if "notEquals" in spec:
        return found & ~equal(value, spec["notEquals"], own)
    if "in" in spec or "notIn" in spec:
        wanted = spec["in"] if "in" in spec else spec["notIn"]
        among = reduce(lambda a, b: a | b, [equal(value, v, own) for v in wanted], F.lit(False))
        return among if "in" in spec else found & ~among
    if "exists" in spec:
        return found
    if "missing" in spec:
        return ~found
    if "type" in spec:
        if spec["type"] not in KINDS:
            raise PredicateError(f"unknown type {spec['type']!r}")
        return F.coalesce(own == spec["type"], F.lit(False))
    if "regex" in spec:
        return F.coalesce((own == "string") & F.try_variant_get(value, "$", "string").rlike(_pattern(spec["regex"])), F.lit(False))
    if "length" in spec:
        # UTF-16 units: one more for each character beyond the basic plane.
        text = F.try_variant_get(value, "$", "string")
        units = F.length(text) + F.length(F.regexp_replace(text, "[^\\x{10000}-\\x{10FFFF}]", ""))
        size = F.when(own == "string", units).when(own == "array", F.size(F.try_variant_get(value, "$", "array<variant>")))
        return F.coalesce(_bounds("length", spec["length"], size, ("eq", "gte", "lte")) & size.isNotNull(), F.lit(False))
    if "range" in spec:
        number = F.when(own == "number", F.try_variant_get(value, "$", "double"))
        finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(math.inf))
        return F.coalesce(finite & _bounds("range", spec["range"], number, ("gt", "gte", "lt", "lte")), F.lit(False))
    raise PredicateError(f"unknown operator in {spec!r}; allowed: {', '.join(OPERATORS)}")


def compile_predicate(record: Column, predicate: dict, at=None) -> Column:  # noqa: ANN001
    """A predicate document as a Column that is true or false.

    Leaves name a path and one operator, ``{"path": "/a", "equals": 1}``; combinators are ``{"all": [...]}``,
    ``{"any": [...]}`` and ``{"not": {...}}``. An empty ``all`` is true, an empty ``any`` false. ``at`` gives the
    value and kind at a path where they are at hand.
    """
    if not isinstance(predicate, dict):
        raise PredicateError(f"a predicate is an object: {predicate!r}")
    at = at or (lambda path: ((value := value_at(record, path)), kind(value)))
    if "all" in predicate:
        return reduce(lambda a, b: a & b, [compile_predicate(record, p, at) for p in predicate["all"]], F.lit(True))
    if "any" in predicate:
        return reduce(lambda a, b: a | b, [compile_predicate(record, p, at) for p in predicate["any"]], F.lit(False))
    if "not" in predicate:
        return ~compile_predicate(record, predicate["not"], at)
    if "path" not in predicate:
        raise PredicateError(f"no path, all, any or not in {predicate!r}")
    return _leaf(predicate, at)


def looked_up(record: Column, predicates: list[dict], use) -> Column:  # noqa: ANN001
    """``use`` of the compiled predicates; the value at each of their paths is looked up once a record, not once a test."""
    paths: dict[str, str] = {}
    plain = lambda path: ((value := value_at(record, path)), kind(value))

    def noted(path):  # noqa: ANN001, ANN202
        found = plain(path)
        paths.setdefault(path, f"_{len(paths)}")
        return found

    compiled = [compile_predicate(record, p, noted) for p in predicates]
    if not paths:
        return use(compiled)
    values = F.struct(*[F.struct(plain(path)[0].alias("v"), plain(path)[1].alias("k")).alias(name) for path, name in paths.items()])
    return once(values, lambda x: use([compile_predicate(record, p, lambda path: (x[paths[path]]["v"], x[paths[path]]["k"])) for p in predicates]))
