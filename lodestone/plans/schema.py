"""A JSON Schema subset compiled to a boolean Column over a VARIANT.

Supported: type, enum, const, required, properties, additionalProperties (false), items, minItems, maxItems,
minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, minProperties, maxProperties,
allOf, anyOf, oneOf, not and local ``$ref``. Annotations are passed over. Any other keyword is an error when
the plan is built, never a silent pass.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.pointer import kind
from lodestone.plans.predicate import equal

ANNOTATIONS = {"$schema", "$id", "$defs", "definitions", "title", "description", "default", "examples", "$comment", "format", "deprecated", "readOnly", "writeOnly"}
#: Nested references followed at most.
DEPTH = 8


class SchemaError(ValueError):
    """A schema with a keyword that is not supported."""


def compile_schema(value: Column, schema: dict | bool, root: dict | None = None, depth: int = 0) -> Column:
    """Whether the VARIANT is valid; keywords bind only values of their kind, as the standard has it."""
    if schema is True or schema == {}:
        return F.lit(True)
    if schema is False:
        return F.lit(False)
    root = schema if root is None else root
    if depth > DEPTH:
        raise SchemaError("references are nested too deeply")
    own, tests = kind(value), []
    number, text = F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$", "string")
    items = F.try_variant_get(value, "$", "array<variant>")
    is_kind = lambda k, test: F.when(own == k, test).otherwise(F.lit(True))
    sub = lambda v, s: compile_schema(v, s, root, depth + 1)
    every = lambda cols: reduce(lambda a, b: a & b, cols, F.lit(True))
    for k, spec in schema.items():
        if k in ANNOTATIONS or k.startswith("x-"):
            continue
        if k == "type":
            names = [spec] if isinstance(spec, str) else spec
            whole = (own == "number") & F.coalesce(number == F.floor(number), F.lit(False))
            tests.append(reduce(lambda a, b: a | b, [whole if n == "integer" else own == n for n in names], F.lit(False)))
        elif k in ("enum", "const"):
            tests.append(reduce(lambda a, b: a | b, [equal(value, v) for v in (spec if k == "enum" else [spec])], F.lit(False)))
        elif k == "required":
            tests.append(is_kind("object", every([_at(value, n).isNotNull() for n in spec])))
        elif k == "properties":
            tests.append(is_kind("object", every([_at(value, n).isNull() | sub(_at(value, n), s) for n, s in spec.items()])))
        elif k == "additionalProperties":
            if spec is not False and spec is not True and spec != {}:
                raise SchemaError("additionalProperties may only be true or false")
            if spec is False:
                known = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
                tests.append(is_kind("object", F.size(F.array_except(F.json_object_keys(F.to_json(value)), known)) == 0))
        elif k == "items":
            tests.append(is_kind("array", F.forall(items, _valid(spec, root, depth + 1))))
        elif k in ("minItems", "maxItems"):
            tests.append(is_kind("array", F.size(items) >= spec if k == "minItems" else F.size(items) <= spec))
        elif k in ("minLength", "maxLength"):
            tests.append(is_kind("string", F.length(text) >= spec if k == "minLength" else F.length(text) <= spec))
        elif k in ("minProperties", "maxProperties"):
            n = F.size(F.json_object_keys(F.to_json(value)))
            tests.append(is_kind("object", n >= spec if k == "minProperties" else n <= spec))
        elif k == "pattern":
            tests.append(is_kind("string", text.rlike(spec[:-1] + "\\z" if spec.endswith("$") and not spec.endswith("\\$") else spec)))
        elif k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            tests.append(is_kind("number", {"minimum": number >= spec, "maximum": number <= spec, "exclusiveMinimum": number > spec, "exclusiveMaximum": number < spec}[k]))
        elif k == "allOf":
            tests.append(every([sub(value, s) for s in spec]))
        elif k == "anyOf":
            tests.append(reduce(lambda a, b: a | b, [sub(value, s) for s in spec], F.lit(False)))
        elif k == "oneOf":
            tests.append(sum([sub(value, s).cast("int") for s in spec], F.lit(0)) == 1)
        elif k == "not":
            tests.append(~sub(value, spec))
        elif k == "$ref":
            tests.append(sub(value, _referenced(root, spec)))
        else:
            raise SchemaError(f"unsupported keyword {k!r}")
    return every([F.coalesce(t, F.lit(False)) for t in tests])


def _valid(schema: dict | bool, root: dict, depth: int):  # noqa: ANN202
    return lambda v: compile_schema(v, schema, root, depth)


def _at(value: Column, name: str) -> Column:
    return F.try_variant_get(value, "$[" + json.dumps(name, ensure_ascii=False) + "]", "variant")


def _referenced(root: dict, ref: str) -> dict | bool:
    if not ref.startswith("#"):
        raise SchemaError(f"only local references are followed: {ref!r}")
    found = root
    for part in [p.replace("~1", "/").replace("~0", "~") for p in ref[1:].split("/") if p]:
        if part not in found:
            raise SchemaError(f"no such definition: {ref!r}")
        found = found[part]
    return found
