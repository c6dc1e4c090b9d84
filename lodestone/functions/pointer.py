"""JSON Pointers over VARIANT columns.

A pointer is compiled to variant paths when the plan is built. Segments that look like array indexes may
also be object keys, so every reading of a pointer is tried; on any one value at most one applies.
"""

from __future__ import annotations

import itertools
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

INDEX = re.compile(r"(?:0|[1-9][0-9]*)\Z")


class PointerError(ValueError):
    """A malformed JSON Pointer."""


def segments(pointer: str) -> list[str]:
    """The decoded segments; raises PointerError for an empty pointer, a missing slash or a bad escape."""
    if not isinstance(pointer, str) or not pointer.startswith("/"):
        raise PointerError(f"a pointer must start with '/': {pointer!r}")
    found = pointer[1:].split("/")
    for s in found:
        if re.search(r"~(?![01])", s):
            raise PointerError(f"bad escape in {pointer!r}")
    return [s.replace("~1", "/").replace("~0", "~") for s in found]


def paths(pointer: str) -> list[str]:
    """The variant paths a pointer may mean."""
    readings = []
    for s in segments(pointer):
        key = "[" + json.dumps(s, ensure_ascii=False) + "]"
        readings.append([f"[{s}]", key] if INDEX.match(s) else [key])
    return ["$" + "".join(r) for r in itertools.product(*readings)]


def value_at(record: Column, pointer: str) -> Column:
    """The VARIANT at ``pointer``: NULL if nothing is there, a variant null for JSON null."""
    found = [F.try_variant_get(record, p, "variant") for p in paths(pointer)]
    return found[0] if len(found) == 1 else F.coalesce(*found)


def value_at_lenient(record: Column, pointer: str) -> Column:
    """As ``value_at`` for policies: the empty pointer is the record itself, a malformed one finds nothing."""
    if pointer == "":
        return record
    if not pointer.startswith("/"):
        return F.lit(None).cast("variant")
    # A tilde that is no escape stands for itself.
    return value_at(record, re.sub(r"~(?![01])", "~0", pointer))


def kind(value: Column) -> Column:
    """string, number, boolean, object, array or null of a VARIANT; NULL where there is no value."""
    return kind_of_schema(F.schema_of_variant(value))


def kind_of_schema(schema: Column) -> Column:
    """``kind`` from a VARIANT's schema text, which is looked at once."""
    names = F.create_map(*[F.lit(x) for pair in (("STRING", "string"), ("BOOLEAN", "boolean"), ("OBJECT", "object"), ("ARRAY", "array"), ("VOID", "null")) for x in pair])
    return F.when(schema.isNotNull(), F.coalesce(F.try_element_at(names, F.substring_index(schema, "<", 1)), F.lit("number")))


def is_integer(value: Column) -> Column:
    """Whether a numeric VARIANT is whole (1.0 is)."""
    number = F.try_variant_get(value, "$", "double")
    return F.coalesce(number == F.floor(number), F.lit(False))


def string_at(record: Column, pointer: str) -> Column:
    """The string at ``pointer`` (read leniently), NULL for anything else."""
    value = value_at_lenient(record, pointer)
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def canonical(value: Column) -> Column:
    """A text equal for deep-equal values of one kind: keys sorted, numbers inside as doubles print."""
    return F.to_json(value)
