"""JSON Schemas from observed shapes (driver side: one document a class)."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame

from lodestone.operators.shapes import KINDS, shape_cache

MAX_ENUM = 16
URL_SHARE = 0.9
HINT = "x-lodestone-"


def pascal(name: str) -> str:
    """Parts between underscores and spaces with a capital first letter."""
    return "".join(p[:1].upper() + p[1:] for p in re.split(r"[_\s]+", name.lstrip("_")) if p)


def singular(name: str) -> str:
    """The name without a trailing ``s`` (not of ``ss``)."""
    return name[:-1] if len(name) > 1 and name.endswith("s") and not name.endswith("ss") else name


def item_name(name: str) -> str:
    """The name of an array's element: the singular of three letters and more, else ``<name>_item``."""
    bare = name.removesuffix("[]")
    return bare[:-1] if bare.endswith("s") and len(bare) > 2 else f"{bare}_item"


def object_name(name: str, class_name: str) -> str:
    """The name of an object schema: class and singular property."""
    own = pascal(name)
    return pascal(class_name) + (own[:-1] if name.endswith("s") and len(name) > 2 and len(own) > 2 else own)


def primitive_name(name: str, class_name: str, schema: dict) -> str:
    """The name of a primitive schema: class and property; promoted IRIs share ``IriString``."""
    return "IriString" if schema.get(HINT + "iri-promotion") else pascal(class_name) + pascal(name)


def type_fragment(counts: dict[str, int]) -> dict:
    """``type`` for one kind, a pair with null, ``oneOf`` for more (by name, null last)."""
    kinds = sorted(k for k, n in counts.items() if n and k != "null")
    if "integer" in kinds and "number" in kinds:
        kinds.remove("integer")
    null = counts.get("null", 0) > 0
    if not kinds:
        return {"type": "null"}
    if len(kinds) == 1:
        return {"type": [kinds[0], "null"] if null else kinds[0]}
    return {"oneOf": [{"type": k} for k in kinds] + ([{"type": "null"}] if null else [])}


def looks_like_dictionary(keys: list[str]) -> bool:
    """Keys that are data: all whole numbers, or over 32 of which most are short codes of letters and digits."""
    if keys and all(re.fullmatch(r"-?\d+", k) for k in keys):
        return True
    return len(keys) > 32 and sum(bool(re.fullmatch(r"[A-Za-z0-9]{1,12}", k)) for k in keys) > 0.6 * len(keys)


class Node:
    """One path of a class with its children."""

    def __init__(self, row: dict | None = None):
        self.row, self.children, self.items = row, {}, None

    def child(self, step: str) -> Node:
        if step == "[]":
            self.items = self.items or Node()
            return self.items
        return self.children.setdefault(step, Node())


def steps(path: str) -> list[str]:
    """``a.b[].c`` as its steps."""
    return [s for part in path.split(".") for s in re.findall(r"\[\]|[^\[\]]+", part)]


def _property(node: Node, class_name: str, record_count: int) -> dict:
    row = node.row or {}
    counts = {k: row.get(f"n_{k}") or 0 for k in KINDS}
    out = type_fragment(counts)
    texts, only_text = row.get("texts") or [], counts["string"] and counts["string"] + counts["null"] == row["presence"]
    if row.get("url_count", 0) > URL_SHARE * record_count:
        out["format"] = "iri"
        out[HINT + "range"] = "iri"
        out[HINT + "iri-promotion"] = True
    elif only_text and not row["overflow"] and 0 < len(texts) <= MAX_ENUM:
        out["enum"] = sorted(texts) + ([None] if counts["null"] else [])
        out[HINT + "closed-enum"] = True
        if texts == [class_name]:
            out[HINT + "discriminator"] = True
    if row.get("overflow"):
        out[HINT + "open-vocabulary"] = True
        out[HINT + "open-vocab"] = True
    if row.get("min") is not None and (counts["integer"] or counts["number"]):
        out["minimum"], out["maximum"] = _number(row["min"]), _number(row["max"])
    if node.children:
        out |= _object(node, class_name, record_count, counts["object"])
    if node.items is not None:
        out["items"] = _property(node.items, class_name, record_count)
    return out


def _number(x: float) -> int | float:
    return int(x) if float(x).is_integer() else x


def _object(node: Node, class_name: str, record_count: int, present: int, in_items: bool = False, plain: bool = False) -> dict:
    made = {k: _property(c, class_name, record_count) for k, c in sorted(node.children.items())}
    if not plain and in_items and looks_like_dictionary(list(made)):
        kinds = {json.dumps(v, sort_keys=True) for v in made.values()}
        return {"additionalProperties": json.loads(kinds.pop()) if len(kinds) == 1 else {}}
    required = sorted(k for k, c in node.children.items() if c.row and c.row["presence"] == present)
    return {"properties": made} | ({"required": required} if required else {})


def extract_definitions(schema: dict) -> dict:
    """Array-item objects move to ``$defs`` by content (equal ones share one); names are scoped by their property."""
    found: dict[str, tuple[str, dict]] = {}

    def walk(name: str, node):  # noqa: ANN001, ANN202
        if not isinstance(node, dict):
            return node
        node = {k: ({n: walk(n, p) for n, p in v.items()} if k == "properties" else walk(name, v) if k == "items" else v) for k, v in node.items()}
        item = node.get("items")
        if isinstance(item, dict) and item.get("properties"):
            digest = hashlib.sha256(json.dumps(item, sort_keys=True).encode()).hexdigest()
            if digest not in found:
                own, n = pascal(singular(name)), 2
                taken = {x for x, _ in found.values()}
                label = own
                while label in taken:
                    label, n = f"{own}_{n}", n + 1
                found[digest] = (label, item)
            node["items"] = {"$ref": f"#/$defs/{found[digest][0]}"}
        return node

    out = walk("", schema)
    return out | ({"$defs": {label: item for label, item in sorted(found.values())}} if found else {})


CONSTRAINED = ("enum", "minimum", "maximum", "format", HINT + "iri-promotion")


class Extraction:
    """Schemas that several properties share: constrained primitives and the objects in arrays, once by content.

    Names are scoped by class (``IriString`` is common to all); different contents of one name are numbered
    from ``_2``. Objects that stand directly under a property stay inline.
    """

    def __init__(self, base: str):
        self.base, self.by_content, self.names = base, {}, {}
        self.found: dict[str, dict[str, dict]] = {"primitives": {}, "objects": {}}

    def reference(self, kind: str, name: str, schema: dict) -> dict:
        content = json.dumps(schema, sort_keys=True)
        if content not in self.by_content:
            n = self.names[name] = self.names.get(name, 0) + 1
            label = name if n == 1 else f"{name}_{n}"
            ident = f"{self.base}schemas/inferred/{kind}/{label}.draft.json"
            self.by_content[content] = ident
            self.found[kind][label] = {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": ident, "title": label} | schema
        return {"$ref": self.by_content[content]}

    def placed(self, name: str, class_name: str, schema: dict, inside: bool = False) -> dict:
        """A property's schema with what is shared taken out; ``inside`` an extracted object, nested objects go too."""
        if "$ref" in schema:
            return schema
        if schema.get("properties") is not None:
            return self.object(name, class_name, schema) if inside else schema
        items = schema.get("items")
        if isinstance(items, dict):
            if items.get("properties") is not None:
                return schema | {"items": self.object(name, class_name, items)}
            if self.constrained(items):
                own = item_name(name)
                return schema | {"items": self.reference("primitives", primitive_name(own, class_name, items), items)}
            return schema
        if self.constrained(schema):
            return self.reference("primitives", primitive_name(name, class_name, schema), schema)
        return schema

    def object(self, name: str, class_name: str, schema: dict) -> dict:
        own, made = object_name(name, class_name), dict(schema)
        properties = schema["properties"]
        if looks_like_dictionary(sorted(properties)):
            first = next((properties[k] for k in sorted(properties) if isinstance(properties[k], dict)), None)
            if first is not None:
                del made["properties"]
                made.pop("required", None)
                made["additionalProperties"] = self.placed("Entry", own, first, True)
        else:
            made["properties"] = {k: self.placed(k, own, v, True) if isinstance(v, dict) else v for k, v in sorted(properties.items())}
        return self.reference("objects", own, made)

    @staticmethod
    def constrained(schema: dict) -> bool:
        return "oneOf" not in schema and any(k in schema for k in CONSTRAINED)


def induced_set(shapes: list[dict], base: str = "urn:schema:") -> dict[str, dict[str, dict]]:
    """Draft schemas as three sets by name: ``classes``, and the ``primitives`` and ``objects`` that they refer to."""
    extraction, classes = Extraction(base), {}
    for name, (count, root) in sorted(_trees(shapes).items()):
        body = _object(root, name, count, count, plain=True)
        body["properties"] = {k: extraction.placed(k, name, v) for k, v in body["properties"].items()}
        head = {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": f"{base}schemas/inferred/{name}.draft.json", "title": name, HINT + "class": f"{base}{name}", "type": "object", "additionalProperties": True}
        classes[name] = sort_keys(head | body)
    return {"classes": classes} | {k: {n: sort_keys(v) for n, v in sorted(found.items())} for k, found in extraction.found.items()}


def _trees(shapes: list[dict]) -> dict[str, tuple[int, Node]]:
    """By class the number of its records and the tree of its properties."""
    classes: dict[str, tuple[int, Node]] = {}
    for row in sorted(shapes, key=lambda r: (r["class_name"], r["path"])):
        _, root = classes.setdefault(row["class_name"], (row["record_count"], Node()))
        node = root
        for step in steps(row["path"]):
            node = node.child(step)
        node.row = row
    return classes


def materialize(shapes: list[dict], base: str = "urn:schema:") -> dict[str, dict]:
    """A draft schema for each class from collected observation rows (bounded by classes and properties)."""
    classes = _trees(shapes)
    out = {}
    for name, (count, root) in sorted(classes.items()):
        body = {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": f"{base}{name}", "title": name, "type": "object"} | _object(root, name, count, count)
        out[name] = sort_keys(extract_definitions(body))
    return out


def sort_keys(value):  # noqa: ANN001, ANN201
    """The document with all keys in order."""
    if isinstance(value, dict):
        return {k: sort_keys(value[k]) for k in sorted(value)}
    return [sort_keys(v) for v in value] if isinstance(value, list) else value


def induce(records: DataFrame, class_name: str = "class_name", base: str = "urn:schema:") -> dict[str, dict]:
    """Draft schemas of classified records: the aggregation runs in Spark, its result is a row per property."""
    return materialize([r.asDict() for r in shape_cache(records, class_name).collect()], base)


def to_text(schema: dict) -> str:
    """Two-space JSON with sorted keys and a final line feed."""
    return json.dumps(sort_keys(schema), indent=2, ensure_ascii=False) + "\n"
