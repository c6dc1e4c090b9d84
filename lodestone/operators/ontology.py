"""Ontology documents on the driver: class maps, ancestors, denormalised and relaxed schemas, TBox and SHACL quads.

Schemas are bounded by the number of classes; what executors need of them becomes small DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.functions.iri import PREFIXES, RDF_TYPE, XSD
from lodestone.operators.project import TERMS

REF_DEPTH = 4
# Keywords that relaxing takes away.
CONSTRAINTS = frozenset("required additionalProperties enum const pattern minLength maxLength minimum maximum minItems maxItems uniqueItems format".split())
DATATYPES = {"string": XSD + "string", "integer": XSD + "integer", "number": XSD + "decimal", "boolean": XSD + "boolean"}


class Ontology:
    """Schemas by class name; parents by ``allOf`` references to other classes."""

    def __init__(self, schemas: dict[str, dict], base: str, extracted: dict[str, dict] | None = None):
        self.schemas, self.base = schemas, base.rstrip("#/")
        #: Primitives and objects that induction took out, by their identifiers.
        self.extracted = {s["$id"]: s for s in (extracted or {}).values() if "$id" in s}
        self.by_id = {s.get("$id", name): name for name, s in schemas.items()}

    def iri(self, name: str) -> str:
        """The IRI of a class."""
        return f"{self.base}/{name}"

    def _class(self, ref: str) -> str | None:
        if ref in self.by_id:
            return self.by_id[ref]
        last = ref.replace("#", "/").rstrip("/").rsplit("/", 1)[-1].removesuffix(".schema.json")
        return last if last in self.schemas else None

    def parents(self, name: str) -> list[str]:
        """Direct parents in order."""
        refs = [p["$ref"] for p in self.schemas[name].get("allOf", []) if isinstance(p, dict) and "$ref" in p]
        return [c for r in refs if (c := self._class(r)) is not None]

    def ancestors(self, name: str) -> list[str]:
        """Parents first, then each parent's ancestors; cycles end."""
        found: list[str] = []

        def visit(c: str) -> None:
            own = [p for p in self.parents(c) if p not in found and p != name]
            found.extend(own)
            for p in own:
                visit(p)

        visit(name)
        return found

    def denormalized(self, name: str, depth: int = REF_DEPTH, seen: tuple[str, ...] = ()) -> dict:
        """The schema with references inlined (to a depth, no cycles) and parents' properties; own ones win."""
        own = self.schemas[name]
        merged: dict = {}
        for parent in reversed(self.parents(name)):
            if parent not in seen:
                merged |= self.denormalized(parent, depth, (*seen, name)).get("properties", {})
        merged |= own.get("properties", {})
        return {k: v for k, v in own.items() if k not in ("allOf", "$defs")} | {"properties": {k: self._inlined(v, own, depth, (*seen, name)) for k, v in merged.items()}}

    def _inlined(self, node, root: dict, depth: int, seen: tuple[str, ...]):  # noqa: ANN001, ANN202
        if isinstance(node, list):
            return [self._inlined(v, root, depth, seen) for v in node]
        if not isinstance(node, dict):
            return node
        ref = node.get("$ref")
        if ref is not None:
            if depth <= 0:
                return {"type": "object"}
            if ref.startswith("#/$defs/"):
                return self._inlined(root.get("$defs", {}).get(ref[8:], {}), root, depth - 1, seen)
            if ref in self.extracted:
                return self._inlined({k: v for k, v in self.extracted[ref].items() if k not in ("$id", "$schema", "title")}, self.extracted[ref], depth - 1, seen)
            c = self._class(ref)
            return {"type": "object"} if c is None or c in seen else self.denormalized(c, depth - 1, seen)
        return {k: self._inlined(v, root, depth, seen) for k, v in node.items()}

    def properties(self, name: str) -> dict[str, dict]:
        """What ``property_quads`` needs: kind, and nested properties."""
        return _kinds(self.denormalized(name))

    def subclass_table(self, spark: SparkSession) -> DataFrame:
        """(sub, sup, depth): every class with each of its ancestors' IRIs."""
        rows = [(self.iri(c), self.iri(a), i) for c in self.schemas for i, a in enumerate(self.ancestors(c))]
        return spark.createDataFrame(rows, "sub string, sup string, depth int")

    def tbox(self, graph: str | None = None) -> list[tuple]:
        """OWL classes, subclass edges, properties and SHACL node shapes as quads."""
        owl, rdfs, sh, out = PREFIXES["owl"], PREFIXES["rdfs"], PREFIXES["sh"], []
        add = lambda s, p, o, datatype=None: out.append(("iri", s, p, "literal" if datatype else "iri", o, datatype, None, graph))
        for name, schema in sorted(self.schemas.items()):
            iri, shape = self.iri(name), self.iri(name) + "Shape"
            add(iri, RDF_TYPE, owl + "Class")
            add(iri, rdfs + "label", schema.get("title", name), XSD + "string")
            for parent in self.parents(name):
                add(iri, rdfs + "subClassOf", self.iri(parent))
            add(shape, RDF_TYPE, sh + "NodeShape")
            add(shape, sh + "targetClass", iri)
            for prop, spec in sorted(schema.get("properties", {}).items()):
                p, own = f"{self.base}#{prop}", f"{shape}/{prop}"
                kind = spec.get("type") if isinstance(spec.get("type"), str) else None
                is_iri = spec.get("format") == "iri" or kind in ("object",)
                add(p, RDF_TYPE, owl + ("ObjectProperty" if is_iri else "DatatypeProperty"))
                add(shape, sh + "property", own)
                add(own, sh + "path", p)
                if kind in DATATYPES and not is_iri:
                    add(own, sh + "datatype", DATATYPES[kind])
                if prop in schema.get("required", []):
                    add(own, sh + "minCount", "1", XSD + "integer")
        return list(dict.fromkeys(out))

    def tbox_quads(self, spark: SparkSession, graph: str | None = None) -> DataFrame:
        """``tbox`` as a quad table."""
        return spark.createDataFrame(self.tbox(graph), ", ".join(f"{t} string" for t in TERMS))


def relaxed(schema):  # noqa: ANN001, ANN201
    """The schema without constraints, and without ``type`` on leaves."""
    if isinstance(schema, list):
        return [relaxed(v) for v in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: ({n: relaxed(p) for n, p in v.items()} if k == "properties" else relaxed(v)) for k, v in schema.items() if k not in CONSTRAINTS}
    if "properties" not in out and "items" not in out:
        out.pop("type", None)
    return out


def _kinds(schema: dict) -> dict[str, dict]:
    out = {}
    for name, spec in schema.get("properties", {}).items():
        inner = spec.get("items", spec) if isinstance(spec, dict) else {}
        if inner.get("properties"):
            out[name] = {"kind": "object", "properties": _kinds(inner)}
        else:
            out[name] = {"kind": "iri" if inner.get("format") == "iri" else "literal"}
    return out
