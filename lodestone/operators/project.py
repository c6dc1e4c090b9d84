"""Projection of classified records to quads, and the enrichers.

Quads are rows (rid, s_type, s, p, o_type, o, o_datatype, o_lang, g); term types are ``iri``, ``blank`` and
``literal``, a null ``g`` is the default graph. A record's quads are built as one array expression and
exploded once, so projection and all enrichers that need the record alone cost one pass; only class
inheritance joins (against a small closure table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.iri import PREFIXES, RDF_TYPE, XSD, XSD_STRING, expand_curie, sanitize_iri, segment, vocab
from lodestone.functions.plan import once, settled
from lodestone.functions.pointer import kind, string_at, value_at
from lodestone.plans.schema import compile_schema

QUAD = "struct<s_type:string,s:string,p:string,o_type:string,o:string,o_datatype:string,o_lang:string,g:string>"
TERMS = ["s_type", "s", "p", "o_type", "o", "o_datatype", "o_lang", "g"]
def NONE() -> Column:  # noqa: N802
    """A null text."""
    return F.lit(None).cast("string")



def quad(s: Column, p: Column | str, o: Column, g: Column | None = None, o_type: str = "iri", datatype: Column | str | None = None, lang: Column | str | None = None) -> Column:
    """A quad struct; literals without a datatype or language are strings."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    if o_type == "literal" and datatype is None:
        datatype = XSD_STRING if lang is None else PREFIXES["rdf"] + "langString"
    return F.struct(
        F.lit("iri").alias("s_type"), s.alias("s"), lit(p).alias("p"), F.lit(o_type).alias("o_type"), o.alias("o"),
        (lit(datatype) if datatype is not None else NONE()).cast("string").alias("o_datatype"),
        (lit(lang) if lang is not None else NONE()).cast("string").alias("o_lang"),
        (g if g is not None else NONE()).alias("g"),
    ).cast(QUAD)


def type_quad(subject: Column, class_iri: Column, g: Column | None = None) -> Column:
    """``s rdf:type class``."""
    return quad(subject, RDF_TYPE, class_iri, g)


def scalar_literal(value: Column, own: Column) -> tuple[Column, Column]:
    """Lexical form and datatype of a scalar VARIANT of a known kind; NULL for null, objects and arrays."""
    number = F.try_variant_get(value, "$", "double")
    whole = (own == "number") & (number == F.floor(number))
    text = (
        F.when(own == "string", F.try_variant_get(value, "$", "string"))
        .when(own == "boolean", F.try_variant_get(value, "$", "boolean").cast("string"))
        .when(whole & (F.abs(number) < 1e15), number.cast("long").cast("string"))
        .when(own == "number", F.to_json(value))
    )
    datatype = F.when(own == "string", F.lit(XSD_STRING)).when(own == "boolean", F.lit(XSD + "boolean")).when(whole, F.lit(XSD + "integer")).when(own == "number", F.lit(XSD + "decimal"))
    return text, datatype


def property_quads(rec: Column, subject: Column, base: str, properties: dict[str, dict], g: Column | None = None, depth: int = 4) -> Column:
    """array of quads for the listed properties of a record (or nested object).

    ``properties`` maps names to ``{kind: literal | iri | object, iri?, properties?}``; arrays give one quad an
    element; nested objects become skolem subjects ``<s>/<name>`` (``/<index>`` in arrays) with their own
    properties. Nulls, and values of another kind, give nothing.
    """
    parts = [_one_property(rec, subject, base, name, spec, g, depth) for name, spec in properties.items() if spec.get("kind") != "object" or depth > 0]
    return F.concat(*parts) if parts else F.array().cast(f"array<{QUAD}>")


def _one_property(rec: Column, subject: Column, base: str, name: str, spec: dict, g: Column | None, depth: int) -> Column:
    value = value_at(rec, "/" + name.replace("~", "~0").replace("/", "~1"))
    p = F.lit(spec["iri"]) if spec.get("iri") else vocab(base, name)
    listed, none = F.try_variant_get(value, "$", "array<variant>"), F.array().cast(f"array<{QUAD}>")
    many = listed.isNotNull()
    items = F.coalesce(listed, F.when(value.isNotNull(), F.array(value)), F.array().cast("array<variant>"))

    def nested(v: Column, i: Column) -> Column:
        own = F.when(many, F.concat(subject, F.lit(f"/{name}/"), i.cast("string"))).otherwise(F.concat(subject, F.lit(f"/{name}")))
        link = [quad(subject, p, own, g)] + ([type_quad(own, vocab(base, spec["class"]), g)] if spec.get("class") else [])
        return F.when(kind(v) == "object", F.concat(F.array(*link), property_quads(v, own, base, spec.get("properties", {}), g, depth - 1))).otherwise(none)

    def literal(x: Column) -> Column:
        text, datatype = scalar_literal(x["v"], x["k"])
        return quad(subject, p, text, g, "literal", datatype)

    if spec.get("kind") == "object":
        return F.flatten(F.transform(items, nested))
    if spec.get("kind") == "iri":
        texts = F.filter(F.transform(items, lambda v: F.when(kind(v) == "string", F.try_variant_get(v, "$", "string"))), lambda t: t.isNotNull() & (t != ""))
        return F.transform(texts, lambda t: quad(subject, p, sanitize_iri(t), g))
    told = F.transform(items, lambda v: F.struct(v.alias("v"), kind(v).alias("k")))
    return F.filter(F.transform(told, literal), lambda q: q["o"].isNotNull())


def project(records: DataFrame, classes: dict[str, dict], base: str, subject: Column, class_name: Column, graphs: dict[str, str] | None = None, rec: str = "rec") -> DataFrame:
    """``records`` with subject, quads (array) and bucket: the projection by class.

    ``classes`` maps class names to ``{iri?, properties, schema?, projector?}``. A class without an entry falls
    back to ``Generic`` with a warning; without that either, the record goes to the bucket ``projection`` with
    SQUASH_NO_SCHEMA_FOR_CLASS. A record that its class's strict ``schema`` does not admit is projected all the
    same, with the warning PROJECTION_CONSTRAINT_VIOLATION. A ``projector`` (record, subject, graph to an array of
    quads) stands for the properties; where it gives NULL the record goes to the bucket with
    SQUASH_PROJECTION_FAILED, while an empty array is a success. Graphs: the class's own, else ``default``, else the
    default graph.
    """
    graphs = graphs or {}
    known = list(classes)
    fallback = "Generic" in classes
    effective = F.when(class_name.isin(*known), class_name).otherwise(F.lit("Generic")) if fallback else F.when(class_name.isin(*known), class_name)
    g = F.lit(graphs.get("default")).cast("string")
    for c, iri in graphs.items():
        if c != "default":
            g = F.when(class_name == c, F.lit(iri)).otherwise(g)
    out = records.withColumns({"subject": subject, "_class": effective, "_g": g, "class_name": class_name})
    none, quads, strict = F.array().cast(f"array<{QUAD}>"), F.array().cast(f"array<{QUAD}>"), F.lit(True)
    for c, spec in classes.items():
        iri = F.lit(spec.get("iri") or f"{base.rstrip('#/')}/{c}")
        if spec.get("projector"):
            own = spec["projector"](F.col(rec), F.col("subject"), F.col("_g")).cast(f"array<{QUAD}>")
        else:
            own = F.concat(F.array(type_quad(F.col("subject"), iri, F.col("_g"))), property_quads(F.col(rec), F.col("subject"), base, spec.get("properties", {}), F.col("_g")))
        quads = F.when(F.col("_class") == c, own).otherwise(quads)
        if spec.get("schema"):
            strict = F.when(F.col("_class") == c, compile_schema(F.col(rec), spec["schema"])).otherwise(strict)
    warnings = F.array_compact(F.array(
        F.when(F.col("_class").isNotNull() & (F.col("_class") != F.col("class_name")), F.lit("PROJECTION_GENERIC_FALLBACK")),
        F.when(F.col("_class").isNotNull() & ~strict, F.lit("PROJECTION_CONSTRAINT_VIOLATION")),
    ))
    out = out.withColumn("_made", settled(quads))
    error = F.when(F.col("_class").isNull() & F.col("class_name").isNotNull(), F.lit("SQUASH_NO_SCHEMA_FOR_CLASS")).when(F.col("_class").isNotNull() & F.col("_made").isNull(), F.lit("SQUASH_PROJECTION_FAILED"))
    return out.withColumns({"quads": F.coalesce("_made", none), "projection_warnings": warnings.cast("array<string>"), "projection_error": error}).drop("_class", "_g", "_made")


def exploded(projected: DataFrame, rid: str = "rid", quads: str = "quads") -> DataFrame:
    """The quads as rows."""
    return projected.select(F.col(rid).alias("rid"), F.explode(quads).alias("q")).select("rid", "q.*")


def deduplicated(quads: DataFrame, value_only: bool = False) -> DataFrame:
    """Each quad once, over all terms; ``value_only`` compares (s, p, o, g) alone."""
    if value_only:
        return quads.drop("rid").groupBy("s", "p", "o", "g").agg(*[F.min(c).alias(c) for c in ("s_type", "o_type", "o_datatype", "o_lang")]).select(*TERMS)
    return quads.select(*TERMS).distinct()


# Enrichers over records.


def array_enum(rec: Column, subject: Column, base: str, ranges: dict[str, str], g: Column | None = None) -> Column:
    """Elements of array properties as IRIs ``<base>#<Range>-<element>``; empty and other elements are passed over."""
    parts = []
    for name, range_class in sorted(ranges.items()):
        value = value_at(rec, f"/{name}")
        items = F.when(kind(value) == "array", F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array().cast("array<variant>"))
        texts = F.filter(F.transform(items, lambda v: F.when(kind(v) == "string", F.try_variant_get(v, "$", "string"))), lambda t: t.isNotNull() & (t != ""))
        parts.append(_enumerated(texts, subject, base, name, range_class, g))
    return F.concat(*parts) if parts else F.array().cast(f"array<{QUAD}>")


def _enumerated(texts: Column, subject: Column, base: str, name: str, range_class: str, g: Column | None) -> Column:
    return F.transform(texts, lambda t: quad(subject, vocab(base, name), vocab(base, F.concat(F.lit(range_class + "-"), segment(t))), g))


def coerced(value: Column, datatype: str) -> Column:
    """The lexical form of a value as an ``xsd:`` type, NULL if it has none."""
    text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))

    def numeric(form) -> Column:  # noqa: ANN001
        return once(text.try_cast("double"), lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), form(x)))

    forms = {
        "xsd:string": lambda: text,
        "xsd:integer": lambda: numeric(lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("long").cast("string")),
        "xsd:number": lambda: numeric(lambda x: F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))),
        "xsd:boolean": lambda: once(text, lambda t: F.when(t.isin("true", "1"), F.lit("true")).when(t.isin("false", "0"), F.lit("false"))),
    }
    return forms.get(datatype, NONE)()


def skolem(rec: Column, subject: Column, base: str, entries: dict[str, dict], g: Column | None = None) -> Column:
    """Fields as typed subjects of their own: ``{fragment, type, properties?: {name: xsd:type}}`` by field."""
    datatypes = {"xsd:string": XSD_STRING, "xsd:integer": XSD + "integer", "xsd:number": XSD + "decimal", "xsd:boolean": XSD + "boolean"}

    def made(x: Column, name: str, e: dict) -> Column:
        value, own = x["v"], F.concat(subject, F.lit("#" + e["fragment"]))
        rows = [type_quad(own, vocab(base, e["type"]), g), quad(subject, vocab(base, name), own, g)]
        for prop, datatype in sorted(e.get("properties", {}).items()):
            raw = F.when(x["k"] == "object", F.try_variant_get(value, f'$["{prop}"]', "variant")).otherwise(value)
            text = once(raw, lambda v: F.when(~F.is_variant_null(v), coerced(v, datatype)))
            rows.append(once(text, lambda t: F.when(t.isNotNull(), quad(own, vocab(base, prop), t, g, "literal", datatypes.get(datatype, XSD_STRING)))))
        there = value.isNotNull() & ~F.is_variant_null(value)
        return F.when(there, F.array_compact(F.array(*rows))).otherwise(F.array().cast(f"array<{QUAD}>"))

    parts = []
    for name, e in sorted(entries.items()):
        value = value_at(rec, f"/{name}")
        parts.append(once(F.struct(value.alias("v"), kind(value).alias("k")), lambda x: made(x, name, e)))
    return F.concat(*parts) if parts else F.array().cast(f"array<{QUAD}>")


def provenance_iri(rec: Column, subject: Column, from_: str, predicate: str, g: Column | None = None) -> Column:
    """The text at a pointer as an IRI object."""
    iri = F.nullif(string_at(rec, from_), F.lit(""))
    return F.when(iri.isNotNull(), F.array(quad(subject, expand_curie(F.lit(predicate)), iri, g))).otherwise(F.array().cast(f"array<{QUAD}>"))


def record_provenance(run_base: str, subject: Column, evidence: Column, run_start: str, graph: str | None = None, parts: tuple[str, ...] = ("classifier", "confidence", "timestamp", "reasons")) -> Column:
    """PROV-O quads of a record's classification; the activity is named by the subject's hash."""
    root = run_base if run_base.endswith("/") else run_base + "/"
    prov, g = PREFIXES["prov"], F.lit(graph).cast("string")
    activity = F.concat(F.lit(root + "run/"), F.substring(F.sha1(subject.cast("binary")), 1, 8))
    rows = [type_quad(activity, F.lit(prov + "Activity"), g), quad(subject, prov + "wasGeneratedBy", activity, g)]
    if "classifier" in parts:
        rows.append(F.when(evidence["engine"].isNotNull(), quad(activity, prov + "wasAssociatedWith", F.concat(F.lit(root + "classifier/"), segment(evidence["engine"])), g)))
    if "confidence" in parts:
        rows.append(F.when(evidence["confidence"].isNotNull(), quad(activity, vocab(run_base, "confidence"), evidence["confidence"].cast("string"), g, "literal", XSD + "decimal")))
    if "timestamp" in parts:
        rows.append(quad(activity, prov + "startedAtTime", F.lit(run_start), g, "literal", XSD + "dateTime"))
    made = F.array_compact(F.array(*rows))
    if "reasons" in parts:
        made = F.concat(made, F.transform(F.coalesce(evidence["reasons"], F.array().cast("array<string>")), lambda r: quad(activity, vocab(run_base, "reason"), r, g, "literal")))
    return made


# Enrichers over quads.


def override_predicates(quads: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Predicates that end in ``#field`` become the given CURIE's IRI (the first by name that fits)."""
    p = F.col("p")
    for name, curie in sorted(overrides.items(), reverse=True):
        p = F.when(F.col("p").endswith(f"#{name}"), expand_curie(F.lit(curie))).otherwise(p)
    return quads.withColumn("p", p)


def with_inverses(quads: DataFrame, inverses: dict[str, str], base: str) -> DataFrame:
    """For IRI objects of a property also the inverse statement."""
    added = []
    for forward, inverse in sorted(inverses.items()):
        own = quads.where((F.col("o_type") == "iri") & (F.col("p") == vocab(base, forward)))
        added.append(own.select(*[c for c in quads.columns if c not in TERMS], F.lit("iri").alias("s_type"), F.col("o").alias("s"), vocab(base, inverse).alias("p"), F.lit("iri").alias("o_type"), F.col("s").alias("o"), NONE().alias("o_datatype"), NONE().alias("o_lang"), "g"))
    return reduce(lambda a, b: a.unionByName(b), added, quads)


def inherited_types(quads: DataFrame, closure: DataFrame) -> DataFrame:
    """``quads`` and an rdf:type for every ancestor (``closure``: sub, sup IRIs) that is not there yet."""
    typed = quads.where((F.col("p") == RDF_TYPE) & (F.col("o_type") == "iri"))
    more = typed.join(closure, typed["o"] == closure["sub"]).select(*[F.col("sup").alias("o") if c == "o" else typed[c] for c in typed.columns]).distinct()
    own = [c for c in typed.columns if c in ("s", "p", "o", "g")]
    fresh = more.alias("m").join(typed.alias("t"), reduce(lambda a, b: a & b, [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in own]), "left_anti")
    return quads.unionByName(fresh)
