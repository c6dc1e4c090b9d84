"""Declarative emitters: mapping tables from record classes to quads.

A mapping lists, by class, ``{class, subject, literals, links, lookups}``: what a hand-written emitter would
do, as data. Lookups turn a value into an IRI by a table; unknown values give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.iri import LANG_STRING, PREFIXES, XSD, XSD_STRING, slug, vocab
from lodestone.functions.pointer import string_at, value_at
from lodestone.operators.project import QUAD, coerced, quad, type_quad

DATATYPES = {"xsd:string": XSD_STRING, "xsd:integer": XSD + "integer", "xsd:number": XSD + "decimal", "xsd:boolean": XSD + "boolean"}


def emitted(rec: Column, base: str, instances: str, spec: dict, g: Column | None = None) -> Column:
    """array of quads of a record by one class's mapping.

    subject: a pointer, slugged under ``instances``/<class>/; label: a pointer (``rdfs:label`` in ``lang``);
    literals: ``{property: (pointer, xsd type)}``; links: ``{property: (pointer, class)}`` to slugged
    instances; lookups: ``{property: (pointer, {value: local name})}``.
    """
    name = string_at(rec, spec["subject"])
    subject = F.concat(F.lit(f"{instances.rstrip('/')}/{spec['class'].lower()}/"), slug(name))
    rows = [type_quad(subject, vocab(base, spec["class"]), g)]
    if spec.get("label"):
        text = string_at(rec, spec["label"])
        rows.append(F.when(text.isNotNull(), quad(subject, PREFIXES["rdfs"] + "label", text, g, "literal", LANG_STRING, spec.get("lang", "en"))))
    for prop, (pointer, datatype) in sorted(spec.get("literals", {}).items()):
        value = value_at(rec, pointer)
        text = F.when(value.isNotNull() & ~F.is_variant_null(value), coerced(value, datatype))
        rows.append(F.when(text.isNotNull(), quad(subject, vocab(base, prop), text, g, "literal", DATATYPES[datatype])))
    for prop, (pointer, target) in sorted(spec.get("links", {}).items()):
        text = F.nullif(string_at(rec, pointer), F.lit(""))
        rows.append(F.when(text.isNotNull(), quad(subject, vocab(base, prop), F.concat(F.lit(f"{instances.rstrip('/')}/{target.lower()}/"), slug(text)), g)))
    for prop, (pointer, table) in sorted(spec.get("lookups", {}).items()):
        known = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
        local = F.try_element_at(known, string_at(rec, pointer))
        rows.append(F.when(local.isNotNull(), quad(subject, vocab(base, prop), vocab(base, local), g)))
    return F.when(F.coalesce(name, F.lit("")) != "", F.array_compact(F.array(*rows))).otherwise(F.array().cast(f"array<{QUAD}>"))


def emit(records: DataFrame, class_name: Column, base: str, instances: str, mapping: dict[str, dict], rec: str = "rec") -> DataFrame:
    """``records`` with quads by their class's mapping; classes without one get none."""
    out = F.array().cast(f"array<{QUAD}>")
    for name, spec in mapping.items():
        out = F.when(class_name == name, emitted(F.col(rec), base, instances, spec)).otherwise(out)
    return records.withColumn("quads", out)
