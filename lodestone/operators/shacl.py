"""SHACL gate: a subset of constraints compiled to joins and aggregates over quads.

Shapes: ``{iri, targetClass, properties: [{path, minCount, maxCount, datatype, nodeKind, pattern, in, class,
severity, message}]}``. Every violation is a row (severity, focus, path, constraint, message).
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.iri import PREFIXES, RDF_TYPE, XSD
from lodestone.functions.plan import remove_folder, written

SH, RDF = PREFIXES["sh"], PREFIXES["rdf"]

SUPPORTED = frozenset("path minCount maxCount datatype nodeKind pattern in class severity message".split())


def violations(quads: DataFrame, shapes: list[dict]) -> DataFrame:
    """All violations of the shapes; an unsupported constraint is an error when the plan is built."""
    typed = quads.where((F.col("p") == RDF_TYPE) & (F.col("o_type") == "iri")).select(F.col("s").alias("focus"), F.col("o").alias("class")).distinct()
    parts = []
    for shape in shapes:
        targets = typed.where(F.col("class") == shape["targetClass"]).select("focus")
        for spec in shape["properties"]:
            if unknown := set(spec) - SUPPORTED:
                raise ValueError(f"unsupported constraints: {sorted(unknown)}")
            values = quads.where(F.col("p") == spec["path"])
            if "minCount" in spec or "maxCount" in spec:
                counts = targets.join(values.select(F.col("s").alias("focus"), "o_type", "o", "o_datatype", "o_lang").distinct().groupBy("focus").agg(F.count(F.lit(1)).alias("n")), "focus", "left").withColumn("n", F.coalesce("n", F.lit(0)))
                for name, test in (("minCount", F.col("n") < spec.get("minCount", 0)), ("maxCount", F.col("n") > spec.get("maxCount", 1 << 62))):
                    if name in spec:
                        parts.append(_told(counts.where(test), spec, name, f"{name} {spec[name]}"))
            tests = {
                "datatype": lambda v: (F.col("o_type") != "literal") | (F.col("o_datatype") != v),
                "nodeKind": lambda v: F.col("o_type") != {"IRI": "iri", "Literal": "literal", "BlankNode": "blank"}[v.replace("#", "/").rsplit("/", 1)[-1].split(":")[-1]],
                "pattern": lambda v: ~F.col("o").rlike(v),
                "in": lambda v: ~F.col("o").isin(*v),
            }
            own = values.join(targets.withColumnRenamed("focus", "s"), "s", "left_semi").withColumn("focus", F.col("s"))
            for name, test in tests.items():
                if name in spec:
                    parts.append(_told(own.where(test(spec[name])), spec, name, f"{name} {spec[name]}"))
            if "class" in spec:
                members = typed.where(F.col("class") == spec["class"]).select(F.col("focus").alias("o"))
                parts.append(_told(own.join(members, "o", "left_anti"), spec, "class", f"class {spec['class']}"))
    if not parts:
        return quads.limit(0).select(*[F.lit("").alias(c) for c in ("severity", "focus", "path", "constraint", "message")])
    return reduce(lambda a, b: a.unionByName(b), parts)


def _told(rows: DataFrame, spec: dict, constraint: str, message: str) -> DataFrame:
    return rows.select(F.lit(spec.get("severity", "Violation")).alias("severity"), "focus", F.lit(spec["path"]).alias("path"), F.lit(constraint).alias("constraint"), F.lit(spec.get("message", message)).alias("message")).distinct()


def report_lines(found: DataFrame) -> DataFrame:
    """(value): ``[severity] focus path → message``."""
    return found.select(F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.col("focus"), F.lit(" "), F.col("path"), F.lit(" → "), F.col("message")).alias("value"))


def load_shapes(path: str) -> list[dict]:
    """The node shapes of a file in any RDF format."""
    from lodestone.sources import rdf

    return shapes_of(rdf.parse_document(Path(path).read_text(encoding="utf-8"), rdf.resolve_format(path)))


def shapes_of(quads: list[tuple]) -> list[dict]:
    """Node shapes with a target class and their property shapes, as ``violations`` takes them, from a shapes graph."""
    facts: dict[tuple[str, str], list[str]] = {}
    for q in quads:
        facts.setdefault((q[1], q[2]), []).append(q[4])
    one = lambda s, p: facts.get((s, p), [None])[0]

    def listed(head: str) -> list[str]:
        out = []
        while head and head != RDF + "nil":
            out.append(one(head, RDF + "first"))
            head = one(head, RDF + "rest")
        return out

    found = []
    for shape in sorted({q[1] for q in quads if q[2] == RDF_TYPE and q[4] == SH + "NodeShape"}):
        specs = []
        for own in facts.get((shape, SH + "property"), []):
            spec: dict = {"path": one(own, SH + "path")}
            for name in ("minCount", "maxCount"):
                if (v := one(own, SH + name)) is not None:
                    spec[name] = int(v)
            for name in ("datatype", "nodeKind", "pattern", "class", "message"):
                if (v := one(own, SH + name)) is not None:
                    spec[name] = v
            if (v := one(own, SH + "in")) is not None:
                spec["in"] = listed(v)
            if (v := one(own, SH + "severity")) is not None:
                spec["severity"] = v.removeprefix(SH)
            others = {p for s, p in facts if s == own} - {SH + n for n in (*SUPPORTED, "name", "description", "order")} - {RDF_TYPE}
            if others:
                raise ValueError(f"unsupported constraints: {sorted(others)}")
            specs.append(spec)
        if one(shape, SH + "targetClass") is not None:
            found += [{"iri": shape, "targetClass": c, "properties": specs} for c in facts[shape, SH + "targetClass"]]
    return found


def report_quads(found: DataFrame) -> DataFrame:
    """The violations as a SHACL validation report: a result of its own for each, named by its content."""
    report = F.lit("urn:shacl:report")
    result = F.concat(F.lit("urn:shacl:result:"), F.sha1(F.concat_ws("|", "severity", "focus", "path", "constraint", "message").cast("binary")))
    iri = lambda s, p, o: F.struct(s.alias("s"), F.lit(p).alias("p"), F.lit("iri").alias("o_type"), o.alias("o"), F.lit(None).cast("string").alias("o_datatype"))
    text = lambda s, p, o: F.struct(s.alias("s"), F.lit(p).alias("p"), F.lit("literal").alias("o_type"), o.alias("o"), F.lit(XSD + "string").alias("o_datatype"))
    rows = [
        iri(report, RDF_TYPE, F.lit(SH + "ValidationReport")), F.struct(report.alias("s"), F.lit(SH + "conforms").alias("p"), F.lit("literal").alias("o_type"), F.lit("false").alias("o"), F.lit(XSD + "boolean").alias("o_datatype")),
        iri(report, SH + "result", result), iri(result, RDF_TYPE, F.lit(SH + "ValidationResult")), iri(result, SH + "resultSeverity", F.concat(F.lit(SH), F.col("severity"))), iri(result, SH + "focusNode", F.col("focus")),
        iri(result, SH + "resultPath", F.col("path")), text(result, SH + "resultMessage", F.col("message")), text(result, SH + "sourceConstraintComponent", F.col("constraint")),
    ]
    told = found.select(F.explode(F.array(*rows)).alias("q")).select("q.*").distinct()
    return told.select(F.lit("iri").alias("s_type"), "s", "p", "o_type", "o", "o_datatype", F.lit(None).cast("string").alias("o_lang"), F.lit(None).cast("string").alias("g"))


class ShaclError(RuntimeError):
    """The data does not conform; ``report`` has the first lines."""

    def __init__(self, count: int, report: list[str]):
        super().__init__(f"{count} SHACL violations")
        self.count, self.report = count, report


def gate(quads: DataFrame, shapes: list[dict], artifacts: str | None = None, lines: int = 1000) -> None:
    """Raises ShaclError if a shape is violated, after writing the whole report, as text and Turtle, under ``artifacts``."""
    from lodestone.sources import sinks

    # Found once: the count and both reports are made of what is staged.
    found, at = written(violations(quads, shapes))
    try:
        n = found.count()
        if n:
            told = report_lines(found)
            if artifacts:
                told.write.mode("overwrite").text(f"{artifacts}/validation.report")
                sinks.write_turtle(report_quads(found), f"{artifacts}/validation.report.ttl", {"sh": SH})
            raise ShaclError(n, [r.value for r in told.orderBy("value").limit(lines).collect()])
    finally:
        remove_folder(quads.sparkSession, at)
