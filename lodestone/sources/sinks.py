"""Sinks: serialised quads, buckets, quarantine, finalisation with sidecars, reports.

Data is written by executors as directories of part files through Spark's committers. Single files (small
documents, contexts, reports) are written by the driver to a temporary name and renamed.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from dataclasses import asdict, dataclass, field
from functools import reduce
from pathlib import Path
from xml.sax.saxutils import quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.errors import FileOutputError
from lodestone.functions.iri import RDF_TYPE, compact_iri
from lodestone.functions.plan import hadoop_path, remove_folder, stored_bytes, written
from lodestone.operators import canonical, shacl
from lodestone.operators.project import TERMS, deduplicated
from lodestone.sources.rdf import QUAD_FORMATS, STAR_FORMATS, FormatError, context_document, context_terms, escaped, nquads_line

DEFAULT, OTHER = "__default__", "__other__"
#: Buckets (each a folder and a row of the report) at most; graphs that follow records need configured buckets.
MAX_BUCKETS = 10_000
#: Statements of a subject and graph in one Turtle or JSON-LD block at most; a subject may have several blocks.
BLOCK_QUADS = 10_000
#: Blocks in one Turtle or TriG file at most: such a file is read whole, by one task.
FILE_BLOCKS = 10_000


# Graph collapse, buckets and slugs.


def collapse_graph(quads: DataFrame, graph: str) -> DataFrame:
    """All quads in one graph."""
    return quads.withColumn("g", F.lit(graph))


def bucket(quads: DataFrame, strategy: str = "per-graph-iri", buckets: dict[str, str] | None = None, on_unmapped: str = "other") -> DataFrame:
    """``quads`` with their bucket: the graph, or the configured graphs with the rest to other, dropped or failing."""
    g = F.coalesce("g", F.lit(DEFAULT))
    if strategy == "per-graph-iri":
        return quads.withColumn("bucket", g)
    known = g.isin(*(buckets or {}))
    if on_unmapped == "drop":
        return quads.withColumn("bucket", g).where(known)
    rest = F.lit(OTHER) if on_unmapped == "other" else F.raise_error(F.concat(F.lit("no bucket for graph "), g)).cast("string")
    return quads.withColumn("bucket", F.when(known, g).otherwise(rest))


def base_slug(iri: Column) -> Column:
    """A file name of an IRI: path and fragment, unsafe characters to single dashes, 128 at most."""
    decoded = F.coalesce(F.try_url_decode(iri), iri)
    is_url = decoded.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    path = F.regexp_extract(decoded, "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)", 1)
    fragment = F.regexp_extract(decoded, "#(.*)$", 1)
    own = F.when(is_url, F.concat(path, fragment)).otherwise(decoded)
    trimmed = F.regexp_replace(F.regexp_replace(own, "/+$", ""), "^/+", "")
    slug = F.regexp_replace(F.regexp_replace(trimmed, "[^a-zA-Z0-9._-]", "-"), "-{2,}", "-")
    return F.substring(F.regexp_replace(slug, "^-+|-+$", ""), 1, 128)


def bucket_files(keys: DataFrame, buckets: dict[str, str] | None = None, default: str = "default") -> DataFrame:
    """(bucket, slug) of distinct buckets; equal and empty slugs get a hash of the IRI."""
    own = keys.select("bucket").distinct().withColumn("_slug", base_slug(F.col("bucket")))
    real = F.when(~F.col("bucket").isin(DEFAULT, OTHER), F.col("_slug"))
    counts = own.where(~F.col("bucket").isin(DEFAULT, OTHER)).groupBy("_slug").agg(F.count(F.lit(1)).alias("_n"))
    told = own.join(counts, "_slug", "left")
    digest = F.substring(F.sha1(F.col("bucket").cast("binary")), 1, 6)
    slug = F.when(F.col("bucket") == DEFAULT, F.lit(default)).when(F.col("bucket") == OTHER, F.lit("__other"))
    for iri, name in (buckets or {}).items():
        slug = slug.when(F.col("bucket") == iri, F.lit(name))
    slug = slug.when(real == "", digest).when(F.col("_n") > 1, F.concat(real, F.lit("-"), digest)).otherwise(real)
    return told.select("bucket", slug.alias("slug"))


def write_buckets(quads: DataFrame, path: str, fmt: str = "nquads", prefixes: dict[str, str] | None = None, context: dict | None = None, **config) -> DataFrame:
    """Every bucket in a folder of its own, in any format; returns (bucket, slug, quads).

    In formats without named graphs a bucket's folder stands for its graph.
    """
    own = bucket(quads, **config)
    names = bucket_files(own, config.get("buckets"))
    told = own.join(names, "bucket")
    shown = told if fmt in QUAD_FORMATS else told.withColumn("g", F.lit(None).cast("string"))
    head = header(fmt, prefixes or {})
    rows = serialised(shown, fmt, prefixes, context, ["slug"])
    rows.select("slug", (F.concat(F.lit(head), F.col("value")) if head else F.col("value")).alias("value")).write.mode("overwrite").partitionBy("slug").text(path)
    return told.groupBy("bucket", "slug").agg(F.count(F.lit(1)).alias("quads"))


# Serialisation.


def write_lines(quads: DataFrame, path: str, fmt: str = "nquads") -> None:
    """N-Quads or N-Triples part files; N-Triples refuse named graphs."""
    write_quads(quads, path, fmt)


def _turtle_term(kind: str, value: str, prefixes: dict[str, str]) -> Column:
    iri = F.concat(F.lit("<"), F.col(value), F.lit(">"))
    for label, base in sorted(prefixes.items(), key=lambda p: (len(p[1]), p[0])):
        local = F.col(value).substr(F.lit(len(base) + 1), F.length(value))
        iri = F.when(F.col(value).startswith(base) & local.rlike("^[A-Za-z_][A-Za-z0-9_-]*$"), F.concat(F.lit(f"{label}:"), local)).otherwise(iri)
    return F.when(F.col(kind) == "blank", F.concat(F.lit("_:"), F.col(value))).when(F.col(kind) == "triple", F.col(value)).otherwise(iri)


def _blocks(quads: DataFrame, keys: list[str]) -> DataFrame:
    """``quads`` with ``_k``: 0, or for subjects of over BLOCK_QUADS statements the number of the block each goes to."""
    hubs = quads.groupBy(*keys, "s").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BLOCK_QUADS)
    hubs = hubs.select("_n", *[F.col(c).alias(f"_hub_{c}") for c in (*keys, "s")])
    joined = quads.join(hubs, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_hub_{c}")) for c in (*keys, "s")]), "left")
    dealt = F.pmod(F.xxhash64("p", "o", "o_datatype", "o_lang"), F.ceil(F.col("_n") / BLOCK_QUADS))
    return joined.select(*quads.columns, F.coalesce(dealt, F.lit(0)).alias("_k"))


def turtle_blocks(quads: DataFrame, prefixes: dict[str, str], more: list[str] | None = None) -> DataFrame:
    """(g, s, block): a Turtle statement a subject and graph; subjects of very many statements have several."""
    keys = ["g", *(more or [])]
    suffix = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(
        F.col("o_datatype").isNotNull() & ~F.col("o_datatype").endswith("XMLSchema#string"), F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise(F.lit(""))
    obj = F.when(F.col("o_type") == "literal", F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), suffix)).otherwise(_turtle_term("o_type", "o", prefixes))
    told = _blocks(quads, keys).withColumn("_p", F.lit("iri")).select(*keys, "_k", _turtle_term("s_type", "s", prefixes).alias("s"), F.when(F.col("p") == RDF_TYPE, F.lit("a")).otherwise(_turtle_term("_p", "p", prefixes)).alias("p"), obj.alias("o"))
    by_p = told.groupBy(*keys, "_k", "s", "p").agg(F.array_join(F.array_sort(F.collect_list("o")), ", ").alias("o"))
    by_s = by_p.groupBy(*keys, "_k", "s").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "p", "o"))), " ;\n    ").alias("b"))
    return by_s.select(*keys, "s", F.concat("s", F.lit("\n    "), F.col("b"), F.lit(" .")).alias("block"))


def jsonld_nodes(quads: DataFrame, context: dict | None = None, more: list[str] | None = None) -> DataFrame:
    """(g, s, node): JSON-LD of each subject and graph, expanded or, with a context's terms, compacted.

    Subjects of very many statements have several nodes.
    """
    keys, terms = ["g", *(more or [])], _terms(context or {})
    ident = lambda kind, v: F.when(F.col(kind) == "blank", F.concat(F.lit("_:"), F.col(v))).otherwise(F.col(v))
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), "^\\[|\\]$", "")
    short = lambda c: compact_iri(c, terms["prefixes"]) if terms["prefixes"] else c
    is_type = (F.col("p") == RDF_TYPE) & (F.col("o_type") != "literal")
    plain = F.col("o_datatype").endswith("XMLSchema#string") & F.col("o_lang").isNull()
    literal = F.to_json(F.struct(F.col("o").alias("@value"), F.when(~plain & F.col("o_lang").isNull(), short(F.col("o_datatype"))).alias("@type"), F.col("o_lang").alias("@language")))
    key, coerced, many = F.col("p"), F.lit(None).cast("string"), F.lit(False)
    for name, (iri, kind, is_set) in terms["terms"].items():
        own = F.col("p") == iri
        key = F.when(own, F.lit(name)).otherwise(key)
        coerced = F.when(own, F.lit(kind).cast("string")).otherwise(coerced)
        many = F.when(own, F.lit(is_set)).otherwise(many)
    if context is not None:
        key = F.when(key == F.col("p"), short(F.col("p"))).otherwise(key)
        literal = F.when(plain & coerced.isNull() | (F.col("o_datatype") == coerced), quoted(F.col("o"))).otherwise(literal)
    resource = F.to_json(F.struct(ident("o_type", "o").alias("@id")))
    if context is not None:
        resource = F.when(coerced == "@id", quoted(ident("o_type", "o"))).otherwise(resource)
    value = F.when(is_type, quoted(short(ident("o_type", "o")))).when(F.col("o_type") == "literal", literal).otherwise(resource)
    told = _blocks(quads, keys).select(*keys, "_k", ident("s_type", "s").alias("s"), F.when(is_type, F.lit("@type")).otherwise(key).alias("k"), value.alias("v"), many.alias("many"))
    by_p = told.groupBy(*keys, "_k", "s", "k").agg(F.array_sort(F.collect_set("v")).alias("v"), F.bool_or("many").alias("many"))
    listed = F.concat(F.lit("["), F.array_join("v", ","), F.lit("]"))
    shown = listed if context is None else F.when((F.size("v") == 1) & ~F.col("many"), F.col("v")[0]).otherwise(listed)
    by_s = by_p.groupBy(*keys, "_k", "s").agg(F.array_join(F.array_sort(F.collect_list(F.concat(quoted(F.col("k")), F.lit(":"), shown))), ",").alias("b"))
    return by_s.select(*keys, "s", F.concat(F.lit('{"@id":'), quoted(F.col("s")), F.lit(","), F.col("b"), F.lit("}")).alias("node"))


def _terms(context: dict) -> dict:
    """The prefixes of a context, and its terms as (IRI, type, whether a set)."""
    own = context.get("@context", context)
    prefixes = {k: v for k, v in own.items() if isinstance(v, str) and not k.startswith("@") and v[-1:] in "/#:"}

    def full(name: str) -> str:
        label, colon, local = name.partition(":")
        return prefixes[label] + local if colon and label in prefixes else name

    found = {k: v if isinstance(v, dict) else {"@id": v} for k, v in own.items() if not k.startswith("@") and k not in prefixes}
    kinds = {k: full(v["@type"]) if v.get("@type") not in (None, "@id") else v.get("@type") for k, v in found.items()}
    return {"prefixes": prefixes, "terms": {k: (full(v.get("@id", k)), kinds[k], v.get("@container") in ("@set", ["@set"])) for k, v in found.items()}}


def resolve_context(quads: DataFrame, context: dict | str | None, prefixes: dict[str, str]) -> dict | None:
    """A JSON-LD context given inline, inferred (``auto``) or loaded from a path; None stays None."""
    if context is None or isinstance(context, dict):
        return context
    if context == "auto":
        return context_document(context_terms(quads, prefixes), prefixes)
    return json.loads(Path(context).read_text(encoding="utf-8"))


def header(fmt: str, prefixes: dict[str, str]) -> str:
    """What a Turtle or TriG file begins with."""
    base = STAR_FORMATS[fmt][0] if fmt in STAR_FORMATS else fmt
    return "".join(f"@prefix {k}: <{v}> .\n" for k, v in sorted(prefixes.items())) if base in ("turtle", "trig") else ""


def serialised(quads: DataFrame, fmt: str, prefixes: dict[str, str] | None = None, context: dict | None = None, more: list[str] | None = None) -> DataFrame:
    """(``more``, value): the quads as texts that can stand in any order (of Turtle after its prefixes)."""
    base, prefixes, more = STAR_FORMATS[fmt][0] if fmt in STAR_FORMATS else fmt, prefixes or {}, more or []
    if fmt not in STAR_FORMATS:
        triple = (F.col("s_type") == "triple") | (F.col("o_type") == "triple")
        quads = quads.withColumn("s_type", F.when(triple, F.raise_error(F.lit("quoted triples need a format that ends in -star")).cast("string")).otherwise(F.col("s_type")))
    if base in ("ntriples", "turtle"):
        name = "N-Triples hold" if base == "ntriples" else "Turtle holds"
        quads = quads.withColumn("g", F.when(F.col("g").isNotNull(), F.raise_error(F.lit(f"{name} no named graphs; set output.graph"))).otherwise(F.lit(None).cast("string")))
    if base == "nquads":
        return quads.select(*more, nquads_line().alias("value"))
    if base == "ntriples":
        return quads.select(*more, F.when(F.col("g").isNull(), nquads_line(False)).alias("value"))
    if base in ("turtle", "trig"):
        graph = F.when(F.col("g").isNotNull(), F.concat(F.lit("<"), F.col("g"), F.lit("> {\n"), F.col("block"), F.lit("\n}"))).otherwise(F.col("block"))
        return turtle_blocks(quads, prefixes, more).select(*more, graph.alias("value"))
    if base == "jsonld":
        told = f'"@context":{json.dumps(context.get("@context", context), sort_keys=True)},' if context is not None else ""
        inner = F.regexp_replace("node", "^\\{", "{" + told.replace("\\", "\\\\").replace("$", "\\$")) if told else F.col("node")
        named = F.concat(F.lit("{" + told + '"@id":'), F.regexp_replace(F.to_json(F.array("g")), "^\\[|\\]$", ""), F.lit(',"@graph":['), F.col("node"), F.lit("]}"))
        return jsonld_nodes(quads, context, more).select(*more, F.when(F.col("g").isNotNull(), named).otherwise(inner).alias("value"))
    raise FormatError(f"unknown format {fmt!r}")


def write_quads(quads: DataFrame, path: str, fmt: str, prefixes: dict[str, str] | None = None, context: dict | None = None) -> None:
    """Part files in any format; each Turtle or TriG file begins with its prefixes, once, and has FILE_BLOCKS blocks at most."""
    rows, head = serialised(quads, fmt, prefixes, context), header(fmt, prefixes or {})
    if head:
        # The lower 33 bits number the rows of a task, and a task begins a file every FILE_BLOCKS rows.
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % FILE_BLOCKS == 0
        rows = rows.select(F.when(first, F.concat(F.lit(head), F.col("value"))).otherwise(F.col("value")).alias("value"))
    whole = (STAR_FORMATS[fmt][0] if fmt in STAR_FORMATS else fmt) in ("turtle", "trig")
    rows.write.mode("overwrite").option("maxRecordsPerFile", FILE_BLOCKS if whole else 0).text(path)


def write_turtle(quads: DataFrame, path: str, prefixes: dict[str, str], fmt: str = "turtle") -> None:
    """Part files of Turtle or TriG."""
    write_quads(quads, path, fmt, prefixes)


def write_jsonld(quads: DataFrame, path: str, context: dict | None = None) -> None:
    """Newline-delimited JSON-LD documents, one a subject; named graphs as ``@graph`` documents."""
    write_quads(quads, path, "jsonld", context=context)


def canonical_lines(quads: DataFrame) -> DataFrame:
    """(value): distinct lines in order, the canonical form of data without blank nodes (those must be skolemised first)."""
    own = quads.withColumn("s", F.when((F.col("s_type") == "blank") | (F.col("o_type") == "blank"), F.raise_error(F.lit("blank nodes: canonicalise small datasets with operators.canonical"))).otherwise(F.col("s")))
    return deduplicated(own).select(nquads_line().alias("value")).distinct().orderBy("value")


# Finalisation.


def split(quads: DataFrame, target: str) -> dict[str, DataFrame]:
    """success, ontology and prov: by graph (``urn:graph:<target>/ontology`` and ``urn:prov:*``)."""
    marked = _marked(quads, target)
    return {name: marked.where(F.col("part") == name).drop("part") for name in ("success", "ontology", "prov")}


@dataclass
class OutputReport:
    """What a sink wrote."""

    path: str
    format: str
    quad_count: int
    graph_count: int
    duration_ms: int
    bytes_written: int = 0
    errors: list[str] = field(default_factory=list)
    buckets: dict[str, int] | None = None

    def to_json(self) -> str:
        """The report as JSON."""
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> OutputReport:
        """The report of a JSON text; raises ValueError for anything else."""
        data = json.loads(text)
        kinds = {"path": str, "format": str, "quad_count": int, "graph_count": int, "duration_ms": int, "bytes_written": int, "errors": list}
        if not isinstance(data, dict) or any(not isinstance(data.get(k), t) or isinstance(data.get(k), bool) for k, t in kinds.items()):
            raise ValueError("no output report")
        return OutputReport(**{k: data.get(k) for k in (*kinds, "buckets")})


def atomic_write(path: str, text: str) -> int:
    """Writes a small driver-side file whole or not at all; returns its bytes."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=str(Path(path).parent), suffix=".partial")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)
    return len(text.encode())


def canonicalised(quads: DataFrame) -> DataFrame:
    """The distinct quads with canonical blank labels; those with blank nodes must be few (they meet on the driver)."""
    own = deduplicated(quads)
    has_blank = (F.col("s_type") == "blank") | (F.col("o_type") == "blank")
    blanks = [tuple(r) for r in own.where(has_blank).limit(20 * canonical.MAX_BLANKS + 1).collect()]
    if not blanks:
        return own
    if len(blanks) > 20 * canonical.MAX_BLANKS:
        raise FileOutputError("too many statements about blank nodes to canonicalise: skolemise them by record instead")
    named = quads.sparkSession.createDataFrame(canonical.renamed(blanks), ", ".join(f"{t} string" for t in TERMS))
    return own.where(~has_blank).unionByName(named)


def write_small(spark, path: str, text: str) -> int:  # noqa: ANN001
    """A small file written by the driver: on its own disk whole or not at all, in another store through its file system."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        return atomic_write(path, text)
    store = hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(hadoop_path(spark, path), True)
    out.write(text.encode())
    out.close()
    return len(text.encode())


def finalize(
    quads: DataFrame, path: str, fmt: str, target: str, prefixes: dict[str, str] | None = None, graph: str | None = None, bucketing: dict | None = None, dry_run: bool = False,
    canonicalize: bool = False, validate: dict | list | None = None, jsonld_context: dict | str | None = None, catalog: str | None = None,
) -> OutputReport:
    """Splits, deduplicates and writes the run's quads with sidecars for ontology, provenance and prefixes.

    The plan of the quads is computed once: what it gives is staged, and counts, checks and files are made from
    there. The post-operations apply in every mode, in this order: canonical blank labels, graph collapse, SHACL
    gate (``validate``: shapes, or their file as ``{shapes: path}``; a violation raises FileOutputError, leaves its
    report under ``<path>.quarantine/output`` and writes no data), dry run (counts, no files), buckets. Formats
    without named graphs need ``graph``. ``catalog``: an OASIS catalog of the buckets at that path.
    """
    began, spark = time.time(), quads.sparkSession
    if bucketing is not None and graph:
        raise ValueError("bucketing forbids graph")
    staged, at = written(_marked(quads, target), "part")
    part = lambda name: deduplicated(staged.where(F.col("part") == name).drop("part"))
    own = canonicalised(part("success")) if canonicalize else part("success")
    if graph:
        own = deduplicated(collapse_graph(own, graph))
    if fmt not in QUAD_FORMATS and graph:
        own = own.withColumn("g", F.lit(None).cast("string"))
    own, again = written(own)
    if validate:
        shapes = shacl.load_shapes(validate["shapes"]) if isinstance(validate, dict) else validate
        try:
            shacl.gate(own, shapes, f"{path}.quarantine/output")
        except shacl.ShaclError as e:
            raise FileOutputError(f"SHACL validation failed: {e.count} violations", {"stage": "validate", "path": path, "report": e.report}) from e
    counted = own.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce("g", F.lit(DEFAULT))).alias("g")).first()
    report = OutputReport(path, fmt, counted.n, counted.g, 0)
    if not dry_run:
        context = resolve_context(own, jsonld_context, prefixes or {}) if fmt == "jsonld" else None
        if bucketing is not None:
            told = write_buckets(own, path, fmt, prefixes, context, **bucketing).orderBy("bucket").limit(MAX_BUCKETS + 1).collect()
            if len(told) > MAX_BUCKETS:
                raise FileOutputError(f"over {MAX_BUCKETS} buckets: configure the graphs that are worth one", {"stage": "bucket", "path": path})
            report.buckets = {r.bucket: r.quads for r in told}
            report.graph_count = len(report.buckets)
            if catalog:
                write_small(spark, catalog, catalog_xml({r.bucket: f"{path}/slug={r.slug}" for r in told}))
        else:
            if canonicalize and fmt in ("nquads", "ntriples"):
                serialised(own, fmt).distinct().orderBy("value").write.mode("overwrite").text(path)
            else:
                write_quads(own, path, fmt, prefixes, context)
        report.bytes_written = stored_bytes(spark, path)
        for name, suffix in (("ontology", ".ontology"), ("prov", ".prov.nq")):
            if not part(name).isEmpty():
                write_lines(part(name), path + suffix)
        if prefixes:
            write_small(spark, f"{path}.prefixes.json", json.dumps(prefixes, indent=2, sort_keys=True) + "\n")
    for folder in (at, again):
        remove_folder(spark, folder)
    report.duration_ms = int(1000 * (time.time() - began))
    return report


def _marked(quads: DataFrame, target: str) -> DataFrame:
    """``quads`` with the part of the output that each goes to."""
    ontology = F.coalesce(F.col("g") == f"urn:graph:{target}/ontology", F.lit(False))
    prov = F.coalesce(F.col("g").startswith("urn:prov:"), F.lit(False))
    return quads.select(*TERMS, F.when(ontology, F.lit("ontology")).when(prov, F.lit("prov")).otherwise(F.lit("success")).alias("part"))


# Quarantine.


def quarantine_rows(records: DataFrame, bucket_: Column, error: Column, source: str, timestamp: str) -> DataFrame:
    """(id, target, bucket, source, input, error, timestamp) of the records with a bucket."""
    own = records.withColumn("bucket", bucket_).where("bucket IS NOT NULL")
    ident = F.sha1(F.concat_ws("#", "record_path", F.col("record_line").cast("string")).cast("binary"))
    return own.select(ident.alias("id"), "target", "bucket", F.lit(source).alias("source"), F.to_json("rec").alias("input"), error.alias("error"), F.lit(timestamp).alias("timestamp"))


def write_quarantine(rows: DataFrame, path: str) -> DataFrame:
    """JSON by bucket; returns (bucket, records)."""
    rows.write.mode("overwrite").partitionBy("bucket").json(path)
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("records"))


def catalog_xml(entries: dict[str, str]) -> str:
    """An OASIS XML catalog of names and files."""
    rows = "\n".join(f"  <uri name={quoteattr(k)} uri={quoteattr(v)}/>" for k, v in sorted(entries.items()))
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<catalog xmlns="urn:oasis:names:tc:entity:xmlns:xml:catalog">\n{rows}\n</catalog>\n'


def bucket_counts(quads: DataFrame) -> DataFrame:
    """(bucket, quads) by graph."""
    return bucket(quads).groupBy("bucket").agg(F.count(F.lit(1)).alias("quads"))


def all_terms(quads: DataFrame) -> DataFrame:
    """The quad columns alone."""
    return quads.select(*TERMS)
