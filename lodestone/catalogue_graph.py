"""Queries over quads: projection, enrichment, reconciliation, buckets, serialisation, graph export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.catalogue_records import table
from lodestone.functions.iri import PREFIXES, RDF_TYPE, XSD, vocab
from lodestone.functions.plan import dealt
from lodestone.operators import classify, emit, project, reconcile, shacl, viz
from lodestone.operators.project import TERMS, deduplicated, exploded, quad, type_quad
from lodestone.sources import rdf, sinks
from lodestone.sources.records import from_table

CATALOGUE: dict = {}
ESC = "replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
BASE, INSTANCES = "urn:vocab", "urn:id"
T, S, I, D = RDF_TYPE, XSD + "string", XSD + "integer", XSD + "decimal"


def query(name: str, sql: str | None = None):  # noqa: ANN201
    """Registers a query with its SQL."""

    def keep(f):  # noqa: ANN001, ANN202
        CATALOGUE[name] = (f, sql)
        return f

    return keep


def _quads(df: DataFrame, subject, made) -> DataFrame:  # noqa: ANN001
    """Quads of an array expression over rows, with their subject as rid."""
    return df.select(subject.alias("rid"), F.explode(made).alias("q")).select("rid", "q.*")


def _subject(kind: str, key: str):  # noqa: ANN202
    return F.concat(F.lit(f"{INSTANCES}/{kind}/"), F.col(key).cast("string"))


def _sql_quads(source: str, subject: str, rows: list[tuple[str, str, str, str | None]], g: str = "NULL") -> str:
    """A UNION ALL of quads: (predicate, object expression, kind, datatype)."""
    return " UNION ALL ".join(
        f"SELECT 'iri' AS s_type, {subject} AS s, '{p}' AS p, '{kind}' AS o_type, {o} AS o, {repr(d) if d else 'CAST(NULL AS VARCHAR)'} AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang, CAST({g} AS VARCHAR) AS g FROM {source}"
        for p, o, kind, d in rows
    )


NATION_SQL = _sql_quads("nation", f"'{INSTANCES}/nation/' || n_nationkey", [
    (T, f"'{BASE}/Nation'", "iri", None), (f"{BASE}#n_name", "n_name", "literal", S), (f"{BASE}#n_nationkey", "CAST(n_nationkey AS VARCHAR)", "literal", I), (f"{BASE}#n_regionkey", "CAST(n_regionkey AS VARCHAR)", "literal", I)])
CUSTOMER_SQL = _sql_quads("customer", f"'{INSTANCES}/customer/' || c_custkey", [
    (T, f"'{BASE}/Customer'", "iri", None), (f"{BASE}#c_name", "c_name", "literal", S), (f"{BASE}#c_mktsegment", "c_mktsegment", "literal", S), (f"{BASE}#c_nationkey", "CAST(c_nationkey AS VARCHAR)", "literal", I)])
CLASSES = {
    "Nation": {"properties": {"n_name": {"kind": "literal"}, "n_nationkey": {"kind": "literal"}, "n_regionkey": {"kind": "literal"}}},
    "Customer": {"properties": {"c_name": {"kind": "literal"}, "c_mktsegment": {"kind": "literal"}, "c_nationkey": {"kind": "literal"}}},
}


def _projected(spark: SparkSession, sf_dir: str, name: str, key: str, class_name: str, graphs: dict | None = None) -> DataFrame:
    rows = from_table(dealt(table(spark, sf_dir, name)), name, key)
    subject = F.concat(F.lit(f"{INSTANCES}/"), F.regexp_replace("record_path", "^table:", ""))
    return project.project(rows, CLASSES, BASE, subject, F.lit(class_name), graphs)


@query("quads_project_nation", NATION_SQL)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return exploded(_projected(spark, sf_dir, "nation", "n_nationkey", "Nation")).select(*TERMS)


@query("quads_project_customer", CUSTOMER_SQL)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer")).select(*TERMS)


@query("quads_project_orders", _sql_quads("orders", f"'{INSTANCES}/order/' || o_orderkey", [
    (T, f"'{BASE}/Order'", "iri", None), (f"{BASE}#o_orderstatus", "o_orderstatus", "literal", S), (f"{BASE}#customer", f"'{INSTANCES}/order/' || o_orderkey || '/customer'", "iri", None)], "'urn:g/orders'")
    + " UNION ALL " + _sql_quads("orders", f"'{INSTANCES}/order/' || o_orderkey || '/customer'", [(f"{BASE}#key", "CAST(o_custkey AS VARCHAR)", "literal", I)], "'urn:g/orders'"))
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    o = dealt(table(spark, sf_dir, "orders")).select("o_orderkey", F.to_variant_object(F.struct("o_orderstatus", F.struct(F.col("o_custkey").alias("key")).alias("customer"))).alias("rec"))
    rows = o.withColumns({"rid": F.col("o_orderkey").cast("string")})
    classes = {"Order": {"properties": {"o_orderstatus": {"kind": "literal"}, "customer": {"kind": "object", "properties": {"key": {"kind": "literal"}}}}}}
    return exploded(project.project(rows, classes, BASE, _subject("order", "o_orderkey"), F.lit("Order"), {"Order": "urn:g/orders"})).select(*TERMS)


@query("projection_fallback", "SELECT n_nationkey AS key, CASE WHEN n_nationkey % 2 = 0 THEN 'SQUASH_NO_SCHEMA_FOR_CLASS' END AS error, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE 4 END AS n FROM nation")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = from_table(table(spark, sf_dir, "nation"), "nation", "n_nationkey")
    key = F.try_variant_get("rec", "$.n_nationkey", "long")
    done = project.project(rows, CLASSES, BASE, F.col("rid"), F.when(key % 2 == 0, F.lit("Nope")).otherwise(F.lit("Nation")))
    return done.select(key.cast("int").alias("key"), F.col("projection_error").alias("error"), F.size("quads").alias("n"))


PER_CLASS = "SELECT upper(event_type[1]) || event_type[2:] AS class_name, CAST(sum(3 + CAST(value IS NOT NULL AS INTEGER)) AS BIGINT) AS quads, count(*) AS records FROM events GROUP BY 1"


@query("quads_per_class", PER_CLASS)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """The flagship: records, discriminator, conflict resolution, projection, deduplication, counts by class."""
    e = dealt(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"))
    rows = classify.cascade(from_table(e, "events", "event_id"), {"discriminator": {"from": "/event_type", "sanitize": "pascalCase"}, "source": False})
    names = ["Signup", "Error", "Click", "View", "Purchase"]
    classes = {c: {"properties": {p: {"kind": "literal"} for p in ("event_id", "user_id", "value")}} for c in names}
    subject = F.concat(F.lit(f"{INSTANCES}/"), F.regexp_replace("record_path", "^table:", ""))
    done = project.project(rows, classes, BASE, subject, F.col("classification.type"))
    quads = done.select("class_name", F.explode("quads").alias("q")).select("class_name", "q.*").distinct()
    # Every record has one statement of its class.
    return quads.groupBy("class_name").agg(F.count(F.lit(1)).alias("quads"), F.count_if(F.col("p") == T).alias("records"))


FK = _sql_quads("customer", f"'{INSTANCES}/customer/' || c_custkey", [(f"{BASE}#inNation", f"'{INSTANCES}/nation/' || c_nationkey", "iri", None)])
FK_BACK = _sql_quads("customer", f"'{INSTANCES}/nation/' || c_nationkey", [(f"{BASE}#hasCustomer", f"'{INSTANCES}/customer/' || c_custkey", "iri", None)])


def _foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    own = F.array(quad(_subject("customer", "c_custkey"), vocab(BASE, "inNation"), _subject("nation", "c_nationkey")))
    return _quads(c, F.col("c_custkey").cast("string"), own)


@query("quads_foreign_key_edges", f"{FK} UNION ALL {FK_BACK}")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return project.with_inverses(_foreign(spark, sf_dir), {"inNation": "hasCustomer"}, BASE).select(*TERMS)


@query("predicate_override", FK.replace(f"{BASE}#inNation", PREFIXES["dct"] + "spatial"))
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return project.override_predicates(_foreign(spark, sf_dir), {"inNation": "dct:spatial"}).select(*TERMS)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    own = F.array(type_quad(F.concat(F.lit(f"{INSTANCES}/segment/"), F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string")), F.lit(f"{BASE}/Segment")))
    return _quads(c, F.col("c_custkey").cast("string"), own)


SEGMENTS = f"SELECT DISTINCT 'iri' AS s_type, '{INSTANCES}/segment/' || c_mktsegment || '-' || c_nationkey AS s, '{T}' AS p, 'iri' AS o_type, '{BASE}/Segment' AS o, CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang, CAST(NULL AS VARCHAR) AS g FROM customer"


@query("quads_dedup", SEGMENTS)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return deduplicated(_segments(spark, sf_dir))


@query("quads_dedup_value_only", f"SELECT * REPLACE ('{S}' AS o_datatype) FROM ({_sql_quads('region', chr(39) + INSTANCES + '/region/' + chr(39) + ' || r_regionkey', [(BASE + '#r_name', 'r_name', 'literal', S)])})")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    r = table(spark, sf_dir, "region")
    s, p = _subject("region", "r_regionkey"), vocab(BASE, "r_name")
    both = F.array(quad(s, p, F.col("r_name"), None, "literal", S), quad(s, p, F.col("r_name"), None, "literal", XSD + "token"))
    return deduplicated(_quads(r, F.col("r_name"), both), value_only=True)


@query("quads_set_union", f"SELECT * FROM ({NATION_SQL}) UNION {SEGMENTS}")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n = exploded(_projected(spark, sf_dir, "nation", "n_nationkey", "Nation"))
    return deduplicated(n.unionByName(n).unionByName(_segments(spark, sf_dir)))


@query("ancestor_types", f"""
SELECT '{INSTANCES}/nation/' || n_nationkey AS s, o FROM nation, (VALUES ('{BASE}/Nation'), ('{BASE}/Place'), ('{BASE}/Thing')) v(o)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n = exploded(_projected(spark, sf_dir, "nation", "n_nationkey", "Nation"))
    edges = spark.createDataFrame([(f"{BASE}/Nation", f"{BASE}/Place"), (f"{BASE}/Place", f"{BASE}/Thing")], "sub string, sup string")
    return project.inherited_types(n, classify.closure_table(edges, 4)).where(F.col("p") == T).select("s", "o")


@query("quads_array_enum", f"SELECT '{INSTANCES}/part/' || p_partkey AS s, '{BASE}#words' AS p, '{BASE}#Word-' || regexp_replace(w, '[^A-Za-z0-9]+', '-', 'g') AS o FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS w FROM part) WHERE w <> ''")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p = dealt(table(spark, sf_dir, "part")).select("p_partkey", F.to_variant_object(F.struct(F.split("p_type", " ").alias("words"))).alias("rec"))
    return _quads(p, F.col("p_partkey").cast("string"), project.array_enum(F.col("rec"), _subject("part", "p_partkey"), BASE, {"words": "Word"})).select("s", "p", "o")


@query("quads_skolem", f"""
SELECT s, p, o, d AS o_datatype FROM (SELECT '{INSTANCES}/part/' || p_partkey AS b, * FROM part) t, LATERAL (VALUES
  (b || '#box', '{T}', '{BASE}#Box', NULL), (b, '{BASE}#box', b || '#box', NULL), (b || '#box', '{BASE}#size', CAST(p_size AS VARCHAR), '{I}'), (b || '#box', '{BASE}#heavy', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END, '{XSD}boolean'),
  (b || '#box', '{BASE}#brand', p_brand, '{S}')) v(s, p, o, d)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    box = F.struct((F.col("p_size") + 0.25).alias("size"), (F.col("p_size") > 25).alias("heavy"), F.col("p_brand").alias("brand"))
    p = dealt(table(spark, sf_dir, "part")).select("p_partkey", F.to_variant_object(F.struct(box.alias("box"))).alias("rec"))
    spec = {"box": {"fragment": "box", "type": "Box", "properties": {"size": "xsd:integer", "heavy": "xsd:boolean", "brand": "xsd:string"}}}
    return _quads(p, F.col("p_partkey").cast("string"), project.skolem(F.col("rec"), _subject("part", "p_partkey"), BASE, spec)).select("s", "p", "o", "o_datatype")


@query("quads_provenance_iri", f"SELECT '{INSTANCES}/page/' || page_id AS s, '{PREFIXES['dct']}source' AS p, url AS o FROM pages WHERE url <> ''")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p = table(spark, sf_dir, "pages").select("page_id", F.to_variant_object(F.struct(F.struct("url").alias("_source"))).alias("rec"))
    return _quads(p, F.col("page_id").cast("string"), project.provenance_iri(F.col("rec"), _subject("page", "page_id"), "/_source/url", "dct:source")).select("s", "p", "o")


@query("quads_prov", f"""
SELECT s, p, o FROM (SELECT event_id, '{INSTANCES}/event/' || event_id AS b, 'urn:run/run/' || sha1('{INSTANCES}/event/' || event_id)[1:8] AS a, event_type FROM events) t, LATERAL (VALUES
  (a, '{T}', '{PREFIXES['prov']}Activity'), (b, '{PREFIXES['prov']}wasGeneratedBy', a), (a, '{PREFIXES['prov']}wasAssociatedWith', 'urn:run/classifier/classify-discriminator'),
  (a, 'urn:run#confidence', '1.0'), (a, '{PREFIXES['prov']}startedAtTime', '2020-01-01T00:00:00Z'), (a, 'urn:run#reason', 'discriminator at "/event_type" resolved to "' || event_type || '"')) v(s, p, o)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    e = dealt(table(spark, sf_dir, "events")).select("event_id", F.to_variant_object(F.struct("event_type")).alias("rec"))
    done = classify.cascade(e, {"discriminator": {"from": "/event_type"}, "source": False})
    made = project.record_provenance("urn:run", _subject("event", "event_id"), F.col("classification"), "2020-01-01T00:00:00Z")
    return _quads(done, F.col("event_id").cast("string"), made).select("s", "p", "o")


@query("quads_emitters", f"""
SELECT s, p, o, l AS o_lang FROM (SELECT '{INSTANCES}/supplier/' || regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g') AS b, * FROM supplier) t, LATERAL (VALUES (b, '{T}', '{BASE}#Supplier', NULL), (b, '{PREFIXES['rdfs']}label', s_name, 'en'),
  (b, '{BASE}#key', CAST(s_suppkey AS VARCHAR), NULL), (b, '{BASE}#region', CASE WHEN s_nationkey < 10 THEN '{BASE}#Low' END, NULL), (b, '{BASE}#nation', '{INSTANCES}/nation/n' || s_nationkey, NULL)) v(s, p, o, l) WHERE o IS NOT NULL""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("rid"), F.to_variant_object(F.struct("s_name", "s_suppkey", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("nation"))).alias("rec"))
    spec = {"class": "Supplier", "subject": "/s_name", "label": "/s_name", "literals": {"key": ("/s_suppkey", "xsd:integer")}, "links": {"nation": ("/nation", "Nation")}, "lookups": {"region": ("/nation", {f"n{i}": "Low" for i in range(10)})}}
    return exploded(emit.emit(s, F.lit("Supplier"), BASE, INSTANCES, {"Supplier": spec})).select("s", "p", "o", "o_lang")


# Reconciliation.


@query("entity_index", f"SELECT 'supplier/' || s_nationkey AS tail, 'https://x.org/supplier/' || s_nationkey AS iri FROM supplier GROUP BY s_nationkey")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    s = table(spark, sf_dir, "supplier")
    ids = s.select(F.concat(F.lit("https://x.org/supplier/"), F.col("s_nationkey").cast("string")).alias("subject"), "s_suppkey").unionAll(
        s.select(F.concat(F.lit("https://x.org/record/"), F.substring(F.sha1(F.col("s_name").cast("binary")), 1, 8)), "s_suppkey")).unionAll(s.select(F.lit("https://y.org/a"), "s_suppkey"))
    return reconcile.entity_index(ids, "https://x.org", order=["s_suppkey"])


def _linked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nations with a link item each, whose href names a region (or nothing that is known, for odd keys)."""
    n = table(spark, sf_dir, "nation")
    s = _subject("nation", "n_nationkey")
    item = F.concat(s, F.lit("/links/0"))
    href = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("/region/"), F.col("n_regionkey").cast("string"))).otherwise(F.lit("/gone"))
    own = F.array(quad(s, vocab(BASE, "links"), item), quad(item, vocab(BASE, "href"), href, None, "literal"), quad(item, vocab(BASE, "text"), F.col("n_name"), None, "literal"))
    index = reconcile.entity_index(table(spark, sf_dir, "region").select(F.concat(F.lit("https://x.org/region/"), F.col("r_regionkey").cast("string")).alias("subject")), "https://x.org/")
    return _quads(n, F.col("n_nationkey").cast("string"), own), index


HREF = f"""
SELECT '{INSTANCES}/nation/' || n_nationkey AS s, '{BASE}#links' AS p, CASE WHEN n_nationkey % 2 = 0 THEN 'https://x.org/region/' || n_regionkey ELSE '{INSTANCES}/nation/' || n_nationkey || '/links/0' END AS o FROM nation
UNION ALL SELECT '{INSTANCES}/nation/' || n_nationkey || '/links/0', p, o FROM nation, LATERAL (VALUES ('{BASE}#href', '/gone'), ('{BASE}#text', n_name)) v(p, o) WHERE n_nationkey % 2 = 1"""


@query("href_reconcile", HREF)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    quads, index = _linked(spark, sf_dir)
    return reconcile.collapse_links(quads, index, [f"{BASE}#links"], f"{BASE}#href").select("s", "p", "o")


@query("reconcile_counts", f"SELECT p, count(*) AS quads FROM ({HREF}) GROUP BY p")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    quads, index = _linked(spark, sf_dir)
    return reconcile.collapse_links(quads, index, [f"{BASE}#links"], f"{BASE}#href").groupBy("p").agg(F.count(F.lit(1)).alias("quads"))


@query("graph_bfs_rewrite", f"""
WITH n AS (SELECT *, CASE WHEN n_nationkey % 5 = 0 THEN 'urn:g/z-nation' ELSE 'urn:g/r' || n_regionkey END AS g FROM nation)
SELECT '{INSTANCES}/region/' || r_regionkey AS s, 'urn:g/r' || r_regionkey AS g FROM region UNION ALL SELECT '{INSTANCES}/nation/' || n_nationkey, g FROM n
UNION ALL SELECT '{INSTANCES}/customer/' || c_custkey, g FROM customer JOIN n ON c_nationkey = n_nationkey UNION ALL SELECT '{INSTANCES}/customer/x', 'urn:g/old'""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """The nearest typed subject decides: some nations have a graph of their own, which sorts after their region's."""
    r, n, c = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    old, key = F.lit("urn:g/old"), lambda name: F.col(name).cast("string")
    named = lambda kind, k, name: quad(_subject(kind, k), vocab(BASE, "name"), F.col(name), old, "literal")
    quads = _quads(r, F.col("r_name"), F.array(type_quad(_subject("region", "r_regionkey"), F.concat(F.lit(f"{BASE}/Region"), key("r_regionkey")), old)))
    quads = quads.unionAll(_quads(n, F.col("n_name"), F.array(quad(_subject("region", "n_regionkey"), vocab(BASE, "has"), _subject("nation", "n_nationkey"), old), named("nation", "n_nationkey", "n_name"))))
    quads = quads.unionAll(_quads(n.where("n_nationkey % 5 = 0"), F.col("n_name"), F.array(type_quad(_subject("nation", "n_nationkey"), F.lit(f"{BASE}/Own"), old))))
    quads = quads.unionAll(_quads(c, F.col("c_name"), F.array(quad(_subject("nation", "c_nationkey"), vocab(BASE, "has"), _subject("customer", "c_custkey"), old), named("customer", "c_custkey", "c_name"))))
    quads = quads.unionAll(_quads(r.limit(1), F.lit("x"), F.array(quad(F.lit(f"{INSTANCES}/customer/x"), vocab(BASE, "name"), F.lit("x"), old, "literal"))))
    graphs = spark.createDataFrame([(f"{BASE}/Region{i}", f"urn:g/r{i}") for i in range(5)] + [(f"{BASE}/Own", "urn:g/z-nation")], "class_iri string, graph string")
    return reconcile.rewrite_graphs(quads, graphs, T).select("s", "g").distinct()


@query("implicit_nodes", f"SELECT '{INSTANCES}/nation/' || n_nationkey AS id FROM nation")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    known = table(spark, sf_dir, "nation").where("n_nationkey < 5").select(_subject("nation", "n_nationkey").alias("id"))
    return reconcile.implicit_nodes(known, viz.edges(_foreign(spark, sf_dir))).select("id").distinct()


# Buckets, serialisation, contexts.


@query("bucket_classify", "SELECT CASE WHEN n_regionkey = 0 THEN 'urn:g/0' WHEN n_regionkey = 1 THEN '__default__' ELSE '__other__' END AS bucket, count(*) AS quads FROM nation GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n = table(spark, sf_dir, "nation")
    g = F.when(F.col("n_regionkey") != 1, F.concat(F.lit("urn:g/"), F.col("n_regionkey").cast("string")))
    quads = _quads(n, F.col("n_name"), F.array(type_quad(_subject("nation", "n_nationkey"), F.lit(f"{BASE}/Nation"), g)))
    own = sinks.bucket(quads, "per-config-bucket", {"urn:g/0": "zero", "__default__": "default"})
    return own.groupBy("bucket").agg(F.count(F.lit(1)).alias("quads"))


@query("bucket_slug_collision", """
SELECT bucket, CASE WHEN n > 1 THEN slug || '-' || sha1(bucket)[1:6] ELSE slug END AS slug FROM (SELECT bucket, slug, count(*) OVER (PARTITION BY slug) AS n FROM (
  SELECT 'https://x.org/g/' || r_name || '?q' AS bucket, 'g-' || regexp_replace(r_name, '[^a-zA-Z0-9._-]+', '-', 'g') AS slug FROM region UNION ALL SELECT 'https://y.org/g/' || r_name || '/', 'g-' || regexp_replace(r_name, '[^a-zA-Z0-9._-]+', '-', 'g') FROM region WHERE r_regionkey > 2
  UNION ALL SELECT 'https://x.org/g/' || r_name || '#a', 'g-' || regexp_replace(r_name, '[^a-zA-Z0-9._-]+', '-', 'g') || 'a' FROM region))""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    r = table(spark, sf_dir, "region")
    make = lambda host, end: F.concat(F.lit(f"https://{host}/g/"), F.col("r_name"), F.lit(end)).alias("bucket")
    keys = r.select(make("x.org", "?q")).unionAll(r.where("r_regionkey > 2").select(make("y.org", "/"))).unionAll(r.select(make("x.org", "#a")))
    return sinks.bucket_files(keys)


@query("graph_count", "SELECT count(DISTINCT n_regionkey) AS graphs FROM nation")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    g = F.when(F.col("n_regionkey") > 0, F.concat(F.lit("urn:g/"), F.col("n_regionkey").cast("string")))
    quads = _quads(table(spark, sf_dir, "nation"), F.col("n_name"), F.array(type_quad(_subject("nation", "n_nationkey"), F.lit("x"), g)))
    return quads.agg(F.count_distinct(F.coalesce("g", F.lit(sinks.DEFAULT))).alias("graphs"))


def _lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    s, g = _subject("document", "doc_id"), F.concat(F.lit("urn:g/"), F.col("lang"))
    own = F.array(type_quad(s, F.lit(f"{BASE}/Document"), g), quad(s, vocab(BASE, "text"), F.col("text"), g, "literal", lang=F.col("lang")), quad(s, vocab(BASE, "n"), F.col("n_chars").cast("string"), None, "literal", I), quad(s, vocab(BASE, "source"), F.col("source"), None, "literal"))
    return _quads(d, F.col("doc_id").cast("string"), own)




@query("nquads_lines", f"""
SELECT line FROM (SELECT '<{INSTANCES}/document/' || doc_id || '>' AS s, * FROM documents) t, LATERAL (VALUES (s || ' <{T}> <{BASE}/Document> <urn:g/' || lang || '> .'), (s || ' <{BASE}#text> "' || {ESC} || '"@' || lang || ' <urn:g/' || lang || '> .'),
  (s || ' <{BASE}#n> "' || n_chars || '"^^<{I}> .'), (s || ' <{BASE}#source> "' || source || '" .')) v(line)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _lines_source(spark, sf_dir).select(rdf.nquads_line().alias("line"))


@query("nquads_roundtrip", f"""
SELECT s, p, o, d AS o_datatype, l AS o_lang, g FROM (SELECT '{INSTANCES}/document/' || doc_id AS s, * FROM documents) t, LATERAL (VALUES ('{T}', '{BASE}/Document', NULL, NULL, 'urn:g/' || lang), ('{BASE}#text', text, '{rdf.LANG_STRING}', lang, 'urn:g/' || lang),
  ('{BASE}#n', CAST(n_chars AS VARCHAR), '{I}', NULL, NULL), ('{BASE}#source', source, '{S}', NULL, NULL)) v(p, o, d, l, g)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return rdf.parse_nquads(_lines_source(spark, sf_dir).select(rdf.nquads_line().alias("value"))).where("error IS NULL").select("s", "p", "o", "o_datatype", "o_lang", "g")


@query("turtle_blocks", f"SELECT 'id:nation/' AS head, '<{INSTANCES}/nation/' || n_nationkey || '>' AS s, '<{INSTANCES}/nation/' || n_nationkey || '>' || chr(10) || '    a v:Nation ;' || chr(10) || '    w:n_name \"' || n_name || '\" ;' || chr(10) || '    w:n_nationkey \"' || n_nationkey || '\"^^<{I}> ;' || chr(10) || '    w:n_regionkey \"' || n_regionkey || '\"^^<{I}> .' AS block FROM nation")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n = exploded(_projected(spark, sf_dir, "nation", "n_nationkey", "Nation"))
    return sinks.turtle_blocks(n, {"v": f"{BASE}/", "w": f"{BASE}#"}).select(F.lit("id:nation/").alias("head"), "s", "block")


@query("jsonld_nodes", f"""
SELECT s, '{{"@id":"' || s || '","@type":["{BASE}/Customer"],"{BASE}#c_mktsegment":[{{"@value":"' || c_mktsegment || '"}}],"{BASE}#c_name":[{{"@value":"' || c_name || '"}}],"{BASE}#c_nationkey":[{{"@value":"' || c_nationkey || '","@type":"{I}"}}]}}' AS node
FROM (SELECT '{INSTANCES}/customer/' || c_custkey AS s, * FROM customer)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return sinks.jsonld_nodes(exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer"))).select("s", "node")


@query("jsonld_compact", f"""
SELECT s, '{{"@id":"' || s || '","@type":"{BASE}/Customer","name":"' || c_name || '","nation":["' || c_nationkey || '"],"v:c_mktsegment":"' || c_mktsegment || '"}}' AS node
FROM (SELECT '{INSTANCES}/customer/' || c_custkey AS s, * FROM customer)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    context = {"@context": {"v": f"{BASE}#", "name": "v:c_name", "nation": {"@id": "v:c_nationkey", "@type": I, "@container": "@set"}}}
    return sinks.jsonld_nodes(exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer")), context).select("s", "node")


@query("jsonld_context_terms", f"""
SELECT * FROM (VALUES ('rdf:type', '{T}', '@id', NULL), ('v:n', '{BASE}#n', 'xsd:integer', NULL), ('v:source', '{BASE}#source', NULL, NULL), ('v:text', '{BASE}#text', NULL, NULL), ('v:links', '{BASE}#links', '@id', '@set')) t(term, iri, type, container)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    d = table(spark, sf_dir, "documents")
    more = _quads(d, F.col("doc_id").cast("string"), F.array(*[quad(_subject("document", "doc_id"), vocab(BASE, "links"), F.lit(f"urn:l/{i}")) for i in range(2)]))
    return rdf.context_terms(_lines_source(spark, sf_dir).unionByName(more), {"v": f"{BASE}#", "rdf": PREFIXES["rdf"], "xsd": XSD})


@query("canonical_lines", f"""
SELECT DISTINCT value FROM (SELECT '<{INSTANCES}/document/' || doc_id || '>' AS s, * FROM documents) t, LATERAL (VALUES (s || ' <{T}> <{BASE}/Document> <urn:g/' || lang || '> .'), (s || ' <{BASE}#text> "' || {ESC} || '"@' || lang || ' <urn:g/' || lang || '> .'),
  (s || ' <{BASE}#n> "' || n_chars || '"^^<{I}> .'), (s || ' <{BASE}#source> "' || source || '" .')) v(value)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    d = _lines_source(spark, sf_dir)
    return sinks.canonical_lines(d.unionByName(d))


@query("shacl_violations", f"""
SELECT 'Violation' AS severity, '{INSTANCES}/customer/' || c_custkey AS focus, '{BASE}#c_mktsegment' AS path, 'in' AS "constraint", 'segment' AS message FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'Warning', '{INSTANCES}/customer/' || c_custkey, '{BASE}#c_phone', 'minCount', 'minCount 1' FROM customer UNION ALL SELECT 'Violation', '{INSTANCES}/customer/' || c_custkey, '{BASE}#c_nationkey', 'datatype', 'datatype {S}' FROM customer""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    quads = exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer"))
    shape = {"iri": "urn:s", "targetClass": f"{BASE}/Customer", "properties": [
        {"path": f"{BASE}#c_mktsegment", "in": ["BUILDING", "MACHINERY"], "message": "segment"}, {"path": f"{BASE}#c_phone", "minCount": 1, "severity": "Warning"}, {"path": f"{BASE}#c_nationkey", "datatype": S, "maxCount": 1}]}
    return shacl.violations(quads, [shape])


@query("finalize_split", f"SELECT CASE n_nationkey % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'ontology' ELSE 'prov' END AS part, count(*) AS quads FROM nation GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    g = F.element_at(F.array(F.lit(None).cast("string"), F.lit("urn:graph:t/ontology"), F.lit("urn:prov:x")), F.col("n_nationkey") % 3 + 1)
    quads = _quads(table(spark, sf_dir, "nation"), F.col("n_name"), F.array(type_quad(_subject("nation", "n_nationkey"), F.lit("x"), g)))
    parts = sinks.split(quads, "t")
    out = None
    for name, own in parts.items():
        one = own.groupBy(F.lit(name).alias("part")).agg(F.count(F.lit(1)).alias("quads"))
        out = one if out is None else out.unionAll(one)
    return out


# Graph export.


@query("viz_degree", f"SELECT id, count(*) AS degree FROM (SELECT '{INSTANCES}/customer/' || c_custkey AS id FROM customer UNION ALL SELECT '{INSTANCES}/nation/' || c_nationkey FROM customer) GROUP BY id")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return viz.degrees(viz.edges(_foreign(spark, sf_dir)))


@query("viz_nodes_most_specific_class", f"SELECT '{INSTANCES}/nation/' || n_nationkey AS id, 'urn:core/Thing,{BASE}/Nation' AS types, n_name AS label, 'Nation' AS class_name FROM nation")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    s = _subject("nation", "n_nationkey")
    own = F.array(type_quad(s, F.lit("urn:core/Thing")), type_quad(s, F.lit(f"{BASE}/Nation")), quad(s, PREFIXES["rdfs"] + "label", F.col("n_name"), None, "literal"), quad(s, PREFIXES["dct"] + "title", F.lit("A"), None, "literal"))
    found = viz.nodes(_quads(table(spark, sf_dir, "nation"), F.col("n_name"), own), core="urn:core/")
    return found.select("id", F.array_join("types", ",").alias("types"), "label", "class_name")


@query("dense_index", """
SELECT id, CAST(off + r - 1 AS BIGINT) AS "index" FROM (SELECT id, graph, row_number() OVER (PARTITION BY graph ORDER BY id) AS r FROM (SELECT 'c' || c_custkey AS id, c_mktsegment AS graph FROM customer))
JOIN (SELECT graph, sum(n) OVER (ORDER BY n, graph) - n AS off FROM (SELECT c_mktsegment AS graph, count(*) AS n FROM customer GROUP BY 1)) USING (graph)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("graph"))
    return viz.dense_index(c).select("id", "index")


@query("viz_layout", "SELECT 'g' || n_regionkey AS bucket, count(*) AS nodes, count(*) AS places, true AS inside, true AS spans FROM nation GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """What any layout must hold: every node once, on a place of its own, inside the picture, which it fills."""
    n = table(spark, sf_dir, "nation").select(_subject("nation", "n_nationkey").alias("id"), F.concat(F.lit("g"), F.col("n_regionkey").cast("string")).alias("graph"))
    links = table(spark, sf_dir, "nation").select(_subject("nation", "n_nationkey").alias("src"), F.concat(F.lit(f"{INSTANCES}/nation/"), F.col("n_regionkey").cast("string")).alias("dst"))
    span = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    return viz.layout(n, links).groupBy("bucket").agg(
        F.count_distinct("id").alias("nodes"), F.count_distinct("x", "y").alias("places"), F.bool_and(F.expr("x BETWEEN 0 AND 1200 AND y BETWEEN 0 AND 1200")).alias("inside"), (span > 1199.9).alias("spans"),
    )


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with names and types in their region's graph, and links to regions that have no statements."""
    n = table(spark, sf_dir, "nation")
    s, g = _subject("nation", "n_nationkey"), F.concat(F.lit("urn:g/"), F.col("n_regionkey").cast("string"))
    region = F.concat(F.lit(f"{INSTANCES}/region/r-"), F.col("n_regionkey").cast("string"))
    texts = [quad(s, vocab(BASE, "name"), F.col("n_name"), g, "literal"), quad(s, vocab(BASE, "text"), F.lit("about"), g, "literal")]
    return _quads(n, F.col("n_name"), F.array(type_quad(s, F.lit("urn:core/Thing"), g), type_quad(s, F.lit(f"{BASE}/Nation"), g), *texts, quad(s, vocab(BASE, "in"), region, g)))


@query("property_graph_nodes", f"""
SELECT '{INSTANCES}/nation/' || n_nationkey AS id, n_name AS label, 'v:Nation' AS class_label, 'urn:g/' || n_regionkey AS graph, 'w:name=' || n_name || ';w:text=about' AS properties FROM nation
UNION ALL SELECT DISTINCT '{INSTANCES}/region/r-' || n_regionkey, CAST(n_regionkey AS VARCHAR), NULL, 'urn:g/' || n_regionkey, '' FROM nation""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    nodes, _, _ = viz.property_graph(_described(spark, sf_dir), {"v": f"{BASE}/", "w": f"{BASE}#", "r": f"{INSTANCES}/region/"})
    told = F.array_join(F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    return nodes.select("id", "label", "class_label", "graph", told.alias("properties"))


@query("property_graph_edges", f"""
SELECT '{INSTANCES}/nation/' || n_nationkey || '--{BASE}#in->>{INSTANCES}/region/r-' || n_regionkey AS id, '{INSTANCES}/nation/' || n_nationkey AS source, '{INSTANCES}/region/r-' || n_regionkey AS target, 'w:in' AS label, 'urn:g/' || n_regionkey AS graph FROM nation""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return viz.property_graph(_described(spark, sf_dir), {"v": f"{BASE}/", "w": f"{BASE}#"})[1]


@query("projection_strict_schema", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 1000 AND o_orderstatus IN ('O', 'F') THEN '' ELSE 'PROJECTION_CONSTRAINT_VIOLATION' END AS warnings, CASE WHEN o_orderkey % 7 = 0 THEN 'SQUASH_PROJECTION_FAILED' END AS error, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS n FROM orders""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_variant_object(F.struct("o_orderkey", "o_orderstatus", "o_totalprice")).alias("rec"))
    schema = {"type": "object", "properties": {"o_totalprice": {"type": "number", "minimum": 1000}, "o_orderstatus": {"enum": ["O", "F"]}}}
    key = lambda rec: F.try_variant_get(rec, "$.o_orderkey", "long")
    classes = {"Order": {"schema": schema, "projector": lambda rec, s, g: F.when(key(rec) % 7 != 0, F.array(type_quad(s, F.lit(f"{BASE}/Order"), g)))}}
    done = project.project(o, classes, BASE, _subject("order", "o_orderkey"), F.lit("Order"))
    return done.select("o_orderkey", F.array_join("projection_warnings", ",").alias("warnings"), F.col("projection_error").alias("error"), F.size("quads").alias("n"))
