"""Queries over records: predicates, classifiers, shapes, statistics, text extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import iri
from lodestone.functions.plan import dealt
from lodestone.functions.pointer import value_at
from lodestone.operators import classify, extract, runstats, shapes
from lodestone.plans.predicate import compile_predicate
from lodestone.sources import records

CATALOGUE: dict = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    """Registers a query with its SQL."""

    def keep(f):  # noqa: ANN001, ANN202
        CATALOGUE[name] = (f, sql)
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, rec): events with their embedded properties as one nested VARIANT object."""
    e = dealt(table(spark, sf_dir, "events"))
    return e.select("event_id", F.to_variant_object(F.struct("event_id", "user_id", "event_type", "value", F.struct(F.lit("events").alias("target")).alias("_source"))).alias("rec"), F.try_parse_json("props").alias("props"))


def _hits(spark: SparkSession, sf_dir: str, column: str, **predicates: dict) -> DataFrame:
    rows = _events(spark, sf_dir)
    return rows.select("event_id", *[compile_predicate(F.col(column), p).alias(name) for name, p in predicates.items()])


K = "CAST(json_extract(props, '$.k') AS DOUBLE)"


@query("predicate_equals", f"SELECT event_id, event_type = 'click' AS is_click, coalesce({K} = 7, false) AS is_seven FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = _events(spark, sf_dir)
    return rows.select("event_id", compile_predicate(F.col("rec"), {"path": "/event_type", "equals": "click"}).alias("is_click"), compile_predicate(F.col("props"), {"path": "/k", "equals": 7}).alias("is_seven"))


@query("predicate_not_equals", f"SELECT event_id, coalesce({K} <> 5, false) AS other, false AS absent FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "props", other={"path": "/k", "notEquals": 5}, absent={"path": "/zz", "notEquals": 5})


@query("predicate_in", f"SELECT event_id, coalesce({K} IN (1, 2, 3), false) AS inside, coalesce({K} NOT IN (1, 2, 3), false) AS outside FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "props", inside={"path": "/k", "in": [1, 2, 3]}, outside={"path": "/k", "notIn": [1, 2, 3]})


@query("predicate_exists_missing", "SELECT event_id, json_exists(props, '$.k') AS there, NOT json_exists(props, '$.zz') AS gone FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "props", there={"path": "/k", "exists": True}, gone={"path": "/zz", "missing": True})


@query("predicate_type", "SELECT event_id, value IS NOT NULL AS number, event_type IS NOT NULL AS text, value IS NULL AS nothing, true AS object FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "rec", number={"path": "/value", "type": "number"}, text={"path": "/event_type", "type": "string"}, nothing={"path": "/value", "type": "null"}, object={"path": "/_source", "type": "object"})


@query("predicate_regex", "SELECT event_id, coalesce(regexp_full_match(event_type, 'c.*k|view'), false) AS hit, false AS number FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "rec", hit={"path": "/event_type", "regex": "^(?:c.*k|view)$"}, number={"path": "/value", "regex": "^.*$"})


@query("predicate_length", "SELECT conv_id, turn, length(text) >= 40 AND length(text) <= 400 AS middle, length(role) = 4 AS four, text IS NOT NULL AS any FROM conversations")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("rec"))
    tests = {"middle": {"path": "/text", "length": {"gte": 40, "lte": 400}}, "four": {"path": "/role", "length": {"eq": 4, "gte": 99}}, "any": {"path": "/text", "length": {}}}
    return rows.select("conv_id", "turn", *[compile_predicate(F.col("rec"), p).alias(n) for n, p in tests.items()])


@query("predicate_range", "SELECT event_id, coalesce(value > 10 AND value <= 50, false) AS hit, false AS text FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _hits(spark, sf_dir, "rec", hit={"path": "/value", "range": {"gt": 10, "lte": 50}}, text={"path": "/event_type", "range": {"gte": 0}})


@query("predicate_combinators", "SELECT event_id, event_type = 'view' AND NOT coalesce(value > 50, false) AS hit, true AS every, false AS none FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    both = {"all": [{"path": "/event_type", "equals": "view"}, {"not": {"any": [{"path": "/value", "range": {"gt": 50}}, {"path": "/zz", "exists": True}]}}]}
    return _hits(spark, sf_dir, "rec", hit=both, every={"all": []}, none={"any": []})


@query("predicate_container_equals", "SELECT event_id, json(props) = '{\"k\":7}' AS same FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = _events(spark, sf_dir).select("event_id", F.to_variant_object(F.struct(F.col("props").alias("inner"))).alias("rec"))
    return rows.select("event_id", compile_predicate(F.col("rec"), {"path": "/inner", "equals": {"k": 7.0}}).alias("same"))


# Classifiers.

PASCAL = "upper(event_type[1]) || event_type[2:]"


def _told(p: Column, *keys: str) -> list[Column]:
    """The proposal as plain columns."""
    return [p["class_name"].alias("class_name"), p["priority"].alias("priority"), p["confidence"].alias("confidence"), F.array_join(p["reasons"], " / ").alias("reasons")]


@query("classify_discriminator", f"SELECT event_id, {PASCAL} AS class_name, 50.0 AS priority, 1.0 AS confidence, 'discriminator at \"/event_type\" resolved to \"' || event_type || '\"' AS reasons FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _events(spark, sf_dir).select("event_id", *_told(classify.discriminator(F.col("rec"), "/event_type", "/_source/target", "pascalCase")))


@query("classify_source", "SELECT event_id, '__source__' AS class_name, 0.0 AS priority, 1.0 AS confidence, 'target=events' AS reasons FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _events(spark, sf_dir).select("event_id", *_told(classify.source_sentinel(F.col("rec"))))


@query("classify_url_pattern", """
SELECT page_id, CASE WHEN a AND NOT (b OR c) THEN 'English' WHEN b THEN 'Listing' WHEN c THEN 'Anchored' END AS class_name,
  CASE WHEN b OR c THEN 40.0 WHEN a THEN 35.0 END AS priority, CASE WHEN a OR b OR c THEN 1.0 END AS confidence,
  CASE WHEN a OR b OR c THEN array_to_string(list_filter([CASE WHEN a THEN 'engine=url-pattern,regex=/en/ → English' END, CASE WHEN b THEN 'engine=url-pattern,regex=page=\\d+ → Listing' END,
    CASE WHEN c THEN 'engine=url-pattern,regex=# → Anchored' END, 'url=' || url], lambda x: x IS NOT NULL), ' / ') END AS reasons
FROM (SELECT page_id, url, contains(url, '/en/') AS a, regexp_matches(url, 'page=\\d+') AS b, contains(url, '#') AS c FROM pages)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "pages").select("page_id", F.to_variant_object(F.struct("url")).alias("rec"))
    patterns = [{"match": "/en/", "className": "English"}, {"match": "page=\\d+", "className": "Listing", "priority": 40}, {"match": "#", "className": "Anchored", "priority": 40}]
    return rows.select("page_id", *_told(classify.url_pattern(F.col("rec"), patterns)))


PART_RULES = [
    {"className": "Large", "priority": 20, "predicate": {"path": "/p_size", "range": {"gte": 40}}, "reasons": ["size"]},
    {"className": "Costly", "priority": 30, "predicate": {"path": "/p_retailprice", "range": {"gt": 1000}}, "reasons": ["price"]},
    {"className": "Odd", "priority": 30, "predicate": {"path": "/p_size", "in": [1, 3, 5, 7, 9, 41, 43]}, "reasons": ["odd", "size"]},
]
PART_SQL = "SELECT p_partkey, p_size >= 40 AS a, p_retailprice > 1000 AS b, p_size IN (1, 3, 5, 7, 9, 41, 43) AS c FROM part"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "part")).select("p_partkey", F.to_variant_object(F.struct("p_partkey", "p_size", "p_retailprice", "p_brand", "p_type", "p_name")).alias("rec"))


@query("classify_rules", f"""
SELECT p_partkey, CASE WHEN b THEN 'Costly' WHEN c THEN 'Odd' WHEN a THEN 'Large' END AS class_name, CASE WHEN b OR c THEN 30.0 WHEN a THEN 20.0 END AS priority, CASE WHEN a OR b OR c THEN 1.0 END AS confidence,
  CASE WHEN a OR b OR c THEN array_to_string(list_filter([CASE WHEN a THEN 'size' END, CASE WHEN b THEN 'price' END, CASE WHEN c THEN 'odd / size' END], lambda x: x IS NOT NULL), ' / ') END AS reasons
FROM ({PART_SQL})""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _parts(spark, sf_dir).select("p_partkey", *_told(classify.rules(F.col("rec"), PART_RULES)))


@query("classify_schema", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 1000 AND o_orderstatus IN ('O', 'F') AND regexp_full_match(o_orderpriority, '[12]-.*') THEN 'UrgentOrder' WHEN o_orderstatus IS NOT NULL THEN 'Order' END AS class_name FROM orders""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = dealt(table(spark, sf_dir, "orders")).select("o_orderkey", F.to_variant_object(F.struct("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")).alias("rec"))
    urgent = {"type": "object", "required": ["o_totalprice"], "properties": {"o_totalprice": {"type": "number", "minimum": 1000}, "o_orderstatus": {"enum": ["O", "F"]}, "o_orderpriority": {"$ref": "#/$defs/p"}}, "$defs": {"p": {"type": "string", "pattern": "^[12]-.*$"}}}
    plain = {"type": "object", "required": ["o_orderstatus"], "properties": {"o_orderstatus": {"type": "string"}}}
    p = classify.schema(F.col("rec"), [{"schemaId": "order", "schema": plain, "className": "Order", "priority": 10}, {"schemaId": "urgent", "schema": urgent, "className": "UrgentOrder", "priority": 20}])
    return rows.select("o_orderkey", p["class_name"].alias("class_name"))


@query("classify_shacl_shape", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND c_acctbal IS NOT NULL THEN 'Builder' WHEN c_name IS NOT NULL THEN 'Customer' END AS class_name FROM customer""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = dealt(table(spark, sf_dir, "customer")).select("c_custkey", F.to_variant_object(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")).alias("rec"))
    shapes_ = [
        {"iri": "urn:s#B", "targetClass": "urn:c#Builder", "properties": [{"path": "urn:p#c_mktsegment", "minCount": 1, "in": ["BUILDING", "AUTOMOBILE"]}, {"path": "urn:p#c_acctbal", "minCount": 1, "maxCount": 1, "datatype": "xsd:decimal"}]},
        {"iri": "urn:s#C", "targetClass": "urn:c#Customer", "properties": [{"path": "urn:p#c_name", "minCount": 1, "datatype": "xsd:string"}]},
    ]
    return rows.select("c_custkey", classify.shacl_shape(F.col("rec"), shapes_)["class_name"].alias("class_name"))


FINGERPRINTS = {"Nation": ["n_nationkey", "n_name", "n_regionkey"], "Region": ["r_regionkey", "r_name"], "Wide": ["n_nationkey", "n_name", "n_regionkey", "r_name"]}


@query("classify_fingerprint_jaccard", """
SELECT n_nationkey AS key, 'nation' AS source, 'Nation' AS class_name, 1.0 AS score, 'fingerprint:Nation jaccard=1.000 / fingerprint:Wide jaccard=0.750' AS reasons FROM nation
UNION ALL SELECT r_regionkey, 'region', 'Region', 1.0, 'fingerprint:Region jaccard=1.000' FROM region""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.select(F.col("n_nationkey").alias("key"), F.lit("nation").alias("source"), F.to_variant_object(F.struct(*n.columns, F.struct(F.lit("x").alias("target")).alias("_source"))).alias("rec")).unionAll(
        r.select("r_regionkey", F.lit("region"), F.to_variant_object(F.struct(*r.columns))))
    p = classify.fingerprint(F.col("rec"), FINGERPRINTS, 0.7)
    return rows.select("key", "source", p["class_name"].alias("class_name"), p["confidence"].alias("score"), F.array_join(p["reasons"], " / ").alias("reasons"))


@query("classify_entities", """
SELECT doc_id, CASE WHEN a THEN 'Insult' WHEN b THEN 'Ware' END AS class_name FROM (SELECT doc_id,
  regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])(moron|idiot)($|[^\\p{L}\\p{N}])') AS a,
  regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])apache\\s+(license|licence)($|[^\\p{L}\\p{N}])') AS b FROM documents)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "documents").select("doc_id", F.to_variant_object(F.struct("text")).alias("rec"))
    patterns = [{"className": "Insult", "patterns": ["[moron,idiot]"], "priority": 30}, {"className": "Ware", "patterns": ["apache [license,licence]"]}]
    return rows.select("doc_id", classify.entities(F.col("rec"), patterns, ("/text",))["class_name"].alias("class_name"))


CONFIG = {"discriminator": {"from": "/p_type", "priority": 10}, "source": False, "structural": PART_RULES[:2], "rules": PART_RULES[2:]}


@query("classify_conflict_priority", f"""
SELECT p_partkey, CASE WHEN b AND c THEN 'Costly' WHEN c THEN 'Odd' WHEN b THEN 'Costly' WHEN a THEN 'Large' ELSE p_type END AS class_name,
  CASE WHEN b AND c THEN 'Costly,Odd' END AS candidates, CASE WHEN b AND c THEN 'classify:structural' WHEN c THEN 'classify:rules' WHEN b OR a THEN 'classify:structural' ELSE 'classify:discriminator' END AS engine
FROM ({PART_SQL}) JOIN part USING (p_partkey)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    done = classify.cascade(_parts(spark, sf_dir), CONFIG | {"onConflict": "pick"})
    c = F.col("classification")
    return done.select("p_partkey", c["type"].alias("class_name"), F.array_join(c["candidates"], ",").alias("candidates"), c["engine"].alias("engine"))


@query("classify_conflict_tie", f"SELECT p_partkey, CASE WHEN b AND c THEN 'conflicts' END AS bucket, b AND c AS tied FROM ({PART_SQL})")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    done = classify.cascade(_parts(spark, sf_dir), CONFIG)
    c = F.col("classification")
    return done.select("p_partkey", c["bucket"].alias("bucket"), c["type"].isNull().alias("tied"))


@query("classify_generic_floor", f"SELECT p_partkey, CASE WHEN a THEN 'Large' ELSE 'Generic' END AS class_name, CASE WHEN a THEN 1.0 ELSE 0.0 END AS confidence, CASE WHEN a THEN '' ELSE 'CLASSIFY_GENERIC_FALLBACK' END AS warnings FROM ({PART_SQL})")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    done = classify.cascade(_parts(spark, sf_dir), {"source": False, "rules": PART_RULES[:1]})
    c = F.col("classification")
    return done.select("p_partkey", c["type"].alias("class_name"), c["confidence"].alias("confidence"), F.array_join(c["warnings"], ",").alias("warnings"))


@query("ontology_unknown", f"SELECT event_id, 'unknown class: ' || {PASCAL} AS reasons FROM events WHERE {PASCAL} NOT IN ('Click', 'View')")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    done = classify.cascade(_events(spark, sf_dir), {"discriminator": {"from": "/event_type", "sanitize": "pascalCase"}, "ontology": ["Click", "View"]})
    told = F.filter("proposals", lambda p: p["class_name"] == "__validation__")
    return done.where(F.size(told) > 0).select("event_id", F.array_join(told[0]["reasons"], ",").alias("reasons"))


NARROWING = [("urn:c#Click", "urn:c#Interaction"), ("urn:c#View", "urn:c#Interaction"), ("urn:c#Interaction", "urn:c#Event"), ("urn:c#Event", "urn:c#Event")]


@query("taxonomy_narrowing", f"""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN {PASCAL} ELSE 'Event' END AS class_name,
  CASE WHEN event_type IN ('click', 'view') THEN 'narrowed: ' || {PASCAL} || ' subClassOf Event; dropped Event' ELSE '' END AS reasons FROM events""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    config = {"discriminator": {"from": "/event_type", "sanitize": "pascalCase"}, "source": False, "narrowing": NARROWING, "onConflict": "pick",
              "rules": [{"className": "Event", "priority": 60, "predicate": {"all": []}, "reasons": []}]}
    done = classify.cascade(_events(spark, sf_dir), config)
    sentinel = F.filter("proposals", lambda p: p["class_name"] == "__narrowing_applied__")
    return done.select("event_id", F.col("classification.type").alias("class_name"), F.coalesce(F.array_join(F.try_element_at(sentinel, F.lit(1))["reasons"], ","), F.lit("")).alias("reasons"))


@query("taxonomy_closure", """
WITH RECURSIVE e AS (SELECT n_name AS sub, r_name AS sup FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'World' FROM region UNION ALL SELECT 'World', 'World'),
c AS (SELECT sub, sup FROM e WHERE sub <> sup UNION SELECT c.sub, e.sup FROM c JOIN e ON c.sup = e.sub WHERE c.sub <> e.sup) SELECT DISTINCT sub, sup FROM c""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    edges = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("sub"), F.col("r_name").alias("sup"))
    edges = edges.unionAll(r.select("r_name", F.lit("World"))).unionAll(spark.range(1).select(F.lit("World"), F.lit("World")))
    return classify.closure_table(edges, depth=8)


@query("build_fingerprints", "SELECT 'E' || (event_id % 3) AS class_name, 'event_id,event_type,user_id,value' AS keys FROM events GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = _events(spark, sf_dir)
    found = classify.build_fingerprints(rows, F.concat(F.lit("E"), (F.col("event_id") % 3).cast("string")))
    return found.select("class_name", F.array_join("keys", ",").alias("keys"))


# Sources.


@query("source_records", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'JSON_READ_PARSE_ERROR' WHEN event_id % 4 = 1 THEN 'JSON_READ_NON_OBJECT' WHEN event_id % 4 = 2 THEN 'JSON_READ_TARGET_MISMATCH' END AS error_code, sha1('p#' || event_id) AS rid FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.lit("{bad")).when(F.col("event_id") % 4 == 1, F.lit("[1]")).when(F.col("event_id") % 4 == 2, F.lit('{"_source":{"target":"other"}}')).otherwise(F.col("props"))
    found = records.from_texts(e.select(F.lit("p").alias("record_path"), F.col("event_id").alias("record_line"), raw.alias("raw")), "events")
    return found.select(F.col("record_line").cast("long").alias("event_id"), "error_code", "rid")


@query("subject_iri_hash", "SELECT l_orderkey, l_linenumber, 'urn:run/record/' || sha1('table:lineitem:' || (l_orderkey * 10 + l_linenumber))[1:8] AS subject FROM lineitem")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    none = F.lit(None).cast("variant")
    return rows.select("l_orderkey", "l_linenumber", iri.subject_iri(none, F.lit("table:lineitem"), F.col("l_orderkey") * 10 + F.col("l_linenumber"), "urn:run").alias("subject"))


@query("subject_iri_url_tail", "SELECT page_id, 'https://x.org/r/' || ltrim(CASE WHEN t = '' OR t[1] = '?' THEN '/' || t ELSE t END, '/') AS subject, lower(regexp_extract(url, '://([^/?#]*)', 1)) || regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS host_path FROM (SELECT page_id, url, regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS t FROM pages)")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.to_variant_object(F.struct("url")).alias("rec"))
    return rows.select("page_id", iri.subject_iri(F.col("rec"), F.lit("p"), F.lit(0), "https://x.org/r", {"from": "/id", "fallback": "/url", "sanitize": "url-tail"}).alias("subject"), iri.url_host_path(F.col("url")).alias("host_path"))


@query("subject_iri_slug", "SELECT p_partkey, 'https://x.org/' || regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS subject FROM part")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _parts(spark, sf_dir).select("p_partkey", iri.subject_iri(F.col("rec"), F.lit("p"), F.lit(0), "https://x.org/", {"from": "/p_name", "sanitize": "slug"}).alias("subject"))


@query("iri_functions", """
SELECT p_partkey, 'http://purl.org/dc/terms/' || p_brand AS expanded, 'dct:' || p_brand AS compacted, regexp_replace(p_type, '[^A-Za-z0-9]+', '-', 'g') AS segment,
  replace(replace('urn:x<' || p_name || '>', '<', '%3C'), '>', '%3E') = replace('urn:x%3C' || p_name || '%3E', ' ', ' ') AS same,
  replace('urn:' || p_type, ' ', '%20') AS sanitized FROM part""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p = table(spark, sf_dir, "part")
    full = iri.expand_curie(F.concat(F.lit("dct:"), F.col("p_brand")))
    return p.select(
        "p_partkey", full.alias("expanded"), iri.compact_iri(full, iri.PREFIXES | {"purl": "http://purl.org/"}).alias("compacted"), iri.segment(F.col("p_type")).alias("segment"),
        (F.replace(F.replace(F.concat(F.lit("urn:x<"), F.col("p_name"), F.lit(">")), F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E")) == F.concat(F.lit("urn:x%3C"), F.col("p_name"), F.lit("%3E"))).alias("same"),
        iri.sanitize_iri(F.concat(F.lit("urn:"), F.col("p_type"))).alias("sanitized"),
    )


# Shapes and induction.


def _shape_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = dealt(table(spark, sf_dir, "events"))
    return e.select(F.col("event_type").alias("class_name"), F.to_variant_object(F.struct("user_id", "event_type", "value", F.try_parse_json("props").alias("props"))).alias("rec"))


@query("shape_presence", """
SELECT event_type AS class_name, path, n AS presence FROM (
  SELECT event_type, count(*) AS a, count(*) AS b, count(*) AS c, count(*) AS d, count(*) FILTER (json_exists(props, '$.k')) AS e FROM events GROUP BY event_type) t,
  LATERAL (VALUES ('user_id', a), ('event_type', b), ('value', c), ('props', d), ('props.k', e)) v(path, n) WHERE n > 0""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return shapes.observed(shapes.flattened(_shape_records(spark, sf_dir), depth=3)).select("class_name", "path", "presence")


@query("shape_type_histogram", """
SELECT event_type AS class_name, count(*) FILTER (value IS NULL) AS n_null, count(*) FILTER (value = floor(value)) AS n_integer, count(*) FILTER (value <> floor(value)) AS n_number FROM events GROUP BY 1""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    found = shapes.observed(shapes.flattened(_shape_records(spark, sf_dir), depth=3)).where("path = 'value'")
    return found.select("class_name", "n_null", "n_integer", "n_number")


@query("shape_numeric_range", "SELECT event_type AS class_name, min(CAST(json_extract(props, '$.k') AS DOUBLE)) AS low, max(CAST(json_extract(props, '$.k') AS DOUBLE)) AS high FROM events GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    found = shapes.observed(shapes.flattened(_shape_records(spark, sf_dir), depth=3)).where("path = 'props.k'")
    return found.select("class_name", F.col("min").alias("low"), F.col("max").alias("high"))


@query("shape_distinct_overflow", "SELECT 'Page' AS class_name, 'url' AS path, least(count(DISTINCT url), 256) AS n_distinct, count(DISTINCT url) >= 256 AS overflow, count(*) FILTER (regexp_matches(url, '^https?://')) AS url_count FROM pages")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "pages").select(F.lit("Page").alias("class_name"), F.to_variant_object(F.struct("url")).alias("rec"))
    return shapes.shape_cache(rows).select("class_name", "path", "n_distinct", "overflow", "url_count")


@query("schema_verdicts", """
SELECT 'Order' AS class_name, path, true AS required, n <= 16 AND t AS closed_enum, n >= 256 AND t AS open_vocabulary FROM (
  SELECT count(DISTINCT o_orderstatus) AS a, count(DISTINCT o_orderpriority) AS b, count(DISTINCT CAST(o_orderdate AS VARCHAR)) AS c FROM orders) s,
  LATERAL (VALUES ('o_orderstatus', a, true), ('o_orderpriority', b, true), ('o_orderdate', c, true), ('o_custkey', 0, false)) v(path, n, t)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    o = dealt(table(spark, sf_dir, "orders"))
    rows = o.select(F.lit("Order").alias("class_name"), F.to_variant_object(F.struct("o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_custkey")).alias("rec"))
    return shapes.verdicts(shapes.shape_cache(rows)).select("class_name", "path", "required", "closed_enum", "open_vocabulary")


@query("schema_closed_enum", "SELECT 'Order' AS class_name, 'o_orderstatus' AS path, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS texts FROM orders")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = dealt(table(spark, sf_dir, "orders")).select(F.lit("Order").alias("class_name"), F.to_variant_object(F.struct("o_orderstatus")).alias("rec"))
    return shapes.shape_cache(rows).select("class_name", "path", F.array_join("texts", ",").alias("texts"))


# Run statistics.


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    bucket = F.when(F.col("event_type") == "error", F.lit("conflicts"))
    class_name = F.when(F.col("event_type") != "signup", F.col("event_type"))
    rows = e.select(F.col("event_id").cast("string").alias("rid"), F.lit("events").alias("record_path"), F.col("event_id").alias("record_line"), bucket.alias("b"), class_name.alias("c"), F.when(F.col("b").isNotNull(), F.concat(F.lit("bad "), (F.col("event_id") % 7).cast("string"))).alias("m"))
    return runstats.summaries(rows, F.lit(2), F.col("b"), F.col("c"), F.col("m"))


OUTCOME = "CASE WHEN event_type = 'error' THEN 'quarantined' WHEN event_type <> 'signup' THEN 'squashed' ELSE 'error' END"


@query("run_fold_outcomes", f"SELECT {OUTCOME} AS outcome, count(*) AS records, 2 * count(*) AS quads FROM events GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return runstats.fold(_summary(spark, sf_dir))


@query("run_fold_per_class", f"SELECT event_type AS class_name, count(*) AS records, 2 * count(*) AS quads FROM events WHERE {OUTCOME} = 'squashed' GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return runstats.per_class(_summary(spark, sf_dir))


@query("run_error_rollup", "SELECT 'bad ' || (event_id % 7) AS error_message, count(*) AS records FROM events WHERE event_type = 'error' GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return runstats.errors(_summary(spark, sf_dir))


@query("run_sample_ring", f"SELECT CAST(event_id AS VARCHAR) AS rid, {OUTCOME} AS outcome FROM events ORDER BY event_id DESC LIMIT 200")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return runstats.latest(_summary(spark, sf_dir)).select("rid", "outcome")


@query("stratified_sample", "SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r <= 15")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    w = W.partitionBy("p_brand").orderBy("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand").withColumn("r", F.row_number().over(w)).where("r <= 15").drop("r")


# Text extraction.


@query("html_to_text", """
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g'),
  '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#x27;', ''''), '&apos;', ''''), '&quot;', '"'), '&mdash;', '—'), '&ndash;', '–'), '&bull;', '•'), '&times;', '×'), '\\s+', ' ', 'g')) AS body FROM pages""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return table(spark, sf_dir, "pages").select("page_id", extract.html_to_text(F.col("html")).alias("body"))


@query("link_harvest", """
SELECT DISTINCT page_id, regexp_extract(a, '(?is)href="([^"]+)"', 1) AS href, trim(regexp_replace(regexp_replace(a, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS label
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href="[^"]+"[^>]*>.*?</a>')) AS a FROM pages)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(extract.links(F.col("html"))).alias("x"))
    return rows.select("page_id", F.col("x.href").alias("href"), F.col("x.text").alias("label"))


@query("page_type", """
SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'spell' WHEN contains(url, '/fr/') THEN 'monster' WHEN contains(url, '/de/') THEN 'generic' ELSE 'unknown' END AS page_type FROM pages""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """The languages in the addresses stand for the wiki's sections."""
    at = F.replace(F.replace(F.replace(F.col("url"), F.lit("/en/"), F.lit("/Spells.aspx?ID=")), F.lit("/fr/"), F.lit("/creatures.aspx/")), F.lit("/de/"), F.lit("/Other.aspx/"))
    return table(spark, sf_dir, "pages").select("page_id", extract.page_type(at).alias("page_type"))


@query("field_harvest", "SELECT p_partkey, CAST(p_size AS BIGINT) AS ac, 3 AS n_fields, p_brand AS first_value, CAST(floor(p_retailprice) AS BIGINT) * 100 AS price_cp FROM part")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p = dealt(table(spark, sf_dir, "part"))
    head = F.concat(F.lit("<b>Source</b> Book<br/><b>Brand:</b> <i>"), F.col("p_brand"), F.lit("</i>; <b>AC</b> "), F.col("p_size").cast("string"), F.lit("<br><b>Price</b> "), F.floor("p_retailprice").cast("string"), F.lit(" gp<hr/>body"))
    rows = p.select("p_partkey", extract.fields(extract.head_and_body(head)["head"]).alias("f"))
    m = rows.withColumn("m", extract.field_map(F.col("f")))
    return m.select("p_partkey", extract.stat_block(F.col("m"))["ac"].cast("long").alias("ac"), F.size("f").alias("n_fields"), F.element_at("f", 1)["value"].alias("first_value"), extract.price(F.col("m")["Price"]).alias("price_cp"))


@query("pointer_values", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    return _events(spark, sf_dir).select("event_id", F.try_variant_get(value_at(F.col("props"), "/k"), "$", "long").alias("k"))
