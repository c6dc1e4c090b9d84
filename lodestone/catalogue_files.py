"""Queries over what files hold: record and RDF sources, output options, schemas, plugins, pages."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.catalogue_graph import BASE, CUSTOMER_SQL, INSTANCES, S, _projected, _quads, _subject
from lodestone.catalogue_records import _events, table
from lodestone.functions import iri
from lodestone.functions.plan import dealt, hadoop_path, scratch
from lodestone.operators import classify, pages, shacl, shapes
from lodestone.operators.project import TERMS, exploded, type_quad
from lodestone.plans import induce, refine
from lodestone.plans.plugins import Registry
from lodestone.sources import rdf, records, sinks

CATALOGUE: dict = {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    """Registers a query with its SQL."""

    def keep(f):  # noqa: ANN001, ANN202
        CATALOGUE[name] = (f, sql)
        return f

    return keep


def _one_file(spark: SparkSession, lines: DataFrame, order: str, name: str) -> str:
    """The ``value`` lines of a small fixture in one file of a folder, in order; returns the folder."""
    at = scratch(spark)
    lines.repartition(1).sortWithinPartitions(order).select("value").write.text(at)
    store = hadoop_path(spark, at).getFileSystem(spark._jsc.hadoopConfiguration())
    part = store.globStatus(hadoop_path(spark, f"{at}/part-*"))[0].getPath()
    store.rename(part, hadoop_path(spark, f"{at}/{name}"))
    return at


@query("source_jsonl", """
SELECT n - 1 AS record_line, coalesce(k, -1) AS k, CASE WHEN event_id % 10 = 1 THEN 'JSON_READ_PARSE_ERROR' END AS error_code FROM (
  SELECT event_id, row_number() OVER (ORDER BY event_id) AS n, CASE WHEN event_id % 10 <> 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events) WHERE event_id % 10 <> 0""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """A JSONL file with blank and broken lines, read with the numbers of its lines."""
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 10 == 0, F.lit(" ")).when(F.col("event_id") % 10 == 1, F.lit("{bad")).otherwise(F.col("props"))
    at = _one_file(spark, e.select("event_id", raw.alias("value")), "event_id", "a.jsonl")
    return records.read_json_tree(spark, at, "events").select("record_line", F.coalesce(F.try_variant_get("rec", "$.k", "long"), F.lit(-1)).alias("k"), "error_code")


@query("quarantine_records", "SELECT sha1('p#' || event_id) AS id, 'events' AS target, 'projection' AS bucket, 'read' AS source, 'JSON_READ_PARSE_ERROR' AS error, 'now' AS timestamp FROM events WHERE event_id % 4 = 0")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.lit("{bad")).otherwise(F.col("props"))
    found = records.from_texts(e.select(F.lit("p").alias("record_path"), F.col("event_id").alias("record_line"), raw.alias("raw")), "events")
    rows = sinks.quarantine_rows(found, F.when(F.col("error_code").isNotNull(), F.lit("projection")), F.col("error_code"), "read", "now")
    at = scratch(spark)
    sinks.write_quarantine(rows, at)
    return spark.read.schema("id string, target string, source string, error string, timestamp string, bucket string").json(at).select("id", "target", "bucket", "source", "error", "timestamp")


# RDF.

ESCAPES_SQL = """
SELECT 'urn:d/caf' || chr(233) || doc_id AS s, chr(233) || ' ' || chr(128512) || chr(9) || chr(8) || chr(12) || '''x'' ' || chr(92) || 'u0041 "' || doc_id AS o, false AS bad FROM documents WHERE doc_id % 3 <> 0
UNION ALL SELECT NULL, NULL, true FROM documents WHERE doc_id % 3 = 0"""


@query("nquads_escapes", ESCAPES_SQL)
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """Every escape in IRIs and literals, and lines whose escape does not exist."""
    key = F.col("doc_id").cast("string")
    good = F.concat(F.lit(r"<urn:d/caf\u00e9"), key, F.lit(r"""> <urn:p> "\u00e9 \U0001F600\t\b\f\'x\' \\u0041 \""""), key, F.lit('" .'))
    bad = F.concat(F.lit("<urn:d/"), key, F.lit(r"""> <urn:p> "no \q escape" ."""))
    found = rdf.parse_nquads(table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 == 0, bad).otherwise(good).alias("value")))
    return found.select("s", "o", F.col("error").isNotNull().alias("bad"))


@query("rdf_star_roundtrip", f"""
SELECT 'triple' AS s_type, '<< <{INSTANCES}/nation/' || n_nationkey || '> <{BASE}#in> <{INSTANCES}/region/' || n_regionkey || '> >>' AS s, '{BASE}#since' AS p, n_name AS o FROM nation""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """Statements about statements, written as N-Quads and Turtle and read again; both must agree."""
    n = table(spark, sf_dir, "nation")
    triple = rdf.quoted_triple(_subject("nation", "n_nationkey"), F.lit(f"{BASE}#in"), _subject("region", "n_regionkey"))
    none = F.lit(None).cast("string")
    own = n.select(F.lit("triple").alias("s_type"), triple.alias("s"), F.lit(f"{BASE}#since").alias("p"), F.lit("literal").alias("o_type"), F.col("n_name").alias("o"), F.lit(S).alias("o_datatype"), none.alias("o_lang"), none.alias("g"))
    lines, turtle = scratch(spark), scratch(spark)
    sinks.write_quads(own, lines, "nquads-star")
    sinks.write_quads(own, turtle, "turtle-star", {"v": f"{BASE}#"})
    return rdf.read_rdf(spark, lines, "nquads-star").intersect(rdf.read_rdf(spark, turtle, "turtle-star")).select("s_type", "s", "p", "o")


def _document_query(fmt: str):  # noqa: ANN202
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        quads, at = exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer")), scratch(spark)
        sinks.write_quads(quads.select(*TERMS), at, fmt, {"v": f"{BASE}#", "i": f"{INSTANCES}/"})
        if fmt == "jsonld":  # one document a line
            return rdf.documents_quads(spark.read.text(at).select(F.lit("p").alias("path"), "value"), fmt)
        return rdf.read_documents(spark, at, fmt)

    return run


for _fmt in ("turtle", "trig", "jsonld"):
    CATALOGUE[f"{_fmt}_documents"] = (_document_query(_fmt), CUSTOMER_SQL)


@query("syntax_errors", "SELECT 'turtle' AS format, 1 AS errors UNION ALL SELECT 'trig', 0 UNION ALL SELECT 'jsonld', 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    told = [("turtle", "<urn:a> <urn:b> ."), ("trig", "<urn:g> { <urn:a> <urn:b> 1 }"), ("jsonld", "{")]
    return spark.createDataFrame([(f, len(rdf.syntax_errors(t, f))) for f, t in told], "format string, errors int")


# Output options.


@query("finalize_options", """
SELECT 'success' AS part, 4 * count(*) AS quads FROM nation UNION ALL SELECT 'ontology', count(*) FROM region UNION ALL SELECT 'graphs', 1 UNION ALL SELECT 'prefixes', 1""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """A run's end with canonical labels, graph collapse, a SHACL gate that holds, and sidecars; what was written is counted."""
    n = exploded(_projected(spark, sf_dir, "nation", "n_nationkey", "Nation")).drop("rid")
    onto = _quads(table(spark, sf_dir, "region"), F.col("r_name"), F.array(type_quad(_subject("region", "r_regionkey"), F.lit("urn:C"), F.lit("urn:graph:t/ontology")))).drop("rid")
    shape = {"iri": "urn:s", "targetClass": f"{BASE}/Nation", "properties": [{"path": f"{BASE}#n_name", "minCount": 1, "maxCount": 1}]}
    at = scratch(spark)
    report = sinks.finalize(n.unionByName(n).unionByName(onto), f"{at}/out.nq", "nquads", "t", {"v": f"{BASE}#"}, graph="urn:g/all", canonicalize=True, validate=[shape])
    told = [("success", rdf.read_nquads(spark, f"{at}/out.nq").where("g = 'urn:g/all'").count()), ("ontology", rdf.read_nquads(spark, f"{at}/out.nq.ontology").count()), ("graphs", report.graph_count)]
    told.append(("prefixes", spark.read.text(f"{at}/out.nq.prefixes.json").where("value LIKE '%urn:vocab#%'").count()))
    return spark.createDataFrame(told, "part string, quads long")


@query("finalize_buckets", "SELECT 'g-' || n_regionkey AS slug, count(*) AS quads, CAST(1 AS INTEGER) AS listed FROM nation GROUP BY 1")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """Buckets in TriG with a catalog; the statements are counted in the files."""
    n = table(spark, sf_dir, "nation")
    g = F.concat(F.lit("https://x.org/g/"), F.col("n_regionkey").cast("string"))
    quads, at = _quads(n, F.col("n_name"), F.array(type_quad(_subject("nation", "n_nationkey"), F.lit(f"{BASE}/Nation"), g))).drop("rid"), scratch(spark)
    sinks.finalize(quads, f"{at}/out", "trig", "t", {"v": f"{BASE}/"}, bucketing={}, catalog=f"{at}/catalog.xml")
    texts = spark.read.option("wholetext", True).text(f"{at}/out")
    counts = texts.select("slug", F.regexp_count("value", F.lit(" a v:Nation")).alias("n")).groupBy("slug").agg(F.sum("n").alias("quads"))
    catalog = spark.read.text(f"{at}/catalog.xml").where("value LIKE '%<uri %'").select(F.regexp_extract("value", 'slug=([^"]+)', 1).alias("slug"))
    return counts.join(catalog.groupBy("slug").agg(F.count(F.lit(1)).cast("int").alias("listed")), "slug")


@query("shacl_report_files", f"""
SELECT '[Warning] {INSTANCES}/customer/' || c_custkey || ' {BASE}#c_phone → minCount 1' AS line, CAST(1 AS INTEGER) AS results FROM customer""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """The gate's report as text, each line with its result in the Turtle report."""
    quads, at = exploded(_projected(spark, sf_dir, "customer", "c_custkey", "Customer")), scratch(spark)
    shape = {"iri": "urn:s", "targetClass": f"{BASE}/Customer", "properties": [{"path": f"{BASE}#c_phone", "minCount": 1, "severity": "Warning"}]}
    try:
        shacl.gate(quads, [shape], at)
    except shacl.ShaclError:
        pass
    focus = rdf.read_documents(spark, f"{at}/validation.report.ttl", "turtle").where(F.col("p") == shacl.SH + "focusNode").groupBy(F.col("o").alias("focus")).agg(F.count(F.lit(1)).cast("int").alias("results"))
    lines = spark.read.text(f"{at}/validation.report").select(F.col("value").alias("line"), F.regexp_extract("value", r"^\[\w+\] (\S+) ", 1).alias("focus"))
    return lines.join(focus, "focus").select("line", "results")


# Schemas.


def _orders_set(spark: SparkSession, sf_dir: str) -> dict:
    o = dealt(table(spark, sf_dir, "orders"))
    tags = F.array(F.struct(F.substring("o_orderpriority", 1, 1).alias("level")))
    rows = o.select(F.lit("Order").alias("class_name"), F.to_variant_object(F.struct("o_orderkey", "o_orderstatus", F.concat(F.lit("https://x.org/"), F.col("o_custkey").cast("string")).alias("page"), tags.alias("tags"))).alias("rec"))
    return induce.induced_set([r.asDict() for r in shapes.shape_cache(rows).collect()], "urn:x/")


@query("induced_schemas", """
SELECT 'classes' AS kind, 'Order' AS name, 'o_orderkey,o_orderstatus,page,tags' AS told UNION ALL SELECT 'objects', 'OrderTag', 'level' UNION ALL SELECT 'primitives', 'IriString', 'iri'
UNION ALL SELECT 'primitives', 'OrderOOrderkey', min(o_orderkey) || '..' || max(o_orderkey) FROM orders UNION ALL SELECT 'primitives', 'OrderOOrderstatus', string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) FROM orders
UNION ALL SELECT 'primitives', 'OrderTagLevel', string_agg(DISTINCT o_orderpriority[1], ',' ORDER BY o_orderpriority[1]) FROM orders""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    found = _orders_set(spark, sf_dir)
    told = lambda s: ",".join(sorted(s["properties"])) if "properties" in s else ",".join(s["enum"]) if "enum" in s else s["format"] if "format" in s else f"{s['minimum']}..{s['maximum']}"
    return spark.createDataFrame([(kind, name, told(s)) for kind, schemas in found.items() for name, s in schemas.items()], "kind string, name string, told string")


@query("refined_schema", """
SELECT * FROM (VALUES ('class', 'Order', 'https://x.org/Thing'), ('property', 'number', 'ref'), ('property', 'page', 'label'), ('property', 'tags', 'array'), ('required', 'number,page,tags', ''), ('warning', 'DROP_UNRESOLVED', '/nope')) t(part, name, told)""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    spec = {"drop": ["/o_orderstatus", "/nope"], "rename": {"/o_orderkey": "number"}, "rdfsLabel": {"page": "the page"}, "parents": ["https://x.org/Thing"]}
    final, warnings = refine.refine(_orders_set(spark, sf_dir)["classes"]["Order"], spec)
    kind = lambda s: "label" if any(k.endswith("rdfs-label") for k in s) else "array" if s.get("type") == "array" else "ref" if "$ref" in s else "plain"
    rows = [("class", final["title"], final["allOf"][0]["$ref"]), *[("property", k, kind(v)) for k, v in final["properties"].items()], ("required", ",".join(sorted(final["required"])), ""), *[("warning", w.code, w.pointer) for w in warnings]]
    return spark.createDataFrame(rows, "part string, name string, told string")


# Plugins and names.


@query("plugin_cascade", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'Failure' ELSE upper(event_type[1]) || event_type[2:] END AS class_name, CASE WHEN event_type = 'error' THEN 'urn:plugin' ELSE 'classify:discriminator' END AS engine FROM events")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """Two plugins: one configures the discriminator, one that requires it adds proposals of its own."""
    base = SimpleNamespace(name="base", classification={"discriminator": {"from": "/event_type", "sanitize": "pascalCase"}, "source": False})
    failed = lambda rec: F.try_variant_get(rec, "$.event_type", "string") == "error"
    more = SimpleNamespace(name="more", requires=["base"], proposals=lambda rec: [F.when(failed(rec), classify.proposal("urn:plugin", F.lit("Failure"), 90, 1, F.array(F.lit("plugin"))))])
    registry = Registry()
    registry.register(more)
    registry.register(base)
    c = F.col("classification")
    return registry.classify(_events(spark, sf_dir), {}).select("event_id", c["type"].alias("class_name"), c["engine"].alias("engine"))


@query("iri_normal_form", """
SELECT page_id, 'https://' || regexp_extract(url, '://(.*)$', 1) AS normal, 'https://' || regexp_extract(url, '://([^/]*)', 1) || '/x/y?q' AS resolved, split_part(regexp_extract(url, '://([^/]*)', 1), '.', 1) AS label FROM pages""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    host = F.regexp_extract("url", "://([^/]*)", 1)
    loud = F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(":443"), F.regexp_extract("url", "://[^/]*(.*)$", 1))
    p = table(spark, sf_dir, "pages").select("page_id", "url", host.alias("host"), loud.alias("loud"))
    dotted = iri.normalized_column(F.concat(F.lit("https://"), F.col("host"), F.lit("/a/../x/./y?q")))
    label = iri.implicit_label(F.concat(F.lit("urn:n:a-"), F.substring_index("host", ".", 1)), {"n": "urn:n:"})
    return p.select("page_id", iri.normalized_column(F.col("loud")).alias("normal"), dotted.alias("resolved"), label.alias("label"))


# Pages.

SPAN = '<span><h1 class="title">'


def _facts(*facts: tuple[str, str, str]) -> list:
    return [F.try_variant_get("rec", path, kind).alias(name) for name, path, kind in facts]


@query("page_equipment", """
SELECT p_partkey, 'Equipment' AS class_name, p_name AS name, p_size AS item_level, CAST(floor(p_retailprice) AS BIGINT) AS gp, p_brand AS usage, 'one-action' AS cost, 'interact' AS component, 'About ' || p_type AS described, p_size + 1 AS greater_level FROM part""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p = dealt(table(spark, sf_dir, "part"))
    page = F.concat(
        F.lit(SPAN), F.col("p_name"), F.lit('<span style="margin-left:auto">Item '), F.col("p_size").cast("string"), F.lit('</span></h1><b>Source</b> <a href="Sources.aspx?ID=1"><i>Book pg. 3</i></a><br/><b>Price</b> '), F.floor("p_retailprice").cast("string"),
        F.lit(" gp; <b>Bulk</b> L<br/><b>Usage</b> "), F.col("p_brand"), F.lit("<br/><b>Activate</b> <span class='action'>[one-action]</span> (Interact)<hr/>About "), F.col("p_type"),
        F.lit('<h2 class="title">Best (Greater) Item '), (F.col("p_size") + 1).cast("string"), F.lit("</h2><b>Price</b> 9 gp<br/>more</span>"),
    )
    rows = p.select("p_partkey", F.concat(F.lit("https://x.org/Equipment.aspx?ID="), F.col("p_partkey").cast("string")).alias("url"), page.alias("html"))
    done = classify.cascade(pages.page_records(rows), pages.class_rules())
    facts = [("name", "$.name", "string"), ("item_level", "$.item_level", "int"), ("gp", "$.price.gp", "long"), ("usage", "$.usage", "string"), ("cost", "$.activations[0].action_cost", "string"), ("component", "$.activations[0].components[0]", "string")]
    return done.select("p_partkey", F.col("classification.type").alias("class_name"), *_facts(*facts, ("described", "$.description_text", "string"), ("greater_level", "$.variants[0].item_level", "int")))


@query("page_monsters", """
SELECT c_custkey, c_nationkey AS ac, 2 * c_nationkey AS hp, 'mind' AS special, c_nationkey + 1 AS fly, 'claw' AS weapon, c_nationkey AS attack, 'fire' AS damage, 'Roar' AS ability, c_mktsegment AS lore FROM customer""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    c, n = dealt(table(spark, sf_dir, "customer")), F.col("c_nationkey").cast("string")
    page = F.concat(
        F.lit(SPAN), F.col("c_name"), F.lit('<span style="margin-left:auto">Creature 1</span></h1><b>Source</b> Book<br/><b>Recall Knowledge</b> DC 15 • '), F.col("c_mktsegment"), F.lit(" (Arcana)<br/><hr/><b>AC</b> "), n,
        F.lit("; <b>Fort</b> +1<br/><b>HP</b> "), (2 * F.col("c_nationkey")).cast("string"), F.lit(' (mind)<br/><span class="hanging-indent"><b>Roar</b> <span class="action">[reaction]</span> <b>Effect</b> loud</span><hr/><b>Speed</b> 10 feet, fly '),
        (F.col("c_nationkey") + 1).cast("string"), F.lit(' feet<br/><span class="hanging-indent"><b>Melee</b> claw +'), n, F.lit(" [+1/-4] (agile), <b>Damage</b> 1d6+2 fire</span></span>"),
    )
    rows = pages.page_records(c.select("c_custkey", F.lit("https://x.org/Monsters.aspx?ID=1").alias("url"), page.alias("html")))
    facts = [("ac", "$.ac.value", "int"), ("hp", "$.hp.value", "int"), ("special", "$.hp.special", "string"), ("fly", "$.speed.fly", "int"), ("weapon", "$.strikes[0].weapon", "string"), ("attack", "$.strikes[0].attack_bonus", "int")]
    return rows.select("c_custkey", *_facts(*facts, ("damage", "$.strikes[0].damage[0].type", "string"), ("ability", "$.defensive_abilities[0].name", "string"), ("lore", "$.recall_knowledge.lores[0].trait", "string")))


@query("page_spells", """
SELECT p_partkey, 'ritual' AS kind, p_size AS rank, 'arcane' AS tradition, p_brand AS cast_time, 'Will' AS save, true AS basic, p_type AS failure, 2 AS increment, 'burn' AS affliction, p_size AS stage FROM part""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p, n = dealt(table(spark, sf_dir, "part")), F.col("p_size").cast("string")
    page = F.concat(
        F.lit(SPAN), F.col("p_name"), F.lit('<span style="margin-left:auto">Ritual '), n, F.lit("</span></h1><b>Source</b> Book<br/><b>Traditions</b> Arcane, other<br/><b>Cast</b> "), F.col("p_brand"),
        F.lit("<br/><b>Saving Throw</b> basic Will<hr/>Text. <b>burn</b> (curse); <b>Level</b> 3. <b>Stage "), n, F.lit("</b> hot (1 day)<b>Failure</b> "), F.col("p_type"), F.lit("<b>Heightened (+2)</b> more</span>"),
    )
    rows = pages.page_records(p.select("p_partkey", F.lit("https://x.org/Rituals.aspx?ID=1").alias("url"), page.alias("html")))
    facts = [("kind", "$.kind", "string"), ("rank", "$.rank", "int"), ("tradition", "$.traditions[0]", "string"), ("cast_time", "$.cast.time", "string"), ("save", "$.saving_throw.kind", "string"), ("basic", "$.saving_throw.basic", "boolean")]
    return rows.select("p_partkey", *_facts(*facts, ("failure", "$.outcomes.failure", "string"), ("increment", "$.heightened[0].increment", "int"), ("affliction", "$.affliction.name", "string"), ("stage", "$.affliction.stages[0].stage", "int")))


@query("page_other_kinds", """
SELECT n_nationkey, CASE n_nationkey % 8 WHEN 0 THEN 'feat' WHEN 1 THEN 'action' WHEN 2 THEN 'ancestry' WHEN 3 THEN 'class' WHEN 4 THEN 'background' WHEN 5 THEN 'condition' WHEN 6 THEN 'trait' ELSE 'hazard' END AS kind,
  CASE n_nationkey % 8 WHEN 0 THEN n_name WHEN 1 THEN n_name WHEN 2 THEN '8' WHEN 3 THEN '10' WHEN 4 THEN 'Strength' WHEN 5 THEN '1' WHEN 6 THEN 'spell' ELSE '21' END AS fact FROM nation""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    """A page of each other kind, with one of its facts."""
    at = ["Feats", "Actions", "Ancestries", "Classes", "Backgrounds", "Conditions", "Traits", "Hazards"]
    body = ["<b>Special</b> NAME", "<b>Success</b> NAME", "", "", "One must be to Strength or Wisdom", "<b>Stage 1</b> x", '<a href="Spells.aspx?ID=1">Bane</a>', ""]
    head = ["", "", "<b>Hit Points</b> 8<br/>", "<b>Hit Points</b> 10 plus<br/>", "", "", "", "<b>Stealth</b> DC 21<br/>"]
    fact = ["$.special", "$.outcomes.success", "$.mechanics.hit_points", "$.hp_per_level", "$.attribute_boost_choice.fixed_options[0]", "$.stages[0].stage", "$.category", "$.stealth.dc"]
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("n_nationkey") % 8 + 1).cast("int"))
    page = F.concat(F.lit(SPAN + "T</h1><b>Source</b> Book<br/>"), pick(head), F.lit("<hr/>"), F.replace(pick(body), F.lit("NAME"), F.col("n_name")), F.lit("</span>"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("https://x.org/"), pick(at), F.lit(".aspx")).alias("url"), page.alias("html"))
    rows = pages.page_records(n)
    told = F.coalesce(*[F.when(F.col("n_nationkey") % 8 == i, F.try_variant_get("rec", f, "string")) for i, f in enumerate(fact)])
    return rows.select("n_nationkey", F.try_variant_get("rec", "$._type", "string").alias("kind"), told.alias("fact"))


@query("wiki_pages", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'move' WHEN 1 THEN 'tcg_pokemon_card' WHEN 2 THEN 'location' ELSE 'learnset_data' END AS kind, CASE WHEN p_partkey % 4 < 3 THEN p_name END AS name,
  CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN p_brand WHEN 2 THEN 'route' ELSE 'IV' END AS fact FROM part""")
def _(spark, sf_dir):  # noqa: ANN001, ANN202
    p, k = dealt(table(spark, sf_dir, "part")), F.col("p_partkey") % 4
    text = (
        F.when(k == 0, F.concat(F.lit("{{MoveInfobox|name={{tt|"), F.col("p_name"), F.lit("|note}}|power="), F.col("p_size").cast("string"), F.lit("}}")))
        .when(k == 1, F.concat(F.lit("{{PokémoncardInfobox|cardname=[[x|"), F.col("p_name"), F.lit("]]}} {{PokémoncardInfobox/Expansion|expansion={{TCG|"), F.col("p_brand"), F.lit("}}|cardno=1}}")))
        .when(k == 2, F.concat(F.lit("{{Route infobox|name="), F.col("p_name"), F.lit("}}"))).otherwise(F.lit("text"))
    )
    rows = p.select("p_partkey", pages.wiki_column(F.lit("Bulb/Generation IV learnset"), text).alias("rec"))
    get = lambda path: F.try_variant_get("rec", path, "string")
    return rows.select("p_partkey", get("$._type").alias("kind"), get("$.name").alias("name"), F.coalesce(get("$.power"), get("$.expansions[0].expansion"), get("$.location_type"), get("$.generation")).alias("fact"))
