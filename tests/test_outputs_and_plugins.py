import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lodestone.errors import FileOutputError
from lodestone.functions import iri
from lodestone.operators import pages, viz
from lodestone.operators.ontology import Ontology
from lodestone.operators.project import TERMS
from lodestone.plans import config as cfg
from lodestone.plans import induce, refine
from lodestone.plans.build import run
from lodestone.plans.plugins import Registry
from lodestone.sources import rdf, records, sinks

QUAD = ", ".join(f"{t} string" for t in TERMS)
XS = "http://www.w3.org/2001/XMLSchema#"


def test_jsonl_lines_over_many_splits(spark, tmp_path):
    lines = [("" if i % 9 == 4 else json.dumps({"n": i, "pad": "x" * (i % 50)})) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("\r\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("\n\n" + '{"n": -1}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = records.read_json_tree(spark, str(tmp_path), "t")
        assert got.select(F.spark_partition_id()).distinct().count() > 4
        told = got.select("record_line", F.try_variant_get("rec", "$.n", "int").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.record_line, r.n) for r in told) == sorted([(i, i) for i in range(3000) if i % 9 != 4] + [(2, -1)])
    (tmp_path / "c.txt").write_text('{"n": 7}')
    assert records.read_json_tree(spark, str(tmp_path / "c.txt"), "t").first().record_line == 0


def quads_of(spark, rows):
    return spark.createDataFrame(rows, QUAD)


def test_gate_and_blank_labels_in_finalize(spark, tmp_path):
    rows = [("iri", "urn:a", rdf.RDF_TYPE, "iri", "urn:C", None, None, None), ("blank", "x9", "urn:p", "literal", "1", XS + "string", None, None), ("iri", "urn:a", "urn:q", "blank", "x9", None, None, None)]
    (tmp_path / "shapes.ttl").write_text('@prefix sh: <http://www.w3.org/ns/shacl#> .\n<urn:s> a sh:NodeShape ; sh:targetClass <urn:C> ; sh:property [ sh:path <urn:z> ; sh:minCount 1 ; sh:severity sh:Warning ; sh:in ( "a" "b" ) ] .')
    out = str(tmp_path / "out.nq")
    with pytest.raises(FileOutputError) as e:
        sinks.finalize(quads_of(spark, rows), out, "nquads", "t", validate={"shapes": str(tmp_path / "shapes.ttl")})
    assert e.value.metadata["report"] == ["[Warning] urn:a urn:z → minCount 1"] and not (tmp_path / "out.nq").exists()
    assert (tmp_path / "out.nq.quarantine" / "output" / "validation.report.ttl").exists()
    report = sinks.finalize(quads_of(spark, rows), out, "nquads", "t", {"e": "urn:"}, canonicalize=True)
    lines = spark.read.text(out)
    assert sorted(r.value for r in lines.collect()) == sorted(['<urn:a> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <urn:C> .', '_:c14n0 <urn:p> "1" .', "<urn:a> <urn:q> _:c14n0 ."])
    assert report.quad_count == 3 and report.bytes_written > 0 and json.loads((tmp_path / "out.nq.prefixes.json").read_text()) == {"e": "urn:"}
    unknown = [("blank", "b", "http://www.w3.org/ns/shacl#path", "iri", "urn:p", None, None, None), ("blank", "b", "http://www.w3.org/ns/shacl#xone", "iri", "urn:p", None, None, None), ("iri", "s", "http://www.w3.org/ns/shacl#property", "blank", "b", None, None, None), ("iri", "s", rdf.RDF_TYPE, "iri", "http://www.w3.org/ns/shacl#NodeShape", None, None, None)]
    from lodestone.operators import shacl

    with pytest.raises(ValueError, match="xone"):
        shacl.shapes_of(unknown)


def test_jsonld_contexts_and_star_formats(spark, tmp_path):
    rows = [("iri", "urn:v#a", rdf.RDF_TYPE, "iri", "urn:v#C", None, None, "urn:g"), ("iri", "urn:v#a", "urn:v#n", "literal", "5", XS + "integer", None, "urn:g"), ("iri", "urn:v#a", "urn:v#l", "iri", "urn:b", None, None, "urn:g"), ("iri", "urn:v#a", "urn:v#t", "literal", "hi", rdf.LANG_STRING, "en", "urn:g")]
    q = quads_of(spark, rows)
    for context in ("auto", {"@context": {"v": "urn:v#", "n": {"@id": "v:n", "@type": XS + "integer"}}}):
        own = sinks.resolve_context(q, context, {"v": "urn:v#", "xsd": XS})
        at = str(tmp_path / f"j{len(str(context))}")
        sinks.write_quads(q, at, "jsonld", context=own)
        docs = [r.value for r in spark.read.text(at).collect()]
        assert {x for d in docs for x in rdf.parse_jsonld(d)} == set(rows) and all("urn:v#n" not in d.split('"@graph"')[1] for d in docs)
    star = [("triple", "<< <urn:a> <urn:b> <urn:c> >>", "urn:p", "iri", "urn:o", None, None, None)]
    with pytest.raises(Exception, match="-star"):
        sinks.write_quads(quads_of(spark, star), str(tmp_path / "no"), "nquads")
    sinks.write_quads(quads_of(spark, star), str(tmp_path / "yes"), "trig-star")
    assert rdf.read_rdf(spark, str(tmp_path / "yes"), "trig-star").collect()[0][:] == tuple(star[0])


def test_turtle_files_hold_their_prefixes_once_and_hubs_are_split(spark, tmp_path, monkeypatch):
    rows = [("iri", "urn:hub", "urn:p", "iri", f"urn:o{i}", None, None, None) for i in range(40)] + [("iri", f"urn:s{i}", "urn:p", "iri", "urn:o", None, None, None) for i in range(5)]
    monkeypatch.setattr(sinks, "BLOCK_QUADS", 10)
    sinks.write_quads(quads_of(spark, rows).coalesce(1), str(tmp_path / "t"), "turtle", {"e": "urn:"})
    texts = [f.read_text() for f in (tmp_path / "t").glob("part-*") if f.stat().st_size]
    assert all(t.count("@prefix") == 1 for t in texts) and sum(t.count("e:hub\n") for t in texts) == 4
    assert sorted(q for t in texts for q in rdf.parse_turtle(t)[0]) == sorted(rows)


def test_run_with_plugins_options_and_stage_log(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(json.dumps({"_type": "feat", "id": f"https://x.org/i/{i}", "links": [{"href": f"/{i - 1}", "text": "t"}]}) for i in range(3)))
    (tmp_path / "plug.py").write_text("from types import SimpleNamespace\n\ndef register(r):\n    r.register(SimpleNamespace(name='p', classification={'discriminator': {'from': '/_type', 'sanitize': 'pascalCase'}}, classes={'Feat': {'properties': {'links': {'kind': 'object', 'properties': {'href': {}, 'text': {}}}}}}))\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    doc = {"target": "t", "plugin": "plug", "input": {"path": str(tmp_path / "in"), "format": "jsonl"}, "vocabulary": "urn:v", "instances": "https://x.org/i", "subjectIri": {"from": "/id", "sanitize": "verbatim"},
           "output": {"path": str(tmp_path / "out"), "format": "trig", "bucketing": {"enabled": True}, "catalog": {"path": str(tmp_path / "catalog.xml")}, "provenance": True},
           "enrichment": {"entityLink": {"canonicalBase": "https://x.org/i/", "linkPredicates": ["urn:v#links"], "hrefPredicate": "urn:v#href"}}}
    report, fold = run(spark, cfg.from_document(doc), {}, run_start="2024-01-01T00:00:00Z")
    assert fold["squashed"][0] == 3 and report.buckets == {"__default__": report.quad_count} and "__default__" in (tmp_path / "catalog.xml").read_text()
    found = {(q[1], q[2], q[4]) for f in (tmp_path / "out").rglob("part-*") for q in rdf.parse_turtle(f.read_text())[0]}
    assert ("https://x.org/i/2", "urn:v#links", "https://x.org/i/1") in found and ("https://x.org/i/0", "urn:v#links", "https://x.org/i/0/links/0") in found
    prov = rdf.read_nquads(spark, str(tmp_path / "out.prov.nq"))
    assert prov.where(F.col("o").endswith("prov#Activity")).count() == 4 and prov.where(F.col("p").endswith("wasInformedBy")).count() == 3
    broken = Ontology({"A": {"properties": {"x": "no schema"}}}, "urn:v")
    report, _ = run(spark, cfg.from_document(doc | {"output": {"path": str(tmp_path / "o2.nq"), "dryRun": True}}), {}, broken)
    assert report.errors[0].startswith("ONTOLOGY_EMIT_ERROR") and not (tmp_path / "o2.nq").exists()
    registry = Registry()
    registry.register(SimpleNamespace(name="a", requires=["b"]))
    for bad in (lambda: registry.ordered(), lambda: registry.register(SimpleNamespace(name="a")), lambda: registry.register(object()), lambda: registry.load("no.such.module"), lambda: registry.load("json")):
        with pytest.raises(cfg.ConfigError):
            bad()


def test_draft_files_and_their_errors(tmp_path):
    (tmp_path / "inferred" / "primitives").mkdir(parents=True)
    put = lambda name, text: (tmp_path / name).write_text(text)
    put("inferred/A.draft.json", '{"properties": {"x": {}}}')
    put("inferred/B.draft.json", "[1]")
    put("inferred/C.draft.json", "{")
    put("inferred/D.draft.json", "{}")
    put("inferred/primitives/P.draft.json", "{}")
    put("A.refine.json", '{"rename": {"/x": "y"}}')
    put("D.refine.json", '{"explode": 1}')
    put("P.refine.json", "{}")
    walked = refine.walk_drafts(str(tmp_path / "inferred"), str(tmp_path))
    assert [(d.name, d.refinement is not None, d.subfolder) for d in walked] == [("A", True, None), ("B", False, None), ("C", False, None), ("D", True, None), ("P", False, "primitives")]
    finals, warnings, tally, errors = refine.refine_folder(str(tmp_path / "inferred"), str(tmp_path))
    assert {n: e.code for n, e in errors.items()} == {"B": "READ_DRAFT_NOT_OBJECT", "C": "READ_DRAFT_PARSE", "D": "READ_REFINEMENT_INVALID"} and tally == {"refined": 1, "passthrough": 1, "errors": 3}
    assert finals["A"]["properties"] == {"y": {}} and warnings["P"][0].code == "REFINEMENT_MISSING"
    with pytest.raises(refine.RefineError) as e:
        refine.apply_refinement(None, {})
    assert e.value.code == "APPLY_REFINEMENT_NULL_INPUT" and refine.walk_drafts(str(tmp_path / "none"), str(tmp_path)) == []
    with pytest.raises(refine.RefineError) as e:
        refine.read_object(str(tmp_path / "gone"), "READ_DRAFT")
    assert e.value.code == "READ_DRAFT_IO"


def test_extraction_names_and_dictionaries():
    x = induce.Extraction("urn:x/")
    assert x.placed("tags", "C", {"type": "array", "items": {"enum": ["a"]}})["items"]["$ref"].endswith("primitives/CTag.draft.json")
    assert x.placed("tags", "C", {"type": "array", "items": {"enum": ["b"]}})["items"]["$ref"].endswith("primitives/CTag_2.draft.json")
    assert x.placed("other", "C", {"enum": ["a"]})["$ref"].endswith("primitives/CTag.draft.json")
    assert x.placed("inline", "C", {"properties": {"k": {"enum": ["z"]}}}) == {"properties": {"k": {"enum": ["z"]}}} and x.placed("plain", "C", {"type": "string"}) == {"type": "string"}
    ref = x.placed("counts", "C", {"items": {"properties": {str(i): {"minimum": 1} for i in range(-1, 5)}, "required": ["1"]}})["items"]["$ref"]
    own = x.found["objects"]["CCount"]
    assert ref == own["$id"] and "properties" not in own and own["additionalProperties"]["$ref"].endswith("primitives/CCountEntry.draft.json")
    assert induce.item_name("as") == "as_item" and induce.object_name("boxes", "my_class") == "MyClassBoxe" and not induce.looks_like_dictionary(["a_b"] * 40)
    o = Ontology({"C": {"properties": {"other": {"$ref": x.by_content[json.dumps({"enum": ["a"]}, sort_keys=True)]}}}}, "urn:v", x.found["primitives"])
    assert o.denormalized("C")["properties"]["other"] == {"enum": ["a"]}


def test_names_and_bounds(spark):
    assert cfg.resolve_namespaces("T", {"x": "https://x.org/", "tg": "urn:y/", "v": "urn:v#"}) == {"instances": {"prefix": "x", "base": "https://x.org/"}, "graphs": {"prefix": "tg", "base": "urn:y/"}, "vocabulary": {"prefix": "v", "base": "urn:v#"}, "source": "config"}
    derived = cfg.resolve_namespaces("t", {"g": "urn:a/graph/"}, "https://2e.wiki.example.com/A.aspx", "https://e.org/Words/")
    assert derived["instances"] == {"prefix": "example", "base": "https://2e.wiki.example.com/"} and derived["vocabulary"]["prefix"] == "words" and derived["source"] == "derived"
    assert cfg.resolve_namespaces("t")["source"] == "fallback" and cfg.host_prefix("co.uk") is None
    out, warnings = cfg.clamp_config({"concurrency": 99, "batchSize": float("inf"), "maxPages": 5, "name": "x", "maxRetries": True}, "t")
    assert out == {"concurrency": 32, "batchSize": 1, "maxPages": 5, "name": "x", "maxRetries": True} and len(warnings) == 2
    assert iri.namespace("urn:x#")("a") == "urn:x#a" and iri.resolved("http://A.org/b/c", "../d?e") == "http://a.org/d?e"
    for bad in (lambda: iri.namespace("urn:x"), lambda: iri.normalized("no iri"), lambda: iri.resolved("x", "y")):
        with pytest.raises(ValueError):
            bad()
    told = spark.createDataFrame([("abc",), ("Zürich",), ("",)], "s string").select("s", viz.seeded_random_column(F.col("s")).alias("r")).collect()
    assert all(r.r == viz.seeded_random(r.s) and -1 <= r.r < 1 for r in told)


def test_graph_export(spark, tmp_path):
    rows = [("iri", f"http://e.org/n{i}", "urn:v#knows", "iri", f"http://e.org/n{(i * 3) % 12}", None, None, f"urn:g{i % 2}") for i in range(12)] + [("iri", f"http://e.org/n{i}", "urn:v#bodyText", "literal", "noise", XS + "string", None, f"urn:g{i % 2}") for i in range(12)]
    rows += [("iri", f"http://e.org/n{i}", "urn:v#name", "literal", f"N{i}", XS + "string", None, f"urn:g{i % 2}") for i in range(0, 12, 2)]
    nodes, edges, graphs = viz.property_graph(quads_of(spark, rows), {"v": "urn:v#"})
    manifest = viz.export(nodes, edges, str(tmp_path))
    assert manifest["totalNodes"] == 12 and [f["nodeBase"] for f in manifest["frames"]] == [0, 6] and graphs.count() == 2
    frames = [viz.read_frame((tmp_path / f["file"]).read_bytes()) for f in manifest["frames"]]
    assert all(f["colours"].shape[1] == 4 and len(f["sizes"]) == 6 for f in frames) and sum(len(f["edges"]) for f in frames) == manifest["totalEdges"]
    import gzip

    meta = json.loads(gzip.decompress((tmp_path / "meta.json.gz").read_bytes()))
    assert [meta["prefixes"][p] + rest for p, rest in zip(meta["pIdx"], meta["locals"])][0].startswith("http://e.org/n") and "N0" in meta["labels"]
    shard = json.loads(gzip.decompress((tmp_path / manifest["frames"][0]["dataFile"]).read_bytes()))
    assert all(set(p) == {"name"} for p in shard["props"].values()) and (tmp_path / "index.html").exists() and len(json.loads((tmp_path / "index.json").read_text())["chunks"]) == 2
    n, e, _ = viz.jsonld_graph(spark, '{"@context":{"v":"urn:v#"},"@id":"urn:v#a","@type":"v:C","v:name":"A","v:to":{"@id":"urn:v#x-b"}}')
    assert {(r.id, r.label, r.class_label) for r in n.collect()} == {("urn:v#a", "A", "v:C"), ("urn:v#x-b", "b", None)} and e.first().label == "v:to"


def test_pages_without_content_and_redirects():
    assert pages.page_record("<p>x</p>", "https://x.org/Spells.aspx")["_type"] == "unknown" and pages.wiki_record("t", "#REDIRECT [[x]]") is None and pages.wiki_record("t", None) is None
    two = '<span><h1 class="title">A</h1></span><span><h1 class="title">B</h1><b>Source</b> Book</span>'
    assert pages.page_record(two, "https://x.org/Deities.aspx?ID=1")["name"] == "B"
    weapon = '<span><h1 class="title">Axe</h1><b>Source</b> Book<br/><b>Price</b> 1 gp, 5 sp; <b>Damage</b> 1d8 S plus 1d4 fire; <b>Bulk</b> 2<br/><b>Hands</b> 1+; <b>Range</b> 20 feet<br/><b>Type</b> Melee; <b>Category</b> Martial; <b>Group</b> <a href="WeaponGroups.aspx?ID=3">Axe</a><hr/>Text</span>'
    r = pages.page_record(weapon, "https://x.org/Weapons.aspx?ID=1")
    assert (r["price"]["gp"], r["price"]["sp"], r["damage"], r["bulk"], r["hands"], r["range"], r["weapon_type"], r["category"], r["group"]) == (1, 5, {"dice": "1d8", "type": "S", "rider": "plus 1d4 fire"}, 2, "1+", {"feet": 20}, "melee", "martial", {"name": "Axe", "group_id": 3})
    hazard = '<span><h1 class="title">Trap</h1><b>Source</b> Book<br/><b>Complexity</b> Simple<br/><b>Stealth</b> DC 20 hidden<br/><b>Disable</b> DC 18 Thievery to cut, or DC 22 Athletics<br/><b>Wall HP</b> 40 (BT 20); <b>Resistances</b> fire 5 (except magic)<br/><b>Bang</b> [reaction]<br/><b>Trigger</b> step<br/><hr/></span>'
    r = pages.page_record(hazard, "https://x.org/Hazards.aspx?ID=1")
    assert r["complexity"] == "simple" and [d["dc"] for d in r["disable"]] == [18, 22] and r["defenses"]["hp"] == [{"component": "Wall", "value": 40, "bt": 20, "notes": None}] and r["routines"][0]["trigger"] == "step"
