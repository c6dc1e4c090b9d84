import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import canonical, classify, project, reconcile, runstats, shacl, viz
from lodestone.operators.ontology import Ontology, relaxed
from lodestone.operators.project import TERMS
from lodestone.plans import config as cfg
from lodestone.plans import induce, refine
from lodestone.plans.build import bootstrap, build
from lodestone.sources import rdf, records, sinks

QUAD = ", ".join(f"{t} string" for t in TERMS)
XS = "http://www.w3.org/2001/XMLSchema#"


def quads_of(spark, rows):
    return spark.createDataFrame(rows, QUAD)


def tree(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text('{"_type":"feat","name":"Power Attack","level":1,"_source":{"target":"t","url":"https://x.org/Feats.aspx?ID=1"}}')
    (tmp_path / "in" / "deep" / "b.jsonl").write_text('{"_type":"spell","name":"Fire","tags":["Hot","Red Thing"]}\n\n{bad\n[1]\n{"_type":"spell","_source":{"target":"other"}}\n')
    return str(tmp_path / "in")


def test_json_tree(spark, tmp_path):
    got = records.read_json_tree(spark, tree(tmp_path), "t").select("record_line", "error_code").collect()
    assert sorted((r.record_line, r.error_code or "") for r in got) == [(0, ""), (0, ""), (2, "JSON_READ_PARSE_ERROR"), (3, "JSON_READ_NON_OBJECT"), (4, "JSON_READ_TARGET_MISMATCH")]
    assert records.read_json_tree(spark, tree(tmp_path / "x"), "t", ("json",)).count() == 1


def test_build_end_to_end(spark, tmp_path):
    c = cfg.from_document({"target": "t", "input": {"path": tree(tmp_path)}, "output": {"path": str(tmp_path / "out.nq")}, "vocabulary": "urn:v", "instances": "urn:i",
                           "classification": {"discriminator": {"from": "/_type", "sanitize": "pascalCase"}}, "enrichment": {"arrayEnumIri": {"tags": "Tag"}, "provenance": True}, "subjectIri": {"from": "/name", "sanitize": "slug"}})
    classes = {"Feat": {"properties": {"name": {}, "level": {}}}, "Generic": {"properties": {"name": {}}}}
    made = build(records.read_json_tree(spark, c.input_path, "t"), c, classes)
    found = {(r.s, r.p, r.o) for r in made.quads.collect()}
    assert ("urn:i/power-attack", "urn:v#level", "1") in found and ("urn:i/fire", "urn:v#tags", "urn:v#Tag-Red-Thing") in found
    assert {r.bucket: r.n for r in made.quarantine.groupBy("bucket").agg(F.count("*").alias("n")).collect()} == {"projection": 3}
    assert {r.outcome: r.records for r in runstats.fold(made.summary).collect()} == {"squashed": 2, "quarantined": 3}
    report = sinks.finalize(made.quads.drop("rid"), c.output["path"], "nquads", "t")
    again = rdf.read_nquads(spark, c.output["path"])
    success = sinks.split(made.quads, "t")["success"].select(*TERMS).distinct()
    assert report.quad_count == again.count() and again.exceptAll(success).count() == 0
    assert sinks.finalize(made.quads.drop("rid"), str(tmp_path / "dry"), "nquads", "t", dry_run=True).quad_count == report.quad_count and not (tmp_path / "dry").exists()


def test_bootstrap_gates_and_runs(spark, tmp_path):
    c = cfg.from_document({"target": "t", "input": {"path": tree(tmp_path)}, "output": {"path": str(tmp_path / "out.nq")}, "vocabulary": "urn:v", "classification": {"discriminator": {"from": "/_type", "sanitize": "pascalCase"}}})
    assert bootstrap(spark, c, str(tmp_path / "s"))["halted"] == "refine-required"
    done = bootstrap(spark, c, str(tmp_path / "s"), {"Feat": {"rename": {"/level": "rank"}, "parents": ["Thing"]}})
    assert done["tally"] == {"refined": 1, "passthrough": 1, "errors": 0} and done["fold"]["squashed"][0] == 2
    assert "rank" in json.loads((tmp_path / "s" / "Feat.schema.json").read_text())["properties"]


def test_cascade_ties_and_evidence(spark):
    rows = spark.createDataFrame([("1", '{"t":"x","n":1}')], "rid string, j string").select("rid", F.parse_json("j").alias("rec"))
    spec = {"rules": [{"className": "A", "priority": 50, "predicate": {"path": "/n", "equals": 1}, "reasons": ["r"]}], "discriminator": {"from": "/t"}, "source": False}
    assert classify.cascade(rows, spec).first().classification.bucket == "conflicts"
    picked = classify.cascade(rows, spec | {"onConflict": "pick"}).first().classification
    assert (picked.type, picked.candidates, picked.engine) == ("A", ["A", "x"], "classify:rules")
    none = classify.cascade(rows, {"source": False}).first().classification
    assert (none.type, none.confidence, none.engine) == ("Generic", 0.0, "classify:generic-fallback")
    cyclic = classify.closure([("a", "b"), ("b", "a")])
    assert cyclic == {"a": {"a", "b"}, "b": {"a", "b"}}


def test_shapes_do_not_depend_on_order(spark):
    data = [{"name": f"n{i}", "tags": [{"k": i % 2}], "o": {"x": i / 2}, "u": f"https://x/{i}"} | ({"z": None} if i % 3 else {}) for i in range(30)]
    df = spark.createDataFrame([("C", json.dumps(d)) for d in data], "class_name string, j string").select("class_name", F.parse_json("j").alias("rec"))
    a, b = induce.induce(df.repartition(1)), induce.induce(df.repartition(7, "rec" if False else F.rand(3)))
    assert induce.to_text(a["C"]) == induce.to_text(b["C"])
    s = a["C"]
    assert s["required"] == ["name", "o", "tags", "u"] and s["properties"]["u"]["format"] == "iri" and s["properties"]["o"]["properties"]["x"]["maximum"] == 14.5
    assert s["properties"]["tags"]["items"] == {"$ref": "#/$defs/Tag"} and s["properties"]["z"]["type"] == "null"


def test_induction_fragments():
    assert induce.type_fragment({"string": 1, "null": 2}) == {"type": ["string", "null"]}
    assert induce.type_fragment({"string": 1, "integer": 2, "null": 1}) == {"oneOf": [{"type": "integer"}, {"type": "string"}, {"type": "null"}]}
    assert induce.looks_like_dictionary([str(i) for i in range(10)]) and not induce.looks_like_dictionary(["name"])
    assert induce.singular("tags") == "tag" and induce.pascal("spell_list") == "SpellList"


def test_refinement_clauses_and_warnings():
    draft = {"properties": {"a": {"type": "string", "examples": ["y", "x"]}, "b": {"enum": ["q"]}, "c": {}}, "required": ["a", "c"]}
    spec = {"drop": ["/c", "/nope"], "rename": {"/a": "name"}, "closedEnum": ["name"], "openVocabulary": ["b"], "promoteIri": ["/b"], "range": {"b": "Thing"}, "parents": ["Base"], "inverseOf": {"b": "d"}}
    final, warnings = refine.refine(draft, spec)
    assert [w.code for w in warnings] == ["DROP_UNRESOLVED"] and final["required"] == ["name"]
    assert final["properties"]["name"]["enum"] == ["x", "y"] and "enum" not in final["properties"]["b"] and final["allOf"] == [{"$ref": "Base"}]
    assert draft["properties"]["c"] == {} and refine.refine(draft, None)[0] == draft
    with pytest.raises(ValueError):
        refine.refine(draft, {"explode": []})


def test_ontology():
    o = Ontology({"Thing": {"properties": {"id": {"type": "string"}}}, "Spell": {"allOf": [{"$ref": "Thing"}], "properties": {"level": {"type": "integer"}, "rel": {"$ref": "#/$defs/R"}}, "$defs": {"R": {"properties": {"x": {"type": "string"}}}}, "required": ["level"]}, "Loop": {"allOf": [{"$ref": "Loop"}, {"$ref": "Spell"}]}}, "urn:v#")
    assert o.ancestors("Loop") == ["Spell", "Thing"] and set(o.denormalized("Spell")["properties"]) == {"id", "level", "rel"}
    assert o.properties("Spell")["rel"]["kind"] == "object"
    assert any(q[2].endswith("subClassOf") for q in o.tbox()) and any(q[2].endswith("minCount") for q in o.tbox())
    assert relaxed({"type": "object", "required": ["a"], "properties": {"a": {"type": "string", "enum": ["x"]}}}) == {"type": "object", "properties": {"a": {}}}


ROWS = [
    ("iri", "urn:a", "urn:p", "literal", 'q"\\\n\t\rü', XS + "string", None, None), ("iri", "urn:a", "urn:p", "literal", "x", rdf.LANG_STRING, "en-GB", "urn:g"), ("blank", "b1", "urn:p", "blank", "b2", None, None, None),
    ("iri", "urn:a", "urn:p", "literal", "5", XS + "integer", None, None), ("iri", "urn:a", rdf.RDF_TYPE, "iri", "urn:C", None, None, "urn:g"),
]


def test_nquads_round_trip(spark, tmp_path):
    q = quads_of(spark, ROWS)
    sinks.write_quads(q, str(tmp_path / "q"), "nquads")
    assert sorted(map(str, rdf.read_nquads(spark, str(tmp_path / "q")).collect())) == sorted(map(str, q.collect()))
    bad = rdf.parse_nquads(spark.createDataFrame([("no",), ("<a> <b> .",), ('<a> <b> "c"d" .',), ("# comment",), ("",)], "value string"))
    assert bad.where("error IS NOT NULL").count() == 3 and bad.count() == 3


@pytest.mark.parametrize("fmt", ["turtle", "trig", "jsonld"])
def test_document_round_trip(spark, tmp_path, fmt):
    rows = [r for r in ROWS if r[0] != "blank"]
    rows = [r[:7] + ((None,) if fmt == "turtle" else (r[7],)) for r in rows]
    q = quads_of(spark, rows)
    sinks.write_quads(q, str(tmp_path / "d"), fmt, {"x": "urn:"})
    found = set()
    for f in (tmp_path / "d").glob("part-*"):
        for doc in (f.read_text().splitlines() if fmt == "jsonld" else [f.read_text()]):
            if doc:
                found |= set(rdf.parse_document(doc, fmt))
    assert found == set(rows)


def test_formats_without_graphs_refuse_them(spark, tmp_path):
    for fmt in ("ntriples", "turtle"):
        with pytest.raises(Exception, match="no named graphs"):
            sinks.write_quads(quads_of(spark, ROWS[1:2]), str(tmp_path / fmt), fmt)
    with pytest.raises(rdf.FormatError):
        rdf.resolve_format("x.csv")
    assert rdf.resolve_format("x.ttl", "nquads") == "nquads" and rdf.resolve_format("a.TTL") == "turtle"


def test_turtle_parser():
    q, prefixes = rdf.parse_turtle('@prefix e: <http://e/> .\n@base <http://b/> .\ne:a a e:C ; e:p "x"@en, 5, 2.5, 1e3, true, """long\n"q" """ ; e:q [ e:r (1 2) ] .\nGRAPH <g> { e:s e:p e:o . _:x e:p <rel> }')
    assert prefixes == {"e": "http://e/"} and len(q) == 15
    assert ("iri", "http://e/a", "http://e/p", "literal", "2.5", XS + "decimal", None, None) in q and q[-1][4] == "http://b/rel" and q[-1][7] == "http://b/g"
    assert rdf.syntax_errors("<a> <b> .", "turtle")[0]["line"] == 1 and rdf.syntax_errors("<a> <b> <c> .", "turtle") == [] and rdf.syntax_errors("{", "jsonld")


def test_canonical_form_ignores_labels_and_order():
    a = [("blank", "x", "urn:p", "blank", "y", None, None, None), ("blank", "y", "urn:p", "blank", "x", None, None, None), ("blank", "x", "urn:q", "literal", "1", None, None, None)]
    b = [tuple({"x": "n2", "y": "n1"}.get(v, v) for v in q) for q in reversed(a)]
    assert canonical.canonical(a) == canonical.canonical(b)
    assert canonical.canonical(a) != canonical.canonical([*a[:2], ("blank", "x", "urn:q", "literal", "2", None, None, None)])


def test_reports_config_and_catalog(tmp_path):
    r = sinks.OutputReport("p", "nquads", 1, 1, 5, errors=["e"])
    assert sinks.OutputReport.from_json(r.to_json()) == r
    with pytest.raises(ValueError):
        sinks.OutputReport.from_json('{"path": 1}')
    for bad in ({"mode": "stream", "canonicalize": True, "path": "a.nq"}, {"bucketing": {}, "graph": "g", "path": "a.nq"}, {"catalog": {}, "path": "a.nq"}, {"jsonldContext": "auto", "path": "a.nq"}, {"path": "a.xyz"}, {"what": 1, "path": "a.nq"}):
        with pytest.raises(cfg.ConfigError):
            cfg.check_output(bad)
    assert cfg.check_output({"path": "a.nq"})["mode"] == "dataset" and cfg.sanitize_target("My Target!") == "my-target"
    assert cfg.topological({"a": ["b"], "b": []}) == ["b", "a"] and cfg.topological({"a": ["b"], "b": ["a"]}) == ["a", "b"]
    assert cfg.resolve_prefixes({}, {"i": "https://www.example.org/x", "v": "https://www.example.org/y"}) == {"example": "https://www.example.org/x", "example2": "https://www.example.org/y"}
    assert "urn:a&amp;b" in sinks.catalog_xml({"urn:a&b": "f.nq"}) and cfg.clamp(float("nan"), 1, 2) == 1
    assert sinks.atomic_write(str(tmp_path / "x" / "f.txt"), "ü") == 2


def test_buckets(spark, tmp_path):
    q = quads_of(spark, [("iri", f"urn:{i}", "urn:p", "iri", "urn:o", None, None, g) for i, g in enumerate(["urn:g/a", "urn:g/b", None])])
    told = {r.bucket: (r.slug, r.quads) for r in sinks.write_buckets(q, str(tmp_path / "b")).collect()}
    assert told == {"urn:g/a": ("g-a", 1), "urn:g/b": ("g-b", 1), "__default__": ("default", 1)} and (tmp_path / "b" / "slug=default").exists()
    assert sinks.bucket(q, "per-config-bucket", {"urn:g/a": "x"}, "drop").count() == 1
    with pytest.raises(Exception, match="no bucket"):
        sinks.bucket(q, "per-config-bucket", {"urn:g/a": "x"}, "fail").collect()


def test_shacl_gate(spark, tmp_path):
    q = quads_of(spark, [("iri", "urn:a", rdf.RDF_TYPE, "iri", "urn:C", None, None, None)])
    shape = {"iri": "urn:s", "targetClass": "urn:C", "properties": [{"path": "urn:p", "minCount": 1}]}
    with pytest.raises(shacl.ShaclError) as e:
        shacl.gate(q, [shape], str(tmp_path / "v"))
    assert e.value.report == ["[Violation] urn:a urn:p → minCount 1"] and (tmp_path / "v" / "validation.report").exists()
    shacl.gate(q, [])
    with pytest.raises(ValueError):
        shacl.violations(q, [{"iri": "s", "targetClass": "c", "properties": [{"path": "p", "xone": []}]}])


def test_viz_frames_and_nodes(spark):
    import numpy as np

    data = viz.frame(np.zeros((2, 2)), np.ones((2, 3)), np.array([2.0, 3.0]), np.array([[0, 1]]))
    assert viz.read_frame(data)["edges"].tolist() == [[0, 1]] and viz.colour("A") == viz.colour("A") and viz.colour("A")[0] == "#"
    n = viz.nodes(quads_of(spark, ROWS)).where("id = 'urn:a'").first()
    assert n.class_name == "urn:C" or n.class_name == "C" or n.types == ["urn:C"]


def test_reconcile_last_wins(spark):
    rows = spark.createDataFrame([("https://x.org/a", 1), ("https://x.org/a", 2), ("https://x.org/record/0123abcd", 1), ("https://y/a", 1)], "subject string, seq int")
    assert reconcile.entity_index(rows, "https://x.org", order=["seq"]).count() == 1


def test_skolem_coercion(spark):
    rows = spark.range(1).select(F.parse_json(F.lit('{"a":{"n":"-1.9","b":"1","s":2.5,"z":null},"c":7}')).alias("r"))
    made = project.skolem(F.col("r"), F.lit("urn:s"), "urn:v", {"a": {"fragment": "f", "type": "T", "properties": {"n": "xsd:integer", "b": "xsd:boolean", "s": "xsd:string", "z": "xsd:string"}}, "c": {"fragment": "c", "type": "U", "properties": {"v": "xsd:number"}}, "d": {"fragment": "d", "type": "V"}})
    found = {(q.p, q.o) for q in rows.select(F.explode(made).alias("q")).select("q.*").collect() if q.o_type == "literal"}
    assert found == {("urn:v#n", "-1"), ("urn:v#b", "true"), ("urn:v#s", "2.5"), ("urn:v#v", "7")}


def test_builder_run_provenance_and_errors(spark, capsys):
    from lodestone import errors
    from lodestone.operators.prov import GraphBuilder, StageLog

    q = GraphBuilder("http://e/", {"x": "urn:x:"}).subject("a").graph("x:g").a("x:C").add("x:n", 5).add("x:t", "hi", "en").link("x:l", "b").build()
    assert q[1] == ("iri", "http://e/a", "urn:x:n", "literal", "5", XS + "integer", None, "urn:x:g") and q[3][4] == "http://e/b"
    with pytest.raises(ValueError):
        GraphBuilder().add("x", 1)
    log = StageLog("urn:run")
    log.add("read", "2020-01-01T00:00:00Z", "2020-01-01T00:01:00Z")
    log.add("build", "2020-01-01T00:01:00Z", "2020-01-01T00:02:00Z")
    assert sum(x[2].endswith("wasInformedBy") for x in log.quads()) == 1 and log.table(spark).count() == len(log.quads())
    e = errors.FileOutputError("bad")
    e.__cause__ = ValueError("why")
    assert e.to_json() == {"code": "FILE_OUTPUT", "message": "bad", "metadata": {}, "causes": ["why"]}
    errors.logger("t").warning("w", extra={"context": {"a": 1}})
    assert json.loads(capsys.readouterr().err)["context"] == {"a": 1}
