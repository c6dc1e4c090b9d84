"""Work is dealt over the cores whatever the layout of a table's file; what is looked up or staged is so once; documents are read in bounded parts."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lodestone import catalogue_files
from lodestone.operators import classify, shacl, shapes
from lodestone.sources import rdf, sinks

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def dealt_parts(df):
    """The parts that a table is dealt into before anything is made of its rows (1: it is not)."""
    return min([int(line.split("Repartition ")[1].split(",")[0]) for line in plan_of(df).splitlines() if "Repartition " in line], default=1)


@pytest.mark.parametrize("name", ["page_equipment", "page_monsters", "page_spells", "quads_skolem", "classify_conflict_tie", "classify_conflict_priority", "classify_rules", "schema_verdicts", "field_harvest", "quads_per_class", "wiki_pages"])
def test_a_table_of_one_split_is_dealt_over_the_cores(spark, name):
    assert dealt_parts(__spark_entry__.queries()[name](spark, SMALL)) >= 24


def test_a_cascade_looks_values_up_once_a_record(spark):
    text = plan_of(__spark_entry__.queries()["page_equipment"](spark, SMALL))
    assert text.count("try_variant_get(") < 100 and text.count('$["_type"]') < 10  # 1,400 and 264 when each test looked its value up


def test_rules_of_any_kind_share_what_they_look_up(spark):
    both = [{"path": "/a", "equals": 1}, {"path": "/a", "in": [2, "x"]}, {"path": "/a", "exists": True}, {"not": {"path": "/a~1b", "missing": True}}, {"any": []}, {"all": []}]
    specs = [{"className": f"C{i}", "priority": i % 2, "predicate": p, "reasons": [f"r{i}", "s"]} for i, p in enumerate(both)]
    rows = spark.createDataFrame([('{"a":1}',), ('{"a":"x"}',), ('{"a/b":0}',), ("[]",), (None,)], "j string").select(F.try_parse_json("j").alias("rec"))
    told = [(r.c, r.priority, r.reasons) for r in rows.select(classify.rules(F.col("rec"), specs).alias("p")).select(F.col("p.class_name").alias("c"), "p.priority", "p.reasons").collect()]
    assert [t[0] for t in told] == ["C5", "C1", "C3", "C5", "C5"] and told[1][2] == ["r1", "s", "r2", "s", "r5", "s"] and told[3][2] == ["r5", "s"]
    assert rows.select(classify.rules(F.col("rec"), [{"className": "C", "priority": 1, "predicate": both[4]}]).isNull().alias("n")).first().n


class Taken(Exception):
    """Ends a plan once its function is at hand."""


def reader_of(fmt):
    """The function that parses batches of documents."""
    found = []

    class Texts:
        def mapInPandas(self, function, schema):  # noqa: N802
            found.append(function)
            raise Taken

    with pytest.raises(Taken):
        rdf.documents_quads(Texts(), fmt)
    return found[0]


def frame(*texts):
    import pandas as pd

    return pd.DataFrame({"path": "p", "value": list(texts)})


def test_small_documents_go_on_together():
    parts = list(reader_of("jsonld")([frame(*[json.dumps({"@id": f"urn:{i}", "urn:p": i}) for i in range(25)]), frame("[]")]))
    assert [len(p) for p in parts] == [25] and list(parts[0]["s"]) == [f"urn:{i}" for i in range(25)]


def test_a_large_document_goes_on_in_parts(monkeypatch):
    monkeypatch.setattr(rdf, "QUADS", 10, raising=False)
    text = "".join(f"<urn:{i}> <urn:p> {i} .\n" for i in range(25))
    assert [len(p) for p in reader_of("turtle")([frame(text)])] == [10, 10, 5]
    parts = reader_of("turtle")([frame(text + "<urn:x> <urn:p> .")])
    assert len(next(parts)) == 10  # before the error at the document's end is met
    with pytest.raises(rdf.ParseError):
        list(parts)


def test_turtle_files_are_bounded_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_BLOCKS", 10, raising=False)
    rows = [("iri", f"urn:s{i}", "urn:p", "literal", str(i), rdf.XSD_STRING, None, None) for i in range(25)]
    quads = spark.createDataFrame(rows, ", ".join(f"{t} string" for t in rdf.TERMS)).coalesce(1)
    sinks.write_quads(quads, str(tmp_path / "t"), "turtle", {"e": "urn:"})
    texts = [t for f in (tmp_path / "t").glob("part-*") if (t := f.read_text())]
    assert all(t.count("@prefix") == 1 and t.startswith("@prefix") and len(rdf.parse_turtle(t)[0]) <= 10 for t in texts)
    assert sorted(q for t in texts for q in rdf.parse_turtle(t)[0]) == sorted(rows)
    assert sorted(tuple(r) for r in rdf.read_documents(spark, str(tmp_path / "t"), "turtle").collect()) == sorted(rows)


def test_a_skolem_subject_looks_values_up_once(spark):
    text = plan_of(__spark_entry__.queries()["quads_skolem"](spark, SMALL))
    assert text.count("try_variant_get(") < 20  # 230 when each use looked its value up


def test_the_gate_finds_its_violations_once(spark, tmp_path):
    from pyspark.sql.types import StringType

    seen = spark.sparkContext.accumulator(0)

    def told(s):
        seen.add(1)
        return s

    rows = [("iri", f"urn:a{i}", rdf.RDF_TYPE, "iri", "urn:C", None, None, None) for i in range(10)]
    quads = spark.createDataFrame(rows, ", ".join(f"{t} string" for t in rdf.TERMS)).withColumn("s", F.udf(told, StringType()).asNondeterministic()("s"))
    with pytest.raises(shacl.ShaclError) as e:
        shacl.gate(quads, [{"iri": "urn:s", "targetClass": "urn:C", "properties": [{"path": "urn:p", "minCount": 1}]}], str(tmp_path / "v"))
    assert e.value.count == 10 and len(e.value.report) == 10
    assert seen.value <= 20  # the types and the values, once


def records_of(name, spark, monkeypatch):
    """The records whose shapes a query observes."""
    found = []

    def kept(rows):
        found.append(rows)
        raise Taken

    monkeypatch.setattr(catalogue_files.shapes, "shape_cache", kept)
    with pytest.raises(Taken):
        __spark_entry__.queries()[name](spark, SMALL)
    return found[0]


def test_induction_deals_its_records(spark, monkeypatch):
    assert dealt_parts(records_of("induced_schemas", spark, monkeypatch)) >= 24


def test_nodes_are_unfolded_once_each(spark):
    deep = {"a": {"b": {"c": {"d": [1, {"e": None}]}}}, "": {"x": 1}, "l": [[2], []]}
    rows = spark.createDataFrame([(json.dumps(deep),), ("[3]",), ("4",)], "j string").select(F.lit("C").alias("class_name"), F.parse_json("j").alias("rec"))

    def nodes(v, path, left):
        own = [(k if path == "" else f"{path}.{k}", x) for k, x in v.items()] if isinstance(v, dict) else [(path + "[]", x) for x in v] if isinstance(v, list) else []
        return [y for p, x in own if left for y in [(p, x), *nodes(x, p, left - 1)]]

    for depth in (1, 3, 8):
        flat = shapes.flattened(rows, depth=depth)
        assert sorted(r.path for r in flat.select("path").collect()) == sorted(p for v in (deep, [3], 4) for p, _ in nodes(v, "", depth) if p)
    assert plan_of(flat).count("try_variant_get(") < 30


def test_a_large_graph_goes_on_in_parts(monkeypatch):
    monkeypatch.setattr(rdf, "QUADS", 10, raising=False)
    inside = "".join(f"<urn:{i}> <urn:p> {i} .\n" for i in range(25))
    parts = list(reader_of("trig")([frame(f"<urn:g> {{ {inside} }} <urn:x> <urn:p> 1 . GRAPH <urn:h> {{ {inside} }}")]))
    assert [len(p) for p in parts] == [10, 10, 10, 10, 10, 1]
    assert [list(p["g"]).count("urn:g") for p in parts] == [10, 10, 5, 0, 0, 0] and [p["g"].isna().sum() for p in parts] == [0, 0, 1, 0, 0, 0]
    parts = reader_of("trig")([frame(f"<urn:g> {{ {inside} <urn:x> ")])
    assert len(next(parts)) == 10


def test_refinement_deals_its_records(spark, monkeypatch):
    assert dealt_parts(records_of("refined_schema", spark, monkeypatch)) >= 24
