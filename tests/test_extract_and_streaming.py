import json

from pyspark.sql import functions as F

from lodestone.operators import extract
from lodestone.sources import rdf
from lodestone.streaming import records as streaming

PAGE = '<h1 class="title">Fire <i>Drake</i></h1><b>Source</b> <a href="Sources.aspx?ID=2">Book</a><br/><b>Traditions</b> arcane, primal<br/><b>AC</b> 18; <b>Fort</b> +9, <b>Ref</b> +7<br/><b>HP</b> 60; <b>Immunities</b> fire, sleep<hr/>It burns &amp; flies<br>high. <a href="Traits.aspx?ID=9">Fire</a><h2 class="title">Lair</h2>Caves'


def test_page_record(spark):
    row = extract.pages_to_records(spark.createDataFrame([("https://x.org/Monsters.aspx?ID=1", PAGE)], "url string, html string")).first()
    assert row.page_type == "monster" and row.title == "Fire Drake" and row.stats.ac == 18 and row.stats.fort == 9 and row.stats.immunities == ["fire", "sleep"]
    assert row.field_map["HP"] == "60" and "Source" not in row.field_map and row.body_text.startswith("It burns & flies high.")
    assert [(x.kind, x.id) for x in row.links] == [("Sources", 2), ("Traits", 9)]


def test_nested_text():
    assert extract.split_top_level("a, b (c, d), [e, f], ") == ["a", "b (c, d)", "[e, f]"]
    assert extract.sections(PAGE) == [{"heading": "Lair", "level": 2, "text": "Caves"}]
    assert extract.templates("x {{Box|name=A {{tt|b|c}}|2nd|k=[[L|t]]}} y") == [{"name": "Box", "arguments": {"name": "A {{tt|b|c}}", "1": "2nd", "k": "[[L|t]]"}}]
    assert extract.clean_wikitext("'''B''' [[A|a]] {{tt|x|y}} {{n|{{m}}}}<ref>r</ref>") == "B a x"


def test_values(spark):
    row = spark.range(1).select(
        extract.price(F.lit("1,200 gp, 5 sp")).alias("p"), extract.dice(F.lit("2d6+3 fire")).alias("d"), extract.as_int(F.lit("about -4 feet")).alias("i"), extract.unless_dash(F.lit("x"), F.lit("—")).alias("u"),
        extract.modifiers(F.lit("Str +4, Dex -1"), ("Str", "Dex", "Con")).alias("m"), extract.wiki_class(F.lit("Fire (move)"), F.lit("{{MoveInfobox}}"), [{"className": "Move", "title": "\\(move\\)$", "template": "MoveInfobox"}]).alias("c")).first()
    assert row.p == 120050 and row.d.asDict() == {"count": 2, "sides": 6, "bonus": 3, "kind": "fire"} and row.i == -4 and row.u is None and row.m == {"Str": 4, "Dex": -1} and row.c == "Move"


def test_stream_to_quads(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(json.dumps({"t": "A", "n": i}) for i in range(5)) + "\n")
    texts = streaming.read_texts(spark, str(tmp_path / "in"))
    classified = streaming.classified_stream(texts, "t", {"discriminator": {"from": "/t"}})
    quads = streaming.quad_stream(classified, {"A": {"properties": {"n": {}}}}, "urn:v", F.concat(F.lit("urn:"), "rid"))
    query = streaming.write_stream(quads, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert rdf.read_nquads(spark, str(tmp_path / "out" / "batch=0")).count() == 10


def test_stream_dedup_and_windows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = json.dumps({"t": "A", "n": 1, "ts": "2024-01-01T00:00:00Z"})
    (tmp_path / "in" / "a.jsonl").write_text(f"{line}\n{line}\n")
    classified = streaming.classified_stream(streaming.read_texts(spark, str(tmp_path / "in")), "t", {"discriminator": {"from": "/t"}})
    when = F.try_variant_get("rec", "$.ts", "string").cast("timestamp")
    quads = streaming.quad_stream(classified, {"A": {"properties": {"n": {}}}}, "urn:v", F.lit("urn:s"), when)
    q = quads.writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination(60)
    assert spark.table("once").count() == 2
    counts = streaming.outcome_stream(classified, when)
    q = counts.writeStream.format("memory").outputMode("complete").queryName("windows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination(60)
    assert spark.table("windows").first().records == 2
