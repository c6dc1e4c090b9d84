"""Graph export: property-graph nodes and edges, degrees, dense indexes, tiles and binary frames."""

from __future__ import annotations

import gzip
import json
import math
import struct
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.iri import PREFIXES, RDF_TYPE, compact_iri, implicit_label, local_name
from lodestone.functions.plan import cut
from lodestone.operators.project import TERMS
from lodestone.sources.rdf import parse_jsonld

MAGIC = 0x53514247
LABELS = [PREFIXES["rdfs"] + "label", PREFIXES["skos"] + "prefLabel", PREFIXES["schema"] + "name", PREFIXES["dct"] + "title"]


def edges(quads: DataFrame) -> DataFrame:
    """(src, dst, predicate) of IRI objects other than types, each once."""
    own = quads.where((F.col("o_type") != "literal") & (F.col("p") != RDF_TYPE))
    return own.select(F.col("s").alias("src"), F.col("o").alias("dst"), F.col("p").alias("predicate")).distinct()


def nodes(quads: DataFrame, core: str | None = None) -> DataFrame:
    """(id, types, graph, label, class_name): one row a subject.

    ``class_name``: the type whose local name is the graph's, else the first type outside the namespace
    ``core``, else the first (types in order). The label is that of the best labelling predicate, else the
    local name.
    """
    is_type = (F.col("p") == RDF_TYPE) & (F.col("o_type") != "literal")
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(LABELS))):
        rank = F.when((F.col("p") == p) & (F.col("o_type") == "literal"), F.lit(i)).otherwise(rank)
    found = quads.groupBy(F.col("s").alias("id")).agg(
        F.array_sort(F.collect_set(F.when(is_type, F.col("o")))).alias("types"),
        F.min("g").alias("graph"),
        F.min_by("o", F.when(rank.isNotNull(), F.struct(rank, F.col("o")))).alias("told"),
    )
    own = F.filter("types", lambda t: local_name(t) == local_name(F.col("graph")))
    outer = F.filter("types", lambda t: ~t.startswith(core)) if core else F.col("types")
    first = F.coalesce(F.try_element_at(own, F.lit(1)), F.try_element_at(outer, F.lit(1)), F.try_element_at("types", F.lit(1)))
    return found.select("id", "types", "graph", F.coalesce("told", local_name(F.col("id"))).alias("label"), local_name(first).alias("class_name"))


# Local names of labelling predicates, best first, and of upper classes.
NAME_LOCALS = ("name", "title", "label", "heading", "text")
CORE_LOCALS = ("thing", "namedthing", "contententry")


def property_graph(quads: DataFrame, prefixes: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and graphs of quads, each in order.

    Nodes (id, label, class_iri, class_label, graph, properties): one a subject or object resource. The label
    is the value of the labelling predicate of best local name, else comes from the IRI; the class is the type
    named as the graph, else the first that is no upper class, else the first; properties map compact
    predicates to their texts. Edges (id, source, target, label, graph), graphs (id, label).
    """
    term = lambda kind, v: F.when(F.col(kind) == "blank", F.concat(F.lit("_:"), F.col(v))).otherwise(F.col(v))
    own = quads.select("*", term("s_type", "s").alias("_s"), term("o_type", "o").alias("_o"))
    is_type, literal = (F.col("p") == RDF_TYPE) & (F.col("o_type") == "iri"), F.col("o_type") == "literal"
    links = own.where(~literal & ~is_type).select(
        F.concat("_s", F.lit("--"), "p", F.lit("->>"), "_o").alias("id"), F.col("_s").alias("source"), F.col("_o").alias("target"), compact_iri(F.col("p"), prefixes).alias("label"), F.col("g").alias("graph"),
    ).distinct()
    name = F.lower(local_name(F.col("p")))
    rank = F.array_position(F.array(*[F.lit(n) for n in NAME_LOCALS]), name)
    # Literals are put together by predicate first, then by subject.
    texts = own.where(literal).groupBy("_s", compact_iri(F.col("p"), prefixes).alias("k")).agg(F.array_sort(F.collect_set("o")).alias("v"), F.min("g").alias("g"), F.min(F.when(rank > 0, F.struct(rank.alias("rank"), F.col("o")))).alias("told"))
    by_text = texts.groupBy("_s").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("properties"), F.min("told").alias("told"), F.min("g").alias("g"))
    rest = own.where(~literal).groupBy("_s").agg(F.array_sort(F.collect_set(F.when(is_type, F.col("o")))).alias("types"), F.min("g").alias("g"))
    subjects = by_text.select("_s", "properties", "told", "g", F.lit(None).cast("array<string>").alias("types")).unionByName(rest, allowMissingColumns=True)
    subjects = subjects.groupBy("_s").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("properties", "told", "types")], F.min("g").alias("g"))
    implicit = links.groupBy(F.col("target").alias("_s")).agg(F.min("graph").alias("g")).join(subjects.select("_s"), "_s", "left_anti")
    every = subjects.unionByName(implicit, allowMissingColumns=True).withColumn("types", F.coalesce("types", F.array().cast("array<string>")))
    first = lambda xs: F.try_element_at(xs, F.lit(1))
    same = F.filter("types", lambda t: F.lower(local_name(t)) == F.lower(local_name(F.col("g"))))
    outer = F.filter("types", lambda t: ~F.lower(local_name(t)).isin(*CORE_LOCALS))
    class_iri = F.coalesce(first(same), first(outer), first(F.col("types")))
    nodes_ = every.select(
        F.col("_s").alias("id"), F.coalesce("told.o", implicit_label(F.col("_s"), prefixes)).alias("label"), class_iri.alias("class_iri"), compact_iri(class_iri, prefixes).alias("class_label"), F.col("g").alias("graph"),
        F.coalesce("properties", F.create_map().cast("map<string,array<string>>")).alias("properties"),
    )
    graphs = quads.where("g IS NOT NULL").select(F.col("g").alias("id")).distinct().select("id", compact_iri(F.col("id"), prefixes).alias("label"))
    return nodes_.orderBy("id"), links.orderBy("source", "label", "target"), graphs.orderBy("id")


def jsonld_graph(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The property graph of a JSON-LD document, expanded or compacted; its context's prefixes make the compact names."""
    doc = json.loads(text)
    context = doc.get("@context", {}) if isinstance(doc, dict) else {}
    merged: dict = {}
    for part in context if isinstance(context, list) else [context]:
        merged |= part if isinstance(part, dict) else {}
    prefixes = {k: v for k, v in merged.items() if isinstance(v, str) and not k.startswith("@") and v[-1:] in "/#:"}
    quads = spark.createDataFrame(parse_jsonld(text), ", ".join(f"{t} string" for t in TERMS))
    return property_graph(quads, prefixes)


def degrees(links: DataFrame) -> DataFrame:
    """(id, degree): undirected, an edge counting at both ends."""
    both = links.select(F.explode(F.array("src", "dst")).alias("id"))
    return both.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def dense_index(nodes_: DataFrame, bucket: str = "graph", key: str = "id") -> DataFrame:
    """``nodes_`` with index: gapless from 0 over buckets by size and name, nodes by key.

    The nodes are sorted over all tasks by ranges; a node's index is its place in its range plus the nodes of
    the ranges before, of which there are as many as tasks. No bucket meets in one task.
    """
    own = nodes_.withColumn("_b", F.coalesce(F.col(bucket), F.lit("__default__")))
    sizes = own.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    ordered = own.join(sizes, "_b").orderBy("_n", "_b", key)
    placed = cut(ordered.select(*nodes_.columns, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")))
    counts = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a task
    before, offsets = 0, []
    for r in sorted(counts):
        offsets.append((r, before))
        before += counts[r]
    told = placed.sparkSession.createDataFrame(offsets, "_range int, _offset long")
    return placed.join(F.broadcast(told), "_range").withColumn("index", F.col("_offset") + F.col("_place")).drop("_range", "_place", "_offset")


def seeded_random(seed: str) -> float:
    """A fixed number between -1 and 1 of a text (its 32-bit FNV-1a hash)."""
    h = 2166136261
    for unit in seed.encode("utf-16-le")[::2] if seed.isascii() else np.frombuffer(seed.encode("utf-16-le"), "<u2").tolist():
        h = ((h ^ unit) * 16777619) & 0xFFFFFFFF
    return (h % 20000 - 10000) / 10000


def seeded_random_column(seed: Column) -> Column:
    """``seeded_random`` of each text, for texts of the basic plane."""
    step = lambda h, c: (h.bitwiseXOR(F.ascii(c).cast("long")) * F.lit(16777619)) % F.lit(1 << 32)
    h = F.aggregate(F.filter(F.split(seed, ""), lambda c: c != ""), F.lit(2166136261).cast("long"), step)
    return (h % 20000 - 10000) / F.lit(10000.0)


def node_size(degree: Column) -> Column:
    """Between 2 and 20, a third of the degree."""
    return F.greatest(F.lit(2.0), F.least(F.lit(20.0), degree / 3))


def colour(name: str) -> str:
    """A fixed colour of a class name: the name's hash picks the hue."""
    h = 5381
    for ch in name:
        h = (h * 33 + ord(ch)) & 0xFFFFFFFF
    hue, s, light = h % 360, 0.55, 0.5
    a = s * min(light, 1 - light)
    part = lambda n: light - a * max(-1, min((n + hue / 30) % 12 - 3, 9 - (n + hue / 30) % 12, 1))
    return "#" + "".join(f"{round(255 * part(n)):02x}" for n in (0, 8, 4))


def layout(nodes_: DataFrame, links: DataFrame, bucket: str = "graph", size: float = 1200.0, rounds: int = 30) -> DataFrame:
    """(bucket, id, x, y): a force layout of each bucket, from fixed starting places, within ``size``.

    A bucket is one picture and is laid out by one task; split buckets before they outgrow a picture.
    """
    tagged = nodes_.select(F.coalesce(bucket, F.lit("__default__")).alias("bucket"), "id")
    inside = links.join(tagged.select(F.col("id").alias("src"), F.col("bucket").alias("in_bucket")), "src").select("in_bucket", "src", "dst")

    def place(own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(set(own["id"]))
        n = len(ids)
        if not n:
            return pd.DataFrame({"bucket": [], "id": [], "x": [], "y": []})
        at = {v: i for i, v in enumerate(ids)}
        angle = np.arange(n) * math.pi * (3 - math.sqrt(5))
        xy = np.stack([np.cos(angle), np.sin(angle)], 1) * np.sqrt(np.arange(n) + 0.5)[:, None]
        pairs = np.array([(at[a], at[b]) for a, b in zip(near["src"], near["dst"]) if a in at and b in at and a != b], int).reshape(-1, 2)
        for step in range(rounds):
            pull = np.zeros_like(xy)
            if len(pairs):
                d = xy[pairs[:, 1]] - xy[pairs[:, 0]]
                np.add.at(pull, pairs[:, 0], d * 0.05)
                np.add.at(pull, pairs[:, 1], -d * 0.05)
            away = xy - xy.mean(axis=0)
            push = away / (np.linalg.norm(away, axis=1, keepdims=True) + 1) * 0.1
            xy = xy + (pull + push) * (1 - step / rounds)
        low, span = xy.min(axis=0), max(float(np.ptp(xy, axis=0).max()), 1e-9)
        xy = (xy - low) / span * size if n > 1 else np.full((1, 2), size / 2)
        return pd.DataFrame({"bucket": own["bucket"].iloc[0], "id": ids, "x": xy[:, 0], "y": xy[:, 1]})

    return tagged.groupBy("bucket").cogroup(inside.groupBy("in_bucket")).applyInPandas(place, "bucket string, id string, x double, y double")


def frame(positions: np.ndarray, colours: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> bytes:
    """A binary frame: magic, version, node and edge counts, then f32 positions, colours, sizes and u32 edges."""
    head = struct.pack("<IIII", MAGIC, 1, len(sizes), len(pairs))
    return head + positions.astype("<f4").tobytes() + colours.astype("<f4").tobytes() + sizes.astype("<f4").tobytes() + pairs.astype("<u4").tobytes()


def read_frame(data: bytes) -> dict:
    """The parts of a binary frame; colours have three or four numbers, by the frame's length."""
    magic, version, n, m = struct.unpack_from("<IIII", data)
    if magic != MAGIC:
        raise ValueError("no graph frame")
    width = 0 if not n else (len(data) - 16 - 8 * m) // (4 * n) - 3
    f = np.frombuffer(data, "<f4", (3 + width) * n, 16)
    return {"version": version, "positions": f[: 2 * n].reshape(n, 2), "colours": f[2 * n : (2 + width) * n].reshape(n, width), "sizes": f[(2 + width) * n :], "edges": np.frombuffer(data, "<u4", 2 * m, 16 + 4 * (3 + width) * n).reshape(m, 2)}


# Files.

# Names of what the files hold, and properties that the data shards leave out.
MANIFEST_FORMAT, META_FORMAT, DATA_FORMAT = "graph-frames-v1", "node-meta-v2", "node-data-v1"
NOISY = frozenset("bodyHtml body_html bodyText body_text altEditionUrl alt_edition_url metaDescription meta_description metaKeywords meta_keywords".split())
#: Nodes under a common beginning from which it becomes a prefix of the node names.
PREFIX_NODES = 10


def placed_graph(nodes_: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with bucket, index, x, y, size and colour, and edges with the indexes of their ends; what is exported."""
    own = nodes_.withColumn("bucket", F.coalesce("graph", F.lit("__default__")))
    plain = links.select(F.col("source").alias("src"), F.col("target").alias("dst"))
    size = node_size(F.coalesce(F.col("degree"), F.lit(0)))
    xy = layout(own, plain).select("id", "x", "y")
    done = dense_index(own).join(degrees(plain), "id", "left").join(xy, "id").withColumns({"size": size, "degree": F.coalesce("degree", F.lit(0))})
    done = cut(done)
    ends = done.select("id", "index")
    edges_ = links.join(ends.select(F.col("id").alias("source"), F.col("index").alias("src")), "source").join(ends.select(F.col("id").alias("target"), F.col("index").alias("dst")), "target")
    buckets = done.select(F.col("id").alias("source"), "bucket")
    return done, cut(edges_.join(buckets, "source"))


def export(nodes_: DataFrame, links: DataFrame, path: str) -> dict:
    """Writes a graph as JSON chunks, binary frames, gzipped node names and data shards, a manifest and a page; returns the manifest.

    One bucket (graph) after another, smallest first: a bucket is one picture, and only its own nodes and edges
    are held while its files are written.
    """
    out = Path(path)
    for sub in ("chunks", "frames", "data"):
        (out / sub).mkdir(parents=True, exist_ok=True)
    placed, edges_ = placed_graph(nodes_, links)
    buckets = [r.bucket for r in placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "bucket").collect()]
    frames, chunks, names, labels, total_edges = [], [], [], [], 0
    for number, name in enumerate(buckets):
        own = placed.where(F.col("bucket") == name).orderBy("index").toPandas()
        near = edges_.where(F.col("bucket") == name).orderBy("source", "label", "target").toPandas()
        hexed, slug = colour(name), slug_of(name)
        rgba = np.tile([int(hexed[i : i + 2], 16) / 255 for i in (1, 3, 5)] + [1.0], (len(own), 1))
        pairs = near.loc[near["src"] != near["dst"], ["src", "dst"]].to_numpy(np.int64).reshape(-1, 2)
        file = f"frames/frame-{number:03d}.bin"
        (out / file).write_bytes(frame(own[["x", "y"]].to_numpy(float), rgba, own["size"].to_numpy(float), pairs))
        entry = {"file": file, "label": name, "color": hexed, "nodeCount": len(own), "edgeCount": len(pairs), "nodeBase": int(own["index"].iloc[0])}
        properties = {}
        for index, told in zip(own["index"], own["properties"]):
            kept: dict[str, list[str]] = {}
            for key, values in dict(told or {}).items():
                local = key.replace("#", "/").replace(":", "/").rsplit("/", 1)[-1]
                if local not in NOISY and (values := [v for v in values if v.strip()]):
                    kept.setdefault(local, []).extend(values)
            if kept:
                properties[str(index)] = kept
        if properties:
            entry["dataFile"] = f"data/{slug}.json.gz"
            _gzipped(out / entry["dataFile"], {"format": DATA_FORMAT, "nodeBase": entry["nodeBase"], "props": properties})
        shown = [{"id": r.id, "label": r.label, "classIri": r.class_iri or "", "classLabel": r.class_label or "", "x": r.x, "y": r.y, "color": hexed, "size": r.size, "properties": {k: list(v) for k, v in dict(r.properties or {}).items()}} for r in own.itertuples()]
        joined = [{"id": r.id, "source": r.source, "target": r.target, "label": r.label, "color": "#222222"} for r in near.itertuples()]
        (out / f"chunks/{slug}.json").write_text(json.dumps({"id": name, "label": name, "slug": slug, "color": hexed, "nodes": shown, "edges": joined}), encoding="utf-8")
        chunks.append({"id": name, "label": name, "slug": slug, "file": f"chunks/{slug}.json", "nodeCount": len(own), "edgeCount": len(near), "color": hexed})
        frames.append(entry)
        names += own["id"].tolist()
        labels += own["label"].tolist()
        total_edges += len(pairs)
    _gzipped(out / "meta.json.gz", _meta(names, labels))
    manifest = {"format": MANIFEST_FORMAT, "version": 1, "spaceSize": 1200, "totalNodes": len(names), "totalEdges": total_edges, "frames": frames}
    (out / "manifest.json").write_text(json.dumps(manifest, indent=2), encoding="utf-8")
    (out / "index.json").write_text(json.dumps({"chunks": chunks}, indent=2), encoding="utf-8")
    (out / "index.html").write_text(PAGE, encoding="utf-8")
    return manifest


def slug_of(name: str) -> str:
    """A file name of a bucket, with a hash of the whole name so that no two share one."""
    told = "".join(c if c.isascii() and c.isalnum() else "-" for c in name.lower()).strip("-")[-60:]
    h = 5381
    for ch in name:
        h = (h * 33 + ord(ch)) & 0xFFFFFFFF
    return f"{told}-{h:08x}"


def _meta(names: list[str], labels: list[str]) -> dict:
    """Node names cut at common beginnings (scheme and host, of enough nodes)."""
    start = lambda n: n[: n.find("/", n.find("://") + 3) + 1] or n
    counts: dict[str, int] = {}
    for n in names:
        counts[start(n)] = counts.get(start(n), 0) + 1
    prefixes = sorted((p for p, c in counts.items() if c >= PREFIX_NODES), key=lambda p: (-len(p), p))
    at = {p: i for i, p in enumerate(prefixes)}
    found = [at.get(start(n), -1) for n in names]
    return {"format": META_FORMAT, "prefixes": prefixes, "pIdx": found, "locals": [n if i < 0 else n[len(prefixes[i]) :] for n, i in zip(names, found)], "labels": labels}


def _gzipped(path: Path, value: dict) -> None:
    path.write_bytes(gzip.compress(json.dumps(value).encode(), 9, mtime=0))


#: A page that draws the frames of a manifest beside it.
PAGE = """<!DOCTYPE html>
<html><head><meta charset="utf-8"><title>Graph</title><style>body{margin:0;font:14px sans-serif}#legend{position:fixed;top:8px;left:8px;background:#fffc;padding:4px}</style></head>
<body><div id="legend"></div><canvas id="c"></canvas><script>
(async () => {
  const manifest = await (await fetch('manifest.json')).json(), canvas = document.getElementById('c'), g = canvas.getContext('2d');
  canvas.width = innerWidth; canvas.height = innerHeight;
  const scale = Math.min(canvas.width, canvas.height) / manifest.spaceSize, places = new Float32Array(2 * manifest.totalNodes), links = [];
  for (const f of manifest.frames) {
    const data = await (await fetch(f.file)).arrayBuffer(), n = f.nodeCount;
    places.set(new Float32Array(data, 16, 2 * n), 2 * f.nodeBase);
    links.push(new Uint32Array(data, 16 + 28 * n, 2 * f.edgeCount));
    document.getElementById('legend').insertAdjacentHTML('beforeend', `<div style="color:${f.color}">${f.nodeCount}</div>`);
    document.getElementById('legend').lastChild.append(' ' + f.label);
  }
  g.strokeStyle = '#2222'; g.beginPath();
  for (const e of links) for (let i = 0; i < e.length; i += 2) { g.moveTo(places[2 * e[i]] * scale, places[2 * e[i] + 1] * scale); g.lineTo(places[2 * e[i + 1]] * scale, places[2 * e[i + 1] + 1] * scale); }
  g.stroke();
  for (const f of manifest.frames) { g.fillStyle = f.color; for (let i = f.nodeBase; i < f.nodeBase + f.nodeCount; i++) g.fillRect(places[2 * i] * scale - 1, places[2 * i + 1] * scale - 1, 3, 3); }
})();
</script></body></html>
"""
