"""Entity resolution: an index of link tails to canonical IRIs, and the collapse of link items.

Everything is an equi-join on the tail or on (rid, IRI); the index is joined by shuffle or, when Spark finds
it small, by broadcast, and never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.plan import cut


def tail_of(iri: Column, base: str) -> Column:
    """What follows the canonical base, NULL for other IRIs, empty tails and hashed record IRIs."""
    root = base if base.endswith("/") else base + "/"
    tail = F.when(iri.startswith(root), iri.substr(F.lit(len(root) + 1), F.length(iri)))
    return F.when((tail != "") & ~tail.rlike("^record/[0-9a-f]{8}$"), tail)


def entity_index(subjects: DataFrame, base: str, iri: str = "subject", order: list[str] | None = None) -> DataFrame:
    """(tail, iri): one row a tail; the last by ``order`` (else the greatest IRI) wins."""
    found = subjects.withColumn("tail", tail_of(F.col(iri), base)).where("tail IS NOT NULL")
    keys = [F.col(c) for c in (order or [])] + [F.col(iri)]
    return found.groupBy("tail").agg(F.max_by(F.col(iri), F.struct(*keys)).alias("iri"))


def href_key(href: Column) -> Column:
    """A link's tail: one leading slash goes."""
    return F.when(href.startswith("/"), href.substr(F.lit(2), F.length(href))).otherwise(href)


def resolve(links: DataFrame, index: DataFrame, href: str = "href") -> DataFrame:
    """``links`` with the canonical IRI of each href, NULL where the index has none."""
    keyed = links.withColumn("_tail", href_key(F.col(href)))
    return keyed.join(index.select(F.col("tail").alias("_tail"), F.col("iri").alias("resolved")), "_tail", "left").drop("_tail")


def collapse_links(quads: DataFrame, index: DataFrame, link_predicates: list[str], href_predicate: str) -> DataFrame:
    """Link items become direct edges to the entities they name.

    Items are the IRI objects of link predicates; their href literal is looked up; resolved link edges point to
    the canonical IRI and all quads about a resolved item go. Unresolved ones stay. The scope is one
    record's quads (by rid).
    """
    is_link = F.col("p").isin(*link_predicates) & (F.col("o_type") == "iri")
    items = quads.where(is_link).select("rid", F.col("o").alias("item")).distinct()
    hrefs = quads.where((F.col("p") == href_predicate) & (F.col("o_type") == "literal")).select("rid", F.col("s").alias("item"), F.col("o").alias("href"))
    found = resolve(items.join(hrefs, ["rid", "item"]), index).where("resolved IS NOT NULL").groupBy("rid", "item").agg(F.min("resolved").alias("resolved"))
    kept = quads.join(found.select("rid", F.col("item").alias("s")), ["rid", "s"], "left_anti")
    edges = kept.join(found.select("rid", F.col("item").alias("o"), "resolved"), ["rid", "o"], "left")
    edges = edges.withColumn("o", F.when(is_link & F.col("resolved").isNotNull(), F.col("resolved")).otherwise(F.col("o")))
    return edges.select(*quads.columns)


def rewrite_graphs(quads: DataFrame, class_graph: DataFrame, type_iri: str, hops: int = 6) -> DataFrame:
    """Quads in the graph of their subject's class, handed along IRI edges for at most ``hops`` hops.

    ``class_graph``: (class_iri, graph). The first assignment wins: the nearest typed subject, and among
    equally near ones the smallest graph. Subjects never reached keep their graph.
    """
    typed = quads.where((F.col("p") == type_iri) & (F.col("o_type") == "iri")).join(class_graph, F.col("o") == F.col("class_iri"))
    assigned = typed.groupBy("s").agg(F.min("graph").alias("graph")).select(F.col("s").alias("node"), "graph")
    edges = quads.where((F.col("o_type") == "iri") & (F.col("p") != type_iri)).select(F.col("s").alias("a"), F.col("o").alias("b")).distinct()
    assigned = cut(assigned)
    edges, frontier = cut(edges), assigned
    for _ in range(hops):
        reached = edges.join(frontier, edges["a"] == frontier["node"]).groupBy(F.col("b").alias("node")).agg(F.min("graph").alias("graph"))
        frontier = cut(reached.join(assigned.select("node"), "node", "left_anti"))
        if frontier.isEmpty():
            break
        assigned = assigned.unionByName(frontier)
    out = quads.join(assigned.withColumnRenamed("graph", "_graph"), quads["s"] == assigned["node"], "left").drop("node")
    return out.withColumn("g", F.coalesce("_graph", "g")).drop("_graph")


def implicit_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (id) and the edge targets (dst) that are missing among them."""
    missing = edges.select(F.col("dst").alias("id")).distinct().join(nodes.select("id"), "id", "left_anti")
    return nodes.unionByName(missing, allowMissingColumns=True)


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    w = W.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
