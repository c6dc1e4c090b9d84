"""Shape observation: what properties records of a class have, as a two-phase aggregation.

Records are flattened to (class, path, kind, value) rows (at most DEPTH levels), and grouped by class and path. Paths are joined by dots, array elements stand under ``[]``.
Counts and ranges are map-side combined; distinct strings are made distinct before they are counted,
and only properties with fewer than OVERFLOW of them are gathered, so no group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.plan import cut, settled
from lodestone.functions.pointer import is_integer, kind

DEPTH = 8
OVERFLOW = 256
KINDS = ("string", "integer", "number", "boolean", "null", "object", "array")


def flattened(records: DataFrame, class_name: str = "class_name", rec: str = "rec", depth: int = DEPTH) -> DataFrame:
    """(class_name, path, kind, text, number): a row for every property occurrence and array element.

    The nodes of a record are unfolded inside one array column, each once, and exploded once, so the depth
    costs no passes.
    """
    level = records.select(F.col(class_name).alias("class_name"), settled(_nodes(F.col(rec), F.lit(""), depth)).alias("nodes"))
    told = level.select("class_name", F.explode("nodes").alias("n")).where("n.path <> ''").select("class_name", F.col("n.path").alias("path"), F.col("n.v").alias("v"))
    told = told.withColumn("k0", kind(F.col("v")))
    whole = F.when((F.col("k0") == "number") & is_integer(F.col("v")), F.lit("integer")).otherwise(F.col("k0"))
    return told.select(
        "class_name", "path", whole.alias("kind"),
        F.when(F.col("k0") == "string", F.try_variant_get("v", "$", "string")).alias("text"),
        F.when(F.col("k0") == "number", F.try_variant_get("v", "$", "double")).alias("number"),
    )


def _nodes(v: Column, path: Column, depth: int) -> Column:
    """array<struct<path, v>>: the properties or elements of a value, each followed by its own down to ``depth`` levels."""
    properties = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    named = F.transform(properties, lambda e: F.struct(F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])).alias("path"), e["value"].alias("v")))
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.struct(F.concat(path, F.lit("[]")).alias("path"), x.alias("v")))
    own = F.coalesce(named, items, F.array().cast("array<struct<path:string,v:variant>>"))
    return own if depth <= 1 else F.flatten(F.transform(own, lambda n: F.concat(F.array(n), _nodes(n["v"], n["path"], depth - 1))))


def observed(flat: DataFrame) -> DataFrame:
    """By (class_name, path): presence, one count a kind, url_count, min, max, n_distinct, overflow, texts."""
    # What is distinct is staged: the three aggregations below need other columns of it each, so that a plan would unfold the records for each.
    pre = cut(flat.groupBy("class_name", "path", "kind", "text").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("low"), F.max("number").alias("high")))
    counts = pre.groupBy("class_name", "path").agg(
        F.sum("n").alias("presence"),
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n_{k}") for k in KINDS],
        F.sum(F.when(F.col("text").rlike("^https?://"), F.col("n")).otherwise(0)).alias("url_count0"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.count("text").alias("n0"),
    )
    small = counts.where((F.col("n0") > 0) & (F.col("n0") < OVERFLOW)).select("class_name", "path")
    texts = pre.where("text IS NOT NULL").join(small, ["class_name", "path"]).groupBy("class_name", "path").agg(F.array_sort(F.collect_list("text")).alias("texts"))
    out = counts.join(texts, ["class_name", "path"], "left")
    n = F.coalesce("n0", F.lit(0)).cast("long")
    return out.withColumns({"url_count": F.coalesce("url_count0", F.lit(0)), "n_distinct": F.least(n, F.lit(OVERFLOW).cast("long")), "overflow": n >= OVERFLOW}).drop("n0", "url_count0")


def record_counts(records: DataFrame, class_name: str = "class_name") -> DataFrame:
    """(class_name, record_count)."""
    return records.groupBy(F.col(class_name).alias("class_name")).agg(F.count(F.lit(1)).alias("record_count"))


def shape_cache(records: DataFrame, class_name: str = "class_name", rec: str = "rec") -> DataFrame:
    """The observation of every class: ``observed`` with record_count."""
    return observed(flattened(records, class_name, rec)).join(record_counts(records, class_name), "class_name")


def verdicts(shapes: DataFrame, most: int = 16, urls: float = 0.9) -> DataFrame:
    """What induction decides by path: required, closed_enum, iri, open_vocabulary."""
    only_text = (F.col("n_string") > 0) & (F.col("n_string") + F.col("n_null") == F.col("presence"))
    return shapes.withColumns({
        "required": F.col("presence") == F.col("record_count"),
        "closed_enum": only_text & ~F.col("overflow") & (F.col("n_distinct") <= most) & ~(F.col("url_count") > urls * F.col("record_count")),
        "iri": F.col("url_count") > urls * F.col("record_count"),
        "open_vocabulary": F.col("overflow"),
    })
