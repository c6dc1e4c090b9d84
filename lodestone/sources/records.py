"""Record sources: JSON and JSONL trees, tables, and what is wrong with them.

Records are rows (rid, record_path, record_line, target, rec VARIANT, error_code). The raw line number of a
JSONL file is its records' identity. Bad records keep their row and say why in error_code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions.plan import is_file, settled
from lodestone.functions.pointer import kind, string_at


def record_id(path: Column, line: Column) -> Column:
    """The identity of a record: a hash of where it stands."""
    return F.sha1(F.concat_ws("#", path, line.cast("string")).cast("binary"))


def _finish(rows: DataFrame, target: str) -> DataFrame:
    own_target = string_at(F.col("rec"), "/_source/target")
    code = (
        F.when(F.col("raw").isNull(), F.lit("JSON_READ_FILE_ERROR"))
        .when(F.col("rec").isNull(), F.lit("JSON_READ_PARSE_ERROR"))
        .when(kind(F.col("rec")) != "object", F.lit("JSON_READ_NON_OBJECT"))
        .when(own_target.isNotNull() & (own_target != target), F.lit("JSON_READ_TARGET_MISMATCH"))
    )
    return rows.select(
        record_id(F.col("record_path"), F.col("record_line")).alias("rid"),
        "record_path",
        "record_line",
        F.lit(target).alias("target"),
        F.struct(string_at(F.col("rec"), "/_source/plugin").alias("plugin"), string_at(F.col("rec"), "/_source/schemaId").alias("schema_id")).alias("src"),
        "rec",
        code.alias("error_code"),
    )


def read_json_tree(spark: SparkSession, path: str, target: str, formats: tuple[str, ...] = ("json", "jsonl")) -> DataFrame:
    """Records of all .json (one each) and .jsonl (one per non-blank line) files under ``path``.

    JSON texts are parsed leniently: what fails stays as a row with an error code. A path that is a single
    file is read as well, as JSONL if its name says so, else as one JSON text whatever its name.
    """
    single = is_file(spark, path)
    if single:
        formats = ("jsonl",) if path.lower().endswith(".jsonl") else ("json",)
    parts = []
    if "json" in formats:
        whole = _wholetext(spark, path, None if single else "*.json")
        parts.append(whole.select(F.col("_metadata.file_path").alias("record_path"), F.lit(0).cast("long").alias("record_line"), F.col("value").alias("raw")))
    if "jsonl" in formats:
        parts.append(jsonl_lines(spark, path))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return _finish(rows.withColumn("rec", settled(F.try_parse_json("raw"))), target)


def jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """(record_path, record_line, raw): the non-blank lines of .jsonl files with their numbers in the file.

    Files are split like any text source. A line's number is its place in its split plus the lines of the file's
    splits before; only a row a split is aggregated and joined, never the lines.
    """
    read = spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(path)
    lines = read.select(
        F.col("_metadata.file_path").alias("record_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"), F.regexp_replace("value", "\r$", "").alias("raw"),
    )
    splits = lines.groupBy("record_path", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("record_path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    splits = splits.select("record_path", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = lines.join(splits, ["record_path", "_block"]).select("record_path", (F.col("_before") + F.col("_place") - F.col("_first")).alias("record_line"), "raw")
    return numbered.where(F.trim("raw") != "")


def _wholetext(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    read = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    return (read.option("pathGlobFilter", pattern) if pattern else read).load(path)


def from_texts(texts: DataFrame, target: str, path: str = "record_path", line: str = "record_line", raw: str = "raw") -> DataFrame:
    """Records from JSON texts that already stand in a table."""
    rows = texts.select(F.col(path).alias("record_path"), F.col(line).cast("long").alias("record_line"), F.col(raw).alias("raw"))
    return _finish(rows.withColumn("rec", settled(F.try_parse_json("raw"))), target)


def from_table(df: DataFrame, target: str, key: str, type_name: str | None = None) -> DataFrame:
    """Records of a table: one object per row, with ``_type`` if a type is named; nulls become JSON null.

    The record's path is ``table:<target>/<key>``. Rows become VARIANT objects directly, without JSON
    text; times are kept as text, as JSON has none.
    """
    columns = [F.col(c).cast("string").alias(c) if kind_ in ("date", "timestamp", "timestamp_ntz", "binary") else F.col(c) for c, kind_ in df.dtypes]
    if type_name is not None:
        columns.append(F.lit(type_name).alias("_type"))
    place = F.concat(F.lit(f"table:{target}/"), F.col(key).cast("string"))
    rows = df.select(place.alias("record_path"), F.lit(0).cast("long").alias("record_line"), F.lit("").alias("raw"), F.to_variant_object(F.struct(*columns)).alias("rec"))
    return _finish(rows, target)


def good(records: DataFrame) -> DataFrame:
    """The records that were read."""
    return records.where("error_code IS NULL")


def bad(records: DataFrame) -> DataFrame:
    """The records that were not, for quarantine."""
    return records.where("error_code IS NOT NULL")
