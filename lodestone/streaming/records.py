"""Streaming variants: the batch transformations over unbounded inputs.

A classified stream deduplicates within a watermark (the batch run's dedup is unbounded; state here is
bounded by the watermark, so a repeat later than that passes), folds outcomes, and appends to a sink by
micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators import classify, project
from lodestone.sources.rdf import documents_quads, nquads_line, parse_nquads
from lodestone.sources.records import from_texts, good


def read_texts(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """(record_path, record_line, raw): new JSONL files of a folder as they arrive, lines with their numbers.

    A file arrives whole, so its lines are numbered as the batch reader numbers them, and records keep the same
    identity in both. Files that are dropped into a stream are small; one is held by one task.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.jsonl").load(path)
    lines = files.select(F.col("_metadata.file_path").alias("record_path"), F.posexplode(F.split("value", "\r?\n")).alias("record_line", "raw"))
    return lines.where(F.trim("raw") != "").withColumn("record_line", F.col("record_line").cast("long"))


def classified_stream(texts: DataFrame, target: str, config: dict) -> DataFrame:
    """Classified records of a stream of JSON texts."""
    return classify.cascade(good(from_texts(texts, target)), config)


def quad_stream(classified: DataFrame, classes: dict[str, dict], base: str, subject: Column, event_time: Column | None = None, delay: str = "10 minutes") -> DataFrame:
    """Quads of a classified stream; with an event time each once within the watermark."""
    projected = project.project(classified, classes, base, subject, F.col("classification.type"))
    if event_time is None:
        return project.exploded(projected)
    timed = projected.withColumn("event_time", event_time).withWatermark("event_time", delay)
    return timed.select("event_time", F.explode("quads").alias("q")).select("event_time", "q.*").dropDuplicatesWithinWatermark(project.TERMS)


def outcome_stream(classified: DataFrame, event_time: Column, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Records by class in windows of event time."""
    timed = classified.withColumn("event_time", event_time).withWatermark("event_time", delay)
    return timed.groupBy(F.window("event_time", window), F.col("classification.type").alias("class_name")).agg(F.count(F.lit(1)).alias("records"))


def write_stream(quads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends N-Quads lines, exactly once by batch folder: a replayed batch overwrites its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.select(nquads_line().alias("value")).write.mode("overwrite").text(f"{path}/batch={number}")

    return quads.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_nquads_stream(spark: SparkSession, path: str) -> DataFrame:
    """Quads of N-Quads files as they arrive."""
    return parse_nquads(spark.readStream.text(path))


def read_documents_stream(spark: SparkSession, path: str, fmt: str, per_trigger: int = 100) -> DataFrame:
    """Quads of Turtle, TriG or JSON-LD files as they arrive, each document by one task."""
    texts = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", per_trigger).load(path)
    return documents_quads(texts.select(F.col("_metadata.file_path").alias("path"), "value"), fmt)
