"""Run statistics: outcomes, per-class counts, errors, the latest records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 200
MESSAGES = 50


def outcome(bucket: Column, class_name: Column) -> Column:
    """quarantined with a bucket, else squashed with a class, else error."""
    return F.when(bucket.isNotNull(), F.lit("quarantined")).when(class_name.isNotNull(), F.lit("squashed")).otherwise(F.lit("error"))


def summaries(classified: DataFrame, quad_count: Column, bucket: Column, class_name: Column, error: Column) -> DataFrame:
    """(rid, record_path, record_line, outcome, class_name, quad_count, bucket, error_message)."""
    return classified.select("rid", "record_path", "record_line", outcome(bucket, class_name).alias("outcome"), class_name.alias("class_name"), quad_count.cast("long").alias("quad_count"), bucket.alias("bucket"), error.alias("error_message"))


def fold(summary: DataFrame) -> DataFrame:
    """(outcome, records, quads)."""
    return summary.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("quad_count"), F.lit(0)).cast("long").alias("quads"))


def per_class(summary: DataFrame) -> DataFrame:
    """(class_name, records, quads) of squashed records."""
    return summary.where("outcome = 'squashed'").groupBy("class_name").agg(F.count(F.lit(1)).alias("records"), F.sum("quad_count").alias("quads"))


def errors(summary: DataFrame, most: int = MESSAGES) -> DataFrame:
    """The most frequent error messages with their counts (ties by message)."""
    return summary.where("error_message IS NOT NULL").groupBy("error_message").agg(F.count(F.lit(1)).alias("records")).orderBy(F.col("records").desc(), "error_message").limit(most)


def latest(summary: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The last records by place."""
    return summary.orderBy(F.col("record_path").desc(), F.col("record_line").desc()).limit(most)


def graph_count(quads: DataFrame) -> DataFrame:
    """One row: graphs, the default one included if it has quads."""
    return quads.agg(F.count_distinct(F.coalesce("g", F.lit("__default__"))).alias("graphs"))


def exit_code(summary: DataFrame) -> int:
    """1 if any record failed, else 0."""
    return int(summary.where("outcome <> 'squashed'").limit(1).count() > 0)
