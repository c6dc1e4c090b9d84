"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, packing.

``run`` applies the stages to the documents of a folder. Every stage reads all that its predecessor kept and
decides by its own input: toxic documents go, one document of each near-duplicate group stays, documents
with a benchmark passage go, secrets are replaced in the text, and what is left is packed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontam, packing, secrets, simhash, toxicity
from lodestone.llm.common import remove_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; learnt from the table of labels on these documents."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays."""
    return simhash.one_of_each(docs, shingle=5, radius=16, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text, and n_chars follows; every document stays."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in bins of 16 KiB."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_bins),
]
#: SQL cannot express the trained scores and the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written as Parquet and read again.

    A stage's files go once its successor is written, so that two stages at most are kept.
    """
    docs, at = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return docs
