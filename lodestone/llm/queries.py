"""Queries of the corpus operators: ``op<N>_<name>(spark, sf_dir)``, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html_extract, licenses, media, packing, secrets, sharding, simhash, suffix_dedup, toxicity, twins
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each whole document, learnt from the labels outside the held-out fold."""
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_score", "worst_sentence", "n_offending", "offending")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that an earlier document has."""
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 15 by stratified interleaving; shard sizes in rows differ by one at most."""
    out = sharding.interleaved_shards(table(spark, sf_dir, "documents"), n_shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in each whole document, as phrases and, in n_near_items, within 20 words."""
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), within=2 * decontam.WINDOW)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"),
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into bins of 16 KiB; no two equal texts and at most four pieces of a source in a bin."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the components of those within 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each whole document: base patterns and novel strings in sensitive context."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform(F.filter("spans", lambda s: s["kind"] != "novel"), told)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("spans", told), ",").alias("spans"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's bytes through a progressive JPEG and back, with features of the rendered tensor."""
    stored = media.media_columns(table(spark, sf_dir, "documents"), tensors=False)
    return stored.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in each document's whole text."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators' queries by name."""
    found = (op1_toxicity, op2_suffix_dedup, op3_sharding, op4_decontamination, op5_html_extraction, op6_best_fit_packing, op7_simhash, op8_secret_scan, op9_media_columns, op10_license_scan)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op2_suffix_dedup": twins.suffix_dedup_sql(),
        "op3_sharding": twins.sharding_sql(),
        "op4_decontamination": twins.decontamination_sql(),
        "op7_simhash": twins.simhash_sql(),
        "op10_license_scan": licenses.licenses_sql(),
    }
