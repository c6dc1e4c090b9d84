"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are shuffled by a seeded hash within their stratum, each gets the fractional rank
``(2 r + 1) / (2 n_stratum)``, and the rows sorted by that fraction are cut into equal runs. Any run of
the fractional order holds the strata in proportion, so every shard matches the mixture, and shard
sizes differ by one row at most.

Exact ranks need no task that holds a stratum: rows are dealt by ``(stratum, hash range)``, ranks are
counted inside a range, and the ranges' counts are added up. A stratum with a third of all rows is
thereby spread over all hash ranges. Only keys and sizes are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Hash and fraction ranges at most; their counts are the only thing one task sees whole.
MAX_RANGES = 4096
ROWS_A_RANGE = 128


def interleaved_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17, key: str = "doc_id", stratum: str = "source", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, stratum, global_rank, shard, slot.

    ``size`` is the text's UTF-8 bytes plus 1. Nulls: a null text counts as empty, a null stratum is the
    stratum named by the empty string, a null key hashes as the empty string. Ties and repeated rows keep
    their own places (equal rows are interchangeable). An empty table gives no rows. Columns other than
    the three named ones are ignored, whatever their names. Texts are measured whole.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(whole) + F.lit(1)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), key_text).cast("binary")).alias("h"),
    )
    n = docs.count()
    ranges = max(1, min(MAX_RANGES, n // ROWS_A_RANGE))
    rows = rows.withColumn("hr", F.floor(F.conv(F.substring("h", 1, 6), 16, 10).cast("long") * ranges / F.lit(1 << 24)).cast("int"))

    in_stratum = W.partitionBy("stratum").orderBy("hr")
    counts = (
        rows.groupBy("stratum", "hr").agg(F.count(F.lit(1)).alias("c"))
        .select("stratum", "hr", (F.sum("c").over(in_stratum) - F.col("c")).alias("before"), F.sum("c").over(W.partitionBy("stratum")).alias("n_stratum"))
    )
    in_range = W.partitionBy("stratum", "hr").orderBy("h", "doc_id", "text_crc32", "size")
    ranked = (
        rows.join(counts, ["stratum", "hr"])
        .withColumn("rank", F.col("before") + F.row_number().over(in_range) - 1)
        .withColumn("frac", (2 * F.col("rank") + 1) / (2 * F.col("n_stratum")))
        .withColumn("fr", F.floor((2 * F.col("rank") + 1) * ranges / (2 * F.col("n_stratum"))).cast("int"))
    )
    # At most MAX_RANGES rows meet in this window, whatever the input's size.
    fraction_counts = ranked.groupBy("fr").agg(F.count(F.lit(1)).alias("c")).select("fr", (F.sum("c").over(W.orderBy("fr")) - F.col("c")).alias("fr_before"))
    in_fraction = W.partitionBy("fr").orderBy("frac", "stratum", "h", "doc_id", "text_crc32", "size")
    placed = ranked.join(fraction_counts, "fr").withColumn("global_rank", F.col("fr_before") + F.row_number().over(in_fraction) - 1)
    shard = F.expr(f"(global_rank * {n_shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("global_rank") - first)
        .select("doc_id", "size", "text_crc32", "stratum", "global_rank", "shard", "slot")
    )
