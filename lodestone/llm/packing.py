"""Conflict-constrained best-fit packing.

Documents become pieces of at most one bin's capacity, and pieces are packed into bins. Bins are kept
ordered by residual capacity; a piece goes to the tightest bin that holds it without a conflict, found by
walking the successors of its size until one is compatible. A bin carries bitmaps: one bit for each
duplicate cluster it has (two copies never share a bin), and for each source one bit in each of
``per_source`` layers (a bin holds at most that many pieces of a source).

Packing is sequential, so pieces are dealt at random (by hash) into groups of about GROUP_ROWS pieces, each packed by
itself: a hot source or cluster is spread evenly over the groups, and each group's last bins are the
only loss. Only keys and lengths are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

CAPACITY = 16_384
PER_SOURCE = 4
GROUP_ROWS = 4_000
PACKED = "doc_id long, piece int, start long, length long, bin string, slot int, residual long"


class Bitmaps:
    """Numbers the sources and clusters of a group, so that sets of them are bits of an integer."""

    def __init__(self):
        self.bits: dict = {}

    def bit(self, value) -> int:  # noqa: ANN001
        return 1 << self.bits.setdefault(value, len(self.bits))


def best_fit(pieces: list[tuple[int, int, int]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, residual after) for each (length, source, cluster), placed in the order given.

    Tight bins first: the walk starts at the smallest residual that holds the piece and goes on until
    neither bitmap objects; if none is left, a bin is opened. Bins that are full are dropped from the order.
    """
    sources, clusters = Bitmaps(), Bitmaps()
    order: list[tuple[int, int]] = []
    layers: list[list[int]] = []
    copies: list[int] = []
    placed = []
    for length, source, cluster in pieces:
        s, c = sources.bit(source), clusters.bit(cluster)
        at = bisect_left(order, (length, -1))
        while at < len(order) and (copies[order[at][1]] & c or layers[order[at][1]][-1] & s):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
        else:
            residual, b = capacity, len(copies)
            layers.append([0] * per_source)
            copies.append(0)
        for k in range(per_source):
            if not layers[b][k] & s:
                layers[b][k] |= s
                break
        copies[b] |= c
        placed.append((b, residual - length))
        if residual > length:
            insort(order, (residual - length, b))
    return placed


def _pack_group(rows: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Packs one group, long pieces first."""
    rows = rows.sort_values(["length", "h", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    placed = best_fit(list(zip(rows["length"].tolist(), rows["source"].tolist(), rows["cluster"].tolist())), capacity, per_source)
    rows["b"] = [b for b, _ in placed]
    rows["residual"] = capacity - rows.groupby("b")["length"].transform("sum")
    rows["slot"] = rows.groupby("b").cumcount().astype("int32")
    rows["bin"] = [f"{g}-{b}" for g, b in zip(rows["grp"], rows["b"])]
    return rows[["doc_id", "piece", "start", "length", "bin", "slot", "residual"]]


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, key: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length (UTF-8 bytes), bin, slot, residual (of the bin).

    A document's UTF-8 bytes plus one separator are cut into pieces of ``capacity``; only the last may be
    shorter, so the pieces of a document cover it whole. ``cluster`` names a column of duplicate clusters;
    without it, equal texts are a cluster. Pieces of one document are no copies of each other, but their
    bins obey the source rule. Nulls: a null text has length 1 (the separator), a null source is a source
    of its own, a null cluster is a cluster of its own document. Repeated rows are packed each; very long texts
    are cut into as many pieces as they need; pieces of equal length are placed in the order of a hash, then of
    doc_id and piece. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    whole = whole_text(text)
    by_cluster = F.xxhash64(F.lit("t"), whole) if cluster is None else F.coalesce(F.xxhash64(F.lit("c"), F.when(F.col(cluster).isNotNull(), F.col(cluster).cast("string"))), F.lit(0))
    if cluster is not None:
        by_cluster = F.when(F.col(cluster).isNull(), F.xxhash64(F.lit("d"), key)).otherwise(by_cluster)
    n = docs.agg(F.sum(F.ceil((F.octet_length(whole) + 1) / capacity))).first()[0] or 0
    groups = max(1, int(n) // GROUP_ROWS)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.xxhash64(F.coalesce(F.col(source).cast("string"), F.lit("\u0000null"))).alias("source"),
        by_cluster.alias("cluster0"),
        F.xxhash64(F.lit("pack"), key, F.octet_length(whole)).alias("h0"),
    )
    pieces = rows.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(capacity).cast("long"))).alias("piece", "start"))
    pieces = pieces.select(
        "doc_id", "piece", "start", "source",
        F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")).alias("length"),
        F.xxhash64("cluster0", "piece").alias("cluster"),
        F.xxhash64("h0", "piece").alias("h"),
    ).withColumn("grp", F.pmod("h", F.lit(groups)))
    return pieces.groupBy("grp").applyInPandas(lambda g: _pack_group(g, capacity, per_source), PACKED)
