"""SimHash near-duplicates with vantage-point trees over fingerprints.

Fingerprints are compared once per distinct value. They are partitioned by Hamming distance in two steps.

Two fingerprints within ``radius`` bits differ in at most ``radius // blocks`` bits of one of ``blocks`` bit
blocks. For each block there is a forest of vantage-point trees under the block's own Hamming distance:
every vantage point splits the fingerprints into shells by distance, and the shells' numbers down the tree
name the shard. By the triangle bound a fingerprint's partners lie in shells at most ``radius // blocks`` away,
so it is sent to those shards as well (boundary overlap; none with radius + 1 blocks, where the bound
leaves one shell only).

A shard of over MAX_SHARD fingerprints is split further under the whole distance: a vantage point is taken from
the shard's own fingerprints, the median of their distances is the boundary, and an inner fingerprint less
than ``radius`` from the boundary is also sent outside, since by the triangle bound only such ones have
partners there. This goes on while it makes shards smaller; what it cannot split is cut into chunks that
meet pairwise in tasks of their own.

Inside a shard a vantage-point search under the full distance finds the exact pairs: only shells within
``radius`` of a fingerprint's own are compared. A shard yields links from each fingerprint to the first of its
component, never all pairs, which keeps connectivity whole. Components are then joined by large-star and
small-star passes, which reduce neighbourhoods by map-side minima and never gather one.

With ``similarity`` the bits only find candidates, and since trees of a radius that wide exclude nothing, the
shards come from the shingles instead: sets of that similarity (Jaccard) share a shingle of their prefixes (see
``prefix``), so the sets with one shingle in their prefixes are a shard. The same search then finds the
candidates in a shard. The documents of each candidate component, one of each shingle set, meet once, and a
link needs the similarity of their sets of shingles (as 64-bit hashes). Components are formed from those links
alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batch_rows, checkpointed, fresh, join_spread, own_columns, remove_folder, whole_text, written

RADIUS = 4
#: Rows of texts that a Python worker takes at once.
BATCH = 1_024
#: Distinct fingerprints of a shard compared by one task at most, and of those a task gathers.
MAX_SHARD = 20_000
TASK_ROWS = 20_000
#: Splits of a shard under the whole distance, one after the other, at most.
SPLITS = 12
#: Mean size of a shard that the choice of blocks aims at, and most trees for it; rows compared together.
SHARD, MAX_TREES, ROWS = 8_192, 100, 64
#: Shingle sets of a candidate component compared by one task at most, and of those a task gathers.
MAX_SETS, TASK_SETS = 8_192, 1_000
#: Share of 256 bits in which candidates differ at most. Sets of Jaccard 0.8 differ in about 0.15 of them.
FAR = 0.25
#: Texts sampled for frequent shingles; those that hold a frequent one at least; frequent shingles kept at most.
SAMPLE, OFTEN, MOST_FREQUENT = 4_000, 8, 100_000
#: Shingles of prefixes that one task sorts.
TASK_SHINGLES = 200_000
FOLD = bytes(i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


def shingles(text: str, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, repeats and all; of all words if they are fewer; none without words."""
    words = text.encode("utf-8", "replace").translate(FOLD).split()
    n = len(words) - shingle + 1
    joined = b" ".join(words)
    if not words:
        return np.zeros(0, np.uint64)
    if n <= 1:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], np.uint64)


def fingerprint(text: str, shingle: int = 4, words64: int = 1) -> list[int]:
    """``words64`` times 64 bits, each set if it is set in over half of the shingles' hashes; 0 without words.

    The first 64 are those of XXH64 (seed 42); further ones come from mixing that hash anew.
    """
    return _majorities(shingles(text, shingle), words64)


def _majorities(h: np.ndarray, words64: int) -> list[int]:
    out = []
    for k in range(words64):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            part = h[at : at + (1 << 16)]
            if k:
                part = (part ^ (part >> np.uint64(29)) ^ np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9)
                part = (part ^ (part >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                part ^= part >> np.uint64(29)
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(sum(1 << b for b in np.flatnonzero(2 * counts > len(h)).tolist()))
    return out


def fingerprints(texts: Column, shingle: int = 4, words64: int = 1) -> Column:
    """struct<fp long (signed), more binary>: the fingerprint of each text, and its further bits."""

    def make(batch: pd.Series) -> pd.DataFrame:
        found = np.array([fingerprint(t, shingle, words64) for t in batch], np.uint64).reshape(-1, words64)
        return pd.DataFrame({"fp": found[:, 0].view(np.int64), "more": [x.tobytes() for x in found[:, 1:]]})

    return F.pandas_udf(make, "fp long, more binary")(texts)


def set_fingerprints(texts: Column, shingle: int, similarity: float, frequent: np.ndarray, words64: int = 4) -> Column:
    """struct<node long, fp long, more binary, prefix binary>: a hash of each text's set of shingles, its bits, its prefix."""

    def make(batch: pd.Series) -> pd.DataFrame:
        sets = [np.unique(shingles(t, shingle)) for t in batch]
        found = np.array([_majorities(h, words64) for h in sets], np.uint64).reshape(-1, words64)
        node = np.array([xxhash.xxh64_intdigest(h.tobytes(), 42) for h in sets], np.uint64)
        out = pd.DataFrame({"node": node.view(np.int64), "fp": found[:, 0].view(np.int64), "more": [x.tobytes() for x in found[:, 1:]]})
        out["prefix"] = [prefix(h, similarity, frequent).tobytes() for h in sets]
        return out

    return F.pandas_udf(make, "node long, fp long, more binary, prefix binary")(texts)


def prefix(h: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set; sets of ``similarity`` (Jaccard) or more share one of them.

    Such sets have at least that share of either in common, so the first common shingle, in whatever order all
    sets use, is among the first |h| - ceil(similarity * |h|) + 1 of both. Here ``frequent`` ones (sorted) come last,
    whichever they are, and hashes decide otherwise.
    """
    first = len(h) - math.ceil((similarity - 1e-9) * len(h)) + 1
    if len(frequent):
        late = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
        h = np.concatenate([h[~late], h[late]])
    return h[:first]


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(shingle, node) from (node, prefix); a task gives those of a node once."""
    seen: set[int] = set()
    for rows in batches:
        rows = rows[~rows["node"].isin(seen)].drop_duplicates("node")
        seen.update(rows["node"].tolist())
        node = np.repeat(rows["node"].to_numpy(np.int64), [len(x) // 8 for x in rows["prefix"]])
        yield pd.DataFrame({"shingle": np.frombuffer(b"".join(rows["prefix"]), np.int64), "node": node})


def frequent_shingles(texts: DataFrame, n: int, shingle: int) -> np.ndarray:
    """Sorted shingles of at least OFTEN of about SAMPLE texts; ``texts``: n rows of text_hash, whole.

    Results do not depend on them, only sizes of shards do; where no shard can be large there are none.
    """
    if n <= MAX_SHARD:
        return np.zeros(0, np.uint64)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            h, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(shingles(t, shingle)) for t in rows["whole"])]), return_counts=True)
            yield pd.DataFrame({"shingle": h.view(np.int64), "c": c.astype(np.int64)})

    some = texts.where(F.pmod("text_hash", F.lit(max(1, n // SAMPLE))) == 0).dropDuplicates(["text_hash"]).select("whole")
    counts = some.mapInPandas(counted, "shingle long, c long").groupBy("shingle").agg(F.sum("c").alias("c"))
    found = counts.where(F.col("c") >= OFTEN).orderBy(F.desc("c"), "shingle").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r.shingle for r in found], np.int64).view(np.uint64))


def shingle_sets(texts: Column, shingle: int) -> Column:
    """binary: the sorted 64-bit hashes of each text's distinct shingles."""

    @F.pandas_udf("binary")
    def make(batch: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingles(t, shingle)).tobytes() for t in batch])

    return make(texts)


def as_hex(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def vantage_points(n: int, mask: int) -> list[int]:
    """Fixed pseudo-random vantage points within a block."""
    return [_signed(xxhash.xxh64_intdigest(f"vantage {i}".encode(), 7) & mask) for i in range(n)]


def block_masks(n_fp: int, radius: int, overlap: int = 0) -> tuple[list[int], int]:
    """Block masks and the radius within a block.

    With ``overlap`` r0, fewer and wider blocks are used whose trees overlap by r0 shells. Otherwise the
    blocks are single ones of radius + 1, or, for very many fingerprints, all pairs or larger sets of more
    and narrower blocks, so that a shard keeps a bounded size while the trees stay exact (MAX_TREES of
    them at most).
    """
    if overlap:
        blocks, together = max(1, -(-(radius + 1) // (overlap + 1))), 1
    else:
        together = 1
        while n_fp / 2 ** (64 * together / (radius + together)) > SHARD and math.comb(radius + together + 1, together + 1) <= MAX_TREES:
            together += 1
        blocks = radius + together
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << cuts[i + 1]) - 1) & ~((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(bits, together)], overlap


def within(fp: np.ndarray, radius: int, more: np.ndarray | None = None, more_radius: int = 0) -> np.ndarray:
    """For each point (a 64-bit word, or a row of them), the number of the first one of its component by links within ``radius``.

    ``more``: further bits (a row of 64-bit words each); a link then also needs at most ``more_radius``
    different bits in all. A vantage-point search: points sorted by distance from the first one have
    their partners in the shells at most ``radius`` away.
    """
    n = len(fp)
    columns = fp.reshape(n, -1).T
    shell = sum(np.bitwise_count(c ^ c[0]).astype(np.int64) for c in columns)
    order = np.argsort(shell, kind="stable")
    points, shells = columns[:, order], shell[order]
    edges = np.searchsorted(shells, np.arange(64 * len(columns) + 2 + radius))
    kind = np.uint8 if len(columns) == 1 else np.uint16
    parent = np.arange(n)

    def roots(x: np.ndarray) -> np.ndarray:
        while (parent[x] != x).any():
            x = parent[x]
        return x

    for a in range(0, n, ROWS):
        b = min(n, a + ROWS)
        end = edges[shells[b - 1] + radius + 1]
        near = reduce(np.add, (np.bitwise_count(c[a:b, None] ^ c[None, a:end]).astype(kind, copy=False) for c in points)) <= radius
        i, j = np.nonzero(near)
        keep = j > i
        i, j = i[keep], j[keep] + a
        if more is not None and len(i):
            x, y = order[a + i], order[j]
            far = np.bitwise_count(fp[x] ^ fp[y]).astype(np.int64) + np.bitwise_count(more[x] ^ more[y]).sum(axis=1, dtype=np.int64)
            i, j = i[far <= more_radius], j[far <= more_radius]
        cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1)) if len(i) else np.zeros(1, np.int64)
        for s, e in zip(cuts[:-1], cuts[1:]):
            own = roots(np.append(j[s:e], a + i[s]))
            parent[own] = own.min()
    top = roots(np.arange(n))
    first = np.full(n, n)
    np.minimum.at(first, top, order)
    label = np.empty(n, np.int64)
    label[order] = first[top]
    return label


def _shard_links(rows: pd.DataFrame, radius: int | None, more_radius: int) -> pd.DataFrame:
    """Links (node, first of its component) inside each shard of a task; without ``radius``, by all bits within ``more_radius``."""
    rows = rows.sort_values(["shard", "node"])
    shard, node = rows["shard"].to_numpy(), rows["node"].to_numpy(np.int64)
    keep = np.ones(len(rows), bool)
    keep[1:] = (shard[1:] != shard[:-1]) | (node[1:] != node[:-1])
    rows, shard, node = rows[keep], shard[keep], node[keep]
    fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
    more = np.frombuffer(b"".join(rows["more"]), np.uint64).reshape(len(rows), -1) if len(rows) and rows["more"].iloc[0] else None
    if radius is None:
        fps, more, radius = np.column_stack([fps, more]) if more is not None else fps, None, more_radius
    cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(rows)]])
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a > 1:
            label = within(fps[a:b], radius, None if more is None else more[a:b], more_radius)
            linked = label != np.arange(b - a)
            out_a.append(node[a:b][linked])
            out_b.append(node[a:b][label[linked]])
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def similar(sets: list[np.ndarray], bits: np.ndarray, more_radius: int, similarity: float) -> np.ndarray:
    """For each set, the number of the first one of its component by links of ``similarity`` (Jaccard) or more.

    ``bits``: a row of 64-bit words each; only sets that differ in at most ``more_radius`` of them are
    compared, nearest first, and only while they are in different components.
    """
    n, parent = len(sets), list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(0, n, ROWS):
        b = min(n, a + ROWS)
        far = sum(np.bitwise_count(bits[a:b, None, k] ^ bits[None, a:, k]).astype(np.int16) for k in range(bits.shape[1]))
        i, j = np.nonzero(far <= more_radius)
        i, j = i[j > i], j[j > i]
        order = np.argsort(far[i, j], kind="stable")
        for x, y in zip((i[order] + a).tolist(), (j[order] + a).tolist()):
            u, v = root(x), root(y)
            if u != v and jaccard(sets[x], sets[y], similarity):
                parent[max(u, v)] = min(u, v)
    return np.array([root(x) for x in range(n)], np.int64)


def jaccard(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sorted sets share ``least`` of their union or more."""
    if min(len(x), len(y)) < (least - 1e-9) * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared >= (least - 1e-9) * (len(both) - shared)


def _set_links(rows: pd.DataFrame, more_radius: int, similarity: float) -> pd.DataFrame:
    """Links (node, first of its component by shingle sets) inside each shard of a task."""
    rows = rows.drop_duplicates(["shard", "node"]).sort_values(["shard", "node"])
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, own in rows.groupby("shard", sort=False):
        if len(own) > 1:
            node = own["node"].to_numpy(np.int64)
            more = np.frombuffer(b"".join(own["more"]), np.uint64).reshape(len(own), -1)
            bits = np.column_stack([own["fp"].to_numpy(np.int64).view(np.uint64), more])
            label = similar([np.frombuffer(x, np.uint64) for x in own["shingles"]], bits, more_radius, similarity)
            linked = label != np.arange(len(own))
            out_a.append(node[linked])
            out_b.append(node[label[linked]])
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def _branches(paths: Column, shell: Column, reach: int) -> Column:
    """The paths one level down: every shell at most ``reach`` away from the point's own."""
    near = F.sequence(F.greatest(shell - reach, F.lit(0)), shell + reach)
    return F.flatten(F.transform(paths, lambda p: F.transform(near, lambda k: p * 65 + k)))


def _shards(placed: DataFrame, key: str, most: int) -> DataFrame:
    """``placed`` with a shard by ``key`` each; keys of over ``most`` rows are cut into chunks that meet pairwise."""
    counts = placed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    big = counts.select(key, F.ceil(F.col("n") / most * 2).cast("int").alias("chunks"))
    placed = placed.join(big, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.xxhash64(key, F.least(chunk, k), F.greatest(chunk, k)))
    return placed.withColumn("shard", F.explode(pair)).drop("chunks", key)


def split_shards(placed: DataFrame, radius: int, most: int = 0) -> DataFrame:
    """``placed`` (node, fp, more, path) with shards of over ``most`` split at vantage points of their own.

    Each split takes the fingerprint of least hash as the vantage point and the median distance from it as
    the boundary; inner fingerprints within ``radius`` of the boundary go to both sides. A shard is left as
    it is once its larger side would hold over 0.9 of it.
    """
    done, most = None, most or MAX_SHARD
    before = None
    for _ in range(SPLITS):
        sizes = placed.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("node"), F.col("fp"))).alias("v"))
        big = checkpointed(sizes.where(F.col("size") > most).select("path", "size", F.col("v.fp").alias("v")))
        if big.isEmpty():
            break
        known = placed.join(big, "path", "left")
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("v")))
        shells = known.where("v IS NOT NULL").groupBy("path", "size", distance.alias("d")).agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(W.partitionBy("path").orderBy("d"))
        edge = shells.withColumn("upto", upto).where(2 * F.col("upto") >= F.col("size")).groupBy("path", "size").agg(F.min(F.struct("d", "upto")).alias("e"))
        near = shells.join(edge.select("path", F.col("e.d").alias("m")), "path").groupBy("path").agg(F.sum(F.when((F.col("d") <= F.col("m")) & (F.col("d") > F.col("m") - radius), F.col("c")).otherwise(0)).alias("both"))
        kept = edge.join(near, "path").withColumn("most", F.greatest(F.col("e.upto"), F.col("size") - F.col("e.upto") + F.col("both")))
        useful = kept.where(F.col("most") <= 0.9 * F.col("size")).select("path", F.col("e.d").alias("m"))
        known = known.join(useful, "path", "left")
        rest = known.where("m IS NULL").select("node", "fp", "more", "path")
        done = rest if done is None else done.unionByName(rest)
        d, m = distance, F.col("m")
        sides = F.when(d > m, F.array(F.lit(1))).when(d > m - radius, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        split = known.where("m IS NOT NULL").select("node", "fp", "more", F.explode(sides).alias("side"), F.col("path").alias("above"))
        placed, at = written(split.select("node", "fp", "more", F.xxhash64("above", "side").alias("path")).distinct())
        done = checkpointed(done)
        if before is not None:
            remove_folder(placed.sparkSession, before)
        before = at
    return placed if done is None else done.unionByName(placed)


def links(fps: DataFrame, radius: int = RADIUS, more_radius: int = 0, overlap: int = 0) -> DataFrame:
    """Links (a, b) of nodes that connect the same nodes as all pairs within ``radius`` do; ``fps``: node, fp, more."""
    n = fps.count()
    masks, r0 = block_masks(n, radius, overlap)
    depth = max(1, min(8, math.ceil(math.log2(max(2, n) / 64) / 2)))
    trees = []
    for t, mask in enumerate(masks):
        shells = [F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(v))) for v in vantage_points(depth, mask)]
        path = F.lit(t).cast("long")
        for s in shells:
            path = path * 65 + s
        if r0:
            # To every shell that the triangle bound cannot exclude.
            trees.append(reduce(lambda paths, s: _branches(paths, s, r0), shells, F.array(F.lit(t).cast("long"))))
        else:
            trees.append(F.array(path))
    placed = fps.select("node", "fp", "more", F.explode(F.concat(*trees)).alias("path"))
    dealt = _shards(split_shards(placed, radius), "path", MAX_SHARD)
    tasks = max(1, n * len(masks) // TASK_ROWS)
    return (
        dealt.withColumn("task", F.pmod("shard", F.lit(tasks)))
        .groupBy("task").applyInPandas(lambda rows: _shard_links(rows, radius, more_radius), "a long, b long")
        .distinct()
    )


def _sharing(rows: pd.DataFrame) -> pd.DataFrame:
    """(path, node) for the shingles of a task that several nodes have; shingles of the same nodes have one path."""
    rows = rows.drop_duplicates(["shingle", "node"]).sort_values("shingle")
    shingle, node = rows["shingle"].to_numpy(), rows["node"].to_numpy(np.int64)
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), shingle[1:] != shingle[:-1]]))
    sizes = np.diff(np.append(starts, len(rows)))
    path = np.add.reduceat(node, starts) if len(rows) else np.zeros(0, np.int64)
    out = pd.DataFrame({"path": np.repeat(path, sizes), "node": node})
    return out[np.repeat(sizes > 1, sizes)].drop_duplicates()


def sharing(sets: DataFrame) -> DataFrame:
    """(path, node): nodes that share a shingle of their prefixes share a path; ``sets``: node, prefix (rows may repeat)."""
    n = (sets.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0) // 8
    rows = sets.select("node", "prefix").mapInPandas(_shingle_rows, "shingle long, node long")
    dealt = rows.withColumn("task", F.pmod("shingle", F.lit(max(1, n // TASK_SHINGLES))))
    return dealt.groupBy("task").applyInPandas(_sharing, "path long, node long").distinct()


def sharing_links(fps: DataFrame, placed: DataFrame, more_radius: int) -> DataFrame:
    """Links (a, b) of nodes that connect the same nodes as all pairs of one path within ``more_radius`` do.

    ``fps``: node, fp, more; ``placed``: path, node. The path of over MAX_SHARD nodes is cut into chunks that meet
    pairwise; with frequent shingles last these are few.
    """
    tasks = max(1, placed.count() // TASK_ROWS)
    return (
        _shards(placed, "path", MAX_SHARD).join(fps, "node")
        .withColumn("task", F.pmod("shard", F.lit(tasks)))
        .groupBy("task").applyInPandas(lambda rows: _shard_links(rows, None, more_radius), "a long, b long")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge, by star contraction.

    Every pass halves the distances to the minimum roughly. It ends when the edges are stars: no node has
    two edges to smaller ones, and none has both smaller and larger ones. Each pass's files go when the
    next one's are written.
    """
    edges, at = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: each larger neighbour is tied to the node's minimum.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: each smaller neighbour, and the node, are tied to the minimum.
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(small_least, "u")
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        before = at
        edges, at = written(small.distinct())
        remove_folder(edges.sparkSession, before)


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = RADIUS, similarity: float | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (signed long), text_hash, component_id (smallest doc_id reachable).

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked. With ``similarity``, a link
    needs that Jaccard similarity of the sets of shingles instead, and the bits (256 of the set, FAR of them,
    whatever ``radius`` is) only find the candidates among sets that share a shingle of their prefixes. Null and empty texts have fingerprint zero and are linked like
    any other; a null key is never the smallest of a component that has another key; repeated rows
    share their component; an empty table gives no rows; very long texts are read whole; other columns are
    ignored.
    """
    spark = docs.sparkSession
    with batch_rows(spark, BATCH):
        whole = whole_text(text)
        texts = docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("whole"))
        if similarity is None:
            made = texts.select("doc_id", "text_hash", fingerprints(F.col("whole"), shingle).alias("f"))
            return cluster(checkpointed(made.select("doc_id", "text_hash", F.col("f.fp").alias("node"), "f.fp", "f.more")), radius)
        frequent = frequent_shingles(texts, docs.count(), shingle)
        made = texts.select("doc_id", "text_hash", set_fingerprints(F.col("whole"), shingle, similarity, frequent).alias("f"))
        sets, sets_at = written(made.select("doc_id", "text_hash", "f.node", "f.fp", "f.more", "f.prefix"))
        marked = checkpointed(sets.drop("prefix"))
        placed, placed_at = written(sharing(sets))
        remove_folder(spark, sets_at)
        more_radius = math.floor(256 * FAR)
        candidates = components(sharing_links(marked.select("node", "fp", "more").distinct(), placed, more_radius))
        remove_folder(spark, placed_at)
        return named(marked, components(set_links(marked, candidates, texts, shingle, more_radius, similarity)))


def set_links(marked: DataFrame, candidates: DataFrame, texts: DataFrame, shingle: int, more_radius: int, similarity: float) -> DataFrame:
    """Links (a, b) of nodes by the shingle sets of one text each, inside the candidate components."""
    tops = candidates.select(F.col("component").alias("node"), "component").distinct()
    members = candidates.select("node", "component").unionByName(tops)
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    picked = marked.groupBy("node", "fp", "more").agg(one).join(members, "node")
    picked = picked.select("node", "fp", "more", "component", F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash"))
    dealt = _shards(picked, "component", MAX_SETS)
    found = texts.join(dealt, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    # A text that the table repeats is dropped by its task.
    dealt = found.select("node", "fp", "more", "shard", shingle_sets(F.col("whole"), shingle).alias("shingles"))
    tasks = max(1, candidates.count() // TASK_SETS)
    return (
        dealt.withColumn("task", F.pmod(F.xxhash64("shard"), F.lit(tasks)))
        .groupBy("task").applyInPandas(lambda rows: _set_links(rows, more_radius, similarity), "a long, b long")
        .distinct()
    )


def cluster(marked: DataFrame, radius: int = RADIUS, more_radius: int = 0) -> DataFrame:
    """(doc_id, fp, text_hash, component_id) from (doc_id, text_hash, node, fp, more)."""
    return named(marked, components(links(marked.select("node", "fp", "more").distinct(), radius, more_radius)))


def named(marked: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, fp, text_hash, root, component_id) from (doc_id, text_hash, node, fp) and the nodes' components."""
    n = marked.count()
    distinct = marked.groupBy("node").agg(F.min("doc_id").alias("least"))
    linked = found.select("node", "component").unionByName(found.select(F.col("component").alias("node"), "component")).distinct()
    members = checkpointed(distinct.join(linked, "node"))
    smallest = members.groupBy("component").agg(F.min("least").alias("smallest"))
    told = join_spread(members, smallest, "component", members.count(), F.xxhash64("node")).select("node", F.col("component").alias("root"), "smallest")
    by_node = distinct.join(told.withColumn("told", F.lit(True)), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.when(F.col("told"), F.col("smallest")).otherwise(F.col("least")).alias("component_id")
    )
    return join_spread(marked, by_node, "node", n, F.xxhash64("doc_id", "text_hash")).select("doc_id", "fp", "text_hash", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 5, radius: int = 16, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each near-duplicate component kept, with their own columns, whatever their names.

    The smallest doc_id stays (of several texts with it, that of the smallest text hash; a null doc_id comes
    last). Rows with the same doc_id and text are one document: one of them stays, whatever else they hold. Null
    and empty texts are copies of each other; very long texts are read whole; an empty table gives no rows.
    """
    last, name, digest = F.lit((1 << 63) - 1), fresh("id"), fresh("hash")
    clusters = near_duplicates(docs, shingle, radius, similarity, key, text).withColumn(name, F.coalesce(F.col("doc_id").cast("long"), last))
    kept = clusters.groupBy("root").agg(F.min(F.struct(name, "text_hash")).alias("k")).select(f"k.{name}", F.col("k.text_hash").alias(digest))
    own = docs.select(*own_columns(docs), F.coalesce(F.col(key).cast("long"), last).alias(name), F.xxhash64(whole_text(text)).alias(digest))
    return own.join(kept, [name, digest], "left_semi").dropDuplicates([name, digest]).drop(name, digest)
