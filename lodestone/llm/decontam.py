"""Benchmark decontamination with a stored, distributed positional inverted index.

``build_index`` cuts the documents into segments (one Arrow batch each) and stores, for every segment and every
term of the benchmark's vocabulary that occurs in it, the sorted list of the term's word positions (in rows of
ROW_POSTINGS). The lists
are written to the shared folder, ranged by (term, segment) and sorted, so that a frequent term is spread over
many files; the documents' lengths are stored beside them. Words that the benchmark lacks can match nothing
and are not stored.

The search starts from document frequency over the whole corpus. Of each benchmark window only the lists of its
two rarest terms are fetched; they are shifted to the window's start and intersected (offset-adjusted). Only
for segments and windows that survive are the other terms' lists fetched and intersected, again from the
rarest on. What is left are exact phrase matches. ``within`` asks for proximity matches as well: all terms
of a window occur, in any order, within so many consecutive words.

The vocabulary and the windows are what is broadcast: the benchmark is cut into blocks of BLOCK_BYTES, which
bounds both, and the blocks are searched one after the other, each with an index of its own.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, checkpointed, fresh, own_columns, remove_folder, whole_text, written

WINDOW = 10
#: Benchmark text bytes in one block; a larger benchmark takes more blocks.
BLOCK_BYTES = 8 << 20
#: Candidates looked at together, which bounds memory.
CANDIDATES = 1 << 18
#: Documents of a segment at most (and 64 MiB of text).
SEGMENT_ROWS = 4_096
#: Postings in one file of the index, roughly, and in one row: rows of a bounded size spread evenly by their number.
FILE_POSTINGS, ROW_POSTINGS = 1_000_000, 1_024
#: Pairs (segment, term) still needed that are broadcast at most (12 bytes each, 24 as a row); more are sorted and merged.
BROADCAST_PAIRS = 500_000

#: Bytes outside words become spaces, A-Z become a-z; bytes of non-ASCII characters belong to words.
FOLD = bytes((i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20) for i in range(256))

STORED = "kind int, segment long, term int, n int, positions binary, row long, id string, h1 long, h2 long, start int, n_words int"
SEEDS = "segment long, windows binary, places binary, terms array<int>"
FOUND = "segment long, windows binary, places binary, flags binary"
RESULT = "row long, id string, h1 long, h2 long, n_words long, n_hit long, hits binary, items array<string>, near array<string>"


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def words(text: str) -> list[bytes]:
    """The folded words of a text."""
    return text.encode("utf-8", "replace").translate(FOLD).split()


class Windows:
    """The windows of a block of the benchmark: their terms (-1 beyond the end), lengths and items."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            for i in range(max(1, len(ids) - size + 1)) if ids else ():
                found.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.owners = [sorted(x) for x in found.values()]
        self.length = np.array([len(w) for w in found], np.int64)
        self.terms = np.full((len(found), size), -1, np.int32)
        for k, w in enumerate(found):
            self.terms[k, : len(w)] = w
        self.order = np.zeros((len(found), size), np.int64)
        self.live = np.zeros(len(found), bool)

    def rank(self, frequency: np.ndarray) -> None:
        """Orders each window's places by their terms' frequency in the corpus, rarest first; windows with an absent term are dead."""
        inside = self.terms >= 0
        df = np.where(inside, frequency.astype(np.int64)[np.maximum(self.terms, 0)], np.iinfo(np.int64).max)
        self.order = np.argsort(df, axis=1, kind="stable")
        self.live = np.where(inside, df, 1).min(axis=1, initial=1) > 0

    def first_terms(self) -> np.ndarray:
        """The two rarest terms of every live window."""
        live = np.flatnonzero(self.live)
        found = np.unique(np.concatenate([np.zeros(0, np.int32), *(self.terms[live, self.order[live, k]] for k in range(min(2, self.terms.shape[1])))]))
        return found[found >= 0]


class Lists:
    """The posting lists of a segment as one sorted array of (term, position)."""

    def __init__(self, rows: pd.DataFrame):
        parts = [np.int64(t) << 32 | np.frombuffer(p, np.int32).astype(np.int64) for t, p in zip(rows["term"], rows["positions"])]
        self.keys = np.sort(np.concatenate([np.zeros(0, np.int64), *parts, np.array([np.iinfo(np.int64).max])]))

    def bounds(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = terms.astype(np.int64) << 32
        return np.searchsorted(self.keys, own), np.searchsorted(self.keys, own + (1 << 32))

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term occurs at each place."""
        wanted = terms.astype(np.int64) << 32 | np.maximum(places, 0)
        return (places >= 0) & (self.keys[np.searchsorted(self.keys, wanted)] == wanted)

    def near(self, terms: np.ndarray, places: np.ndarray, reach: int) -> np.ndarray:
        """Whether each term occurs at most ``reach`` words from each place."""
        own = terms.astype(np.int64) << 32
        return self.keys[np.searchsorted(self.keys, own | np.maximum(places - reach, 0))] <= (own | (places + reach))

    def around(self, term: int, place: int, reach: int) -> np.ndarray:
        """The places of a term at most ``reach`` words from ``place``."""
        own = np.int64(term) << 32
        a, b = np.searchsorted(self.keys, [own | max(place - reach, 0), (own | (place + reach)) + 1])
        return self.keys[a:b] - own


def segments(batches, vocabulary: dict[bytes, int], gap: int):  # noqa: ANN001, ANN201
    """The stored rows of each batch of documents: kind 1 a term's positions, kind 0 a document.

    Documents are laid end to end with a gap that neither window nor proximity can cross.
    """
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    for k, batch in enumerate(batches):
        segment, at, ids, starts, n_words = part << 24 | k, 0, [], [], []
        for text in batch["text"]:
            found = words(text)
            ids.append(np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int32, len(found)))
            starts.append(at)
            n_words.append(len(found))
            at += len(found) + gap
        places = np.concatenate([np.zeros(0, np.int32), *(np.flatnonzero(x >= 0).astype(np.int32) + np.int32(s) for x, s in zip(ids, starts))])
        terms = np.concatenate([np.zeros(0, np.int32), *(x[x >= 0] for x in ids)])
        order = np.argsort(terms, kind="stable")
        terms, places = terms[order], places[order]
        cuts = np.flatnonzero(np.diff(terms, prepend=-1, append=-1)) if len(terms) else np.zeros(1, np.int64)
        long = np.flatnonzero(np.diff(cuts) > ROW_POSTINGS)
        cuts = np.sort(np.concatenate([cuts, *(np.arange(cuts[i] + ROW_POSTINGS, cuts[i + 1], ROW_POSTINGS) for i in long)]))
        lists = pd.DataFrame({"term": terms[cuts[:-1]], "n": np.diff(cuts).astype(np.int32), "positions": [places[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]})
        lists = lists.assign(kind=1, segment=segment, id=None, **{c: pd.array([None] * len(lists), "Int64") for c in ("row", "h1", "h2", "start", "n_words")})
        yield lists[_columns(STORED)]
        yield batch[["row", "id", "h1", "h2"]].assign(kind=0, segment=segment, term=-1, n=0, positions=None, start=np.array(starts, np.int32), n_words=np.array(n_words, np.int32))[_columns(STORED)]


def seeds(rows: pd.DataFrame, w: Windows, within: int | None) -> pd.DataFrame:
    """Of a segment's lists of rarest terms: the windows and the rarest term's places where the two rarest agree."""
    lists, reach = Lists(rows), (within or 1) - 1
    live = np.flatnonzero(w.live)
    first = w.order[live, 0]
    a, b = lists.bounds(w.terms[live, first])
    some = b > a
    live, first, a, b = live[some], first[some], a[some], b[some]
    total = np.cumsum(b - a)
    cut = np.searchsorted(total, np.arange(CANDIDATES, (total[-1] if len(total) else 0) + CANDIDATES, CANDIDATES), side="left") + 1
    out_w, out_p = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for i, j in zip(np.concatenate([[0], cut]), np.minimum(cut, len(live))):
        if i >= j:
            continue
        count = b[i:j] - a[i:j]
        which = np.repeat(np.arange(i, j), count)
        place = lists.keys[a[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)] & 0xFFFFFFFF
        keep = np.ones(len(which), bool)
        if w.terms.shape[1] > 1:
            second = w.order[live[which], 1]
            term = w.terms[live[which], second]
            rest = np.flatnonzero(term >= 0)
            both = lists.has(term[rest], place[rest] + second[rest] - first[which[rest]])
            if within:
                both |= lists.near(term[rest], place[rest], reach)
            keep[rest] = both
        out_w.append(live[which[keep]].astype(np.int32))
        out_p.append(place[keep].astype(np.int32))
    which, place = np.concatenate(out_w), np.concatenate(out_p)
    if not len(which):
        return pd.DataFrame(columns=_columns(SEEDS))
    terms = np.unique(w.terms[np.unique(which)])
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "windows": [which.tobytes()], "places": [place.tobytes()], "terms": [terms[terms >= 0]]})


def verified(seeded: pd.DataFrame, rows: pd.DataFrame, w: Windows, within: int | None) -> pd.DataFrame:
    """The seeds of a segment that are phrase (flag 1) or proximity matches (flag 2), by all terms' lists, rarest first."""
    if not len(seeded):
        return pd.DataFrame(columns=_columns(FOUND))
    lists, reach = Lists(rows), (within or 1) - 1
    which, place = np.frombuffer(seeded["windows"].iloc[0], np.int32), np.frombuffer(seeded["places"].iloc[0], np.int32).astype(np.int64)
    start = place - w.order[which, 0]
    phrase, near = start >= 0, np.full(len(which), bool(within))
    for k in range(w.terms.shape[1]):
        own = np.flatnonzero(phrase | near)
        offset = w.order[which[own], k]
        term = w.terms[which[own], offset]
        own, offset, term = own[term >= 0], offset[term >= 0], term[term >= 0]
        phrase[own] &= lists.has(term, start[own] + offset)
        if within:
            near[own] &= lists.near(term, place[own], reach)
    if within:
        # A phrase match is as long as its window; only the other ones are looked at word by word.
        for i in np.flatnonzero(near & ~(phrase & (w.length[which] <= within))).tolist():
            near[i] = _together(lists, sorted({t for t in w.terms[which[i]].tolist() if t >= 0}), int(place[i]), within)
    keep = phrase | near
    flags = (phrase + 2 * near).astype(np.uint8)
    return pd.DataFrame({"segment": [int(seeded["segment"].iloc[0])], "windows": [which[keep].tobytes()], "places": [place[keep].astype(np.int32).tobytes()], "flags": [flags[keep].tobytes()]})


def _together(lists: Lists, terms: list[int], place: int, within: int) -> bool:
    """Whether some ``within`` consecutive words that hold ``place`` have all terms."""
    last: dict[int, int] = {}
    for p, t in sorted((int(p), t) for t in terms for p in lists.around(t, place, within - 1)):
        last[t] = p
        if p >= place and len(last) == len(terms) and p - min(*last.values(), place) < within:
            return True
    return False


def told(docs: pd.DataFrame, found: pd.DataFrame, w: Windows) -> pd.DataFrame:
    """One row per document of a segment, with its hit words and the items found in it."""
    if not len(docs):
        return pd.DataFrame(columns=_columns(RESULT))
    docs = docs.sort_values("start")
    start, n_words = docs["start"].to_numpy(np.int64), docs["n_words"].to_numpy(np.int64)
    edges = np.zeros(int(start[-1] + n_words[-1]) + 1, np.int32)
    sets: dict[int, list[set[str]]] = {bit: [set() for _ in range(len(docs))] for bit in (1, 2)}
    if len(found):
        which, place = np.frombuffer(found["windows"].iloc[0], np.int32), np.frombuffer(found["places"].iloc[0], np.int32).astype(np.int64)
        flags = np.frombuffer(found["flags"].iloc[0], np.uint8)
        doc = np.searchsorted(start, place, side="right") - 1
        for bit, own_sets in sets.items():
            own = np.flatnonzero(flags & bit)
            for d, k in zip(*(x.tolist() for x in np.divmod(np.unique(doc[own] * len(w.owners) + which[own]), len(w.owners)))):
                own_sets[d].update(w.owners[k])
        own = np.flatnonzero(flags & 1)
        begin = place[own] - w.order[which[own], 0]
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + w.length[which[own]], -1)
    hit = np.cumsum(edges) > 0
    masks = [hit[s : s + n] for s, n in zip(start, n_words)]
    out = docs[["row", "id", "h1", "h2"]].assign(n_words=n_words, n_hit=[int(m.sum()) for m in masks])
    out["hits"] = [np.packbits(m).tobytes() if i else b"" for m, i in zip(masks, sets[1])]
    return out.assign(items=[sorted(i) for i in sets[1]], near=[sorted(i) for i in sets[2]])


def _blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """The benchmark in blocks of bounded size."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), whole_text(text).alias("t"))
    n = int(rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0) // BLOCK_BYTES + 1
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) for k in range(n)]


def build_index(rows: DataFrame, w: Windows, gap: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The stored index (term, segment, n, positions), the documents by segment, and each term's frequency; ``rows``: row, id, h1, h2, text."""
    spark = rows.sparkSession
    vocabulary = spark.sparkContext.broadcast(w.vocabulary)
    with batch_rows(spark, SEGMENT_ROWS):
        stored, at = written(rows.mapInPandas(lambda batches: segments(batches, vocabulary.value, gap), STORED), "kind")
    lists = stored.where("kind = 1").select("term", "segment", "n", "positions")
    frequency = np.zeros(len(w.vocabulary) + 1, np.int64)
    for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row a term of the block's vocabulary
        frequency[r.term] = r.n
    files = max(1, int(frequency.sum()) // FILE_POSTINGS)
    index = checkpointed(lists.repartitionByRange(files, "term", "segment").sortWithinPartitions("term", "segment"))
    remove_folder(spark, f"{at}/kind=1")
    return index, stored.where("kind = 0").select("segment", "row", "id", "h1", "h2", "start", "n_words"), frequency


def _search(rows: DataFrame, items: list[tuple[str, str]], window: int, within: int | None) -> DataFrame:
    """RESULT rows of one block of the benchmark."""
    spark, w = rows.sparkSession, Windows(items, window)
    index, docs, frequency = build_index(rows, w, max(window, within or 1))
    w.rank(frequency)
    shared = spark.sparkContext.broadcast(w)
    rarest = spark.createDataFrame([(int(t),) for t in w.first_terms()], "term int")
    seeded = checkpointed(index.join(F.broadcast(rarest), "term", "left_semi").groupBy("segment").applyInPandas(lambda g: seeds(g, shared.value, within), SEEDS))
    needed = seeded.select("segment", F.explode("terms").alias("term"))
    # Counted, since Spark's own estimate leaves out what explode multiplies.
    pairs = seeded.agg(F.sum(F.size("terms"))).first()[0] or 0
    needed = F.broadcast(needed) if pairs <= BROADCAST_PAIRS else needed.hint("merge")
    lists = index.join(needed, ["segment", "term"]).select("segment", "term", "positions")
    found = seeded.groupBy("segment").cogroup(lists.groupBy("segment")).applyInPandas(lambda s, g: verified(s, g, shared.value, within), FOUND)
    return docs.groupBy("segment").cogroup(found.groupBy("segment")).applyInPandas(lambda d, f: told(d, f, shared.value), RESULT)


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """The results of two blocks over the same stored rows."""
    either = F.pandas_udf(lambda x, y: pd.Series([_either(m, n) for m, n in zip(x, y)]), "binary")
    ones = F.pandas_udf(lambda x: pd.Series([int(np.bitwise_count(np.frombuffer(m, np.uint8)).sum()) for m in x]), "long")
    union = lambda c: F.array_sort(F.array_union(c, f"{c}2")).alias(c)
    both = a.join(b.select("row", *(F.col(c).alias(f"{c}2") for c in ("hits", "items", "near"))), "row")
    both = both.select("row", "id", "h1", "h2", "n_words", either("hits", "hits2").alias("hits"), union("items"), union("near"))
    return both.select("row", "id", "h1", "h2", "n_words", ones("hits").alias("n_hit"), "hits", "items", "near")


def _either(a: bytes, b: bytes) -> bytes:
    """The union of two masks, of which either may be empty."""
    return bytes(np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)) if a and b else bytes(a or b)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, within: int | None = None, key: str | None = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: doc_id (null without ``key``), n_words, n_hit, hits, items, near, h1 and h2 (hashes of the text).

    ``hits`` is a bit mask over the document's words (most significant bit first, empty without hits), n_hit
    its count, ``items`` the sorted items with a window in the document, ``near`` those with a window whose terms all
    occur within ``within`` consecutive words (empty without ``within``). Nulls: a null text has no words, a null item
    id is the empty string. Empty texts and items without words match nothing; an item of fewer words than
    ``window`` is one window; very long texts are read whole. Repeated items count once by their id; repeated
    documents give repeated rows; empty tables give no hits; other columns are ignored, whatever their names.
    """
    whole = whole_text(text)
    kind, own_key = ("string", F.lit(None)) if key is None else (docs.select(key).schema[0].dataType, F.col(key))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), own_key.cast("string").alias("id"), F.xxhash64(whole).alias("h1"), F.xxhash64(F.lit("2"), whole).alias("h2"), whole.alias("text"))
    blocks = _blocks(benchmark, item, item_text)
    if len(blocks) > 1:  # the numbers of the rows must be the same for every block
        rows = checkpointed(rows)
    out = None
    for block in blocks:
        own = _search(rows, [(r.i, r.t) for r in block.toLocalIterator()], window, within)
        own = checkpointed(own) if len(blocks) > 1 else own
        out = own if out is None else _merged(out, own)
    return out.select(F.col("id").cast(kind).alias("doc_id"), "n_words", "n_hit", "hits", "items", "near", "h1", "h2")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their own columns, whatever their names.

    Whether a document goes depends on its text alone, so the texts that were hit are joined by two hashes.
    Null and empty texts stay; repeated rows stay or go together; very long texts are read whole; empty
    tables change nothing.
    """
    one, two = fresh("h1"), fresh("h2")
    found = decontaminate(docs, benchmark, key=None, text=text).where("n_hit > 0")
    hit = checkpointed(found.select(F.col("h1").alias(one), F.col("h2").alias(two)).distinct())
    own = docs.select(*own_columns(docs), F.xxhash64(whole_text(text)).alias(one), F.xxhash64(F.lit("2"), whole_text(text)).alias(two))
    return own.join(hit, [one, two], "left_anti").drop(one, two)
