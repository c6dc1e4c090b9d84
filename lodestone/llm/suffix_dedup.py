"""Exact removal of repeated passages by a depth-limited radix sort of suffixes.

Every position starts a suffix, of which only the first WINDOW bytes count. Sorting suffixes to that depth
by most-significant-digit passes leaves, in equal groups, exactly the repeated windows; the smallest
doc_id of a group keeps its window, later documents lose theirs.

Sorting all suffixes of a corpus would move many times its size, so passes are arranged such that a suffix
drops out as early as possible:

1. First digit. In each window the GRAM-byte string of least hash is its anchor; equal windows have equal
   anchors at equal offsets, and neighbouring windows mostly share theirs. Anchors are bucketed by hash
   digits, and a digit value that occurs in one document only ends its windows' sort. The digits
   travel as sorted runs of 32 bits, one run for each bucket and block of documents.
2. Context. For the anchors that remain, the bytes of their windows (at most 2 WINDOW - GRAM) are sent once
   per block of documents and distinct content, with the smallest doc_id, and are bucketed by anchor.
3. Radix passes. A bucket expands its contexts to windows and sorts them by their bytes, eight a pass from
   the first on. After each pass groups of one leave, and so do groups that agree in all bytes still to come:
   what is equal in the end are the repeated windows, byte by byte. The windows of each context that an
   earlier document has go back to its block as a bit mask, by the context's place in what the block sent.

An anchor that occurs more than HOT times sends its distinct windows instead, as two 64-bit digits, bucketed
by the first, so that no bucket gathers what a frequent line or passage has around it; those windows are
equal if both digits are (128 bits). Copies inside a block
are settled there. Blocks are documents dealt by a hash of doc_id, so hot sources spread evenly; documents are
shuffled once, and the three steps that read blocks reuse that exchange.
"""

from __future__ import annotations

import ctypes
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, whole_text

WINDOW = 50
GRAM = 24
BLOCK_BYTES = 4 << 20
#: Bits of the bucket number at least, so that small inputs are dealt out as well.
MIN_BITS = 10
HOT = 4_096
#: Positions hashed together, and contexts looked at together: they bound a worker's memory.
CHUNK, SLICE = 1 << 18, 1 << 12
#: A doc_id for rows without one: later than every other.
LAST = (1 << 63) - 1

_STEP = 0x9E3779B97F4A7C15
_FLAGS = "bucket long, block long, kind int, a binary, b binary, c binary"
_KEPT = "doc_id long, n_bytes long, starts array<int>, ends array<int>, kept binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k values in a row along the last axis, by doubling."""
    power, part = {1: values.astype(np.uint64) + np.uint64(1)}, 1
    while part * 2 <= k:
        x, p = power[part], np.uint64(pow(_STEP, part, 1 << 64))
        power[part * 2] = x[..., : x.shape[-1] - part] * p + x[..., part:]
        part *= 2
    done, have = None, 0
    for size in sorted(power, reverse=True):
        if k & size:
            x = power[size]
            if done is None:
                done, have = x, size
            else:
                n = values.shape[-1] - have - size + 1
                done = done[..., :n] * np.uint64(pow(_STEP, size, 1 << 64)) + x[..., have : have + n]
                have += size
    return _mixed(done)


def _least(x: np.ndarray, k: int) -> np.ndarray:
    """The least of every k values in a row."""
    size = 1
    while size * 2 <= k:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = k - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Texts:
    """The documents of a block, end to end, and the anchors of their windows."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["doc_id", "text"], kind="stable")
        raw = [t.encode("utf-8", "replace") for t in rows["text"]]
        self.doc_id = rows["doc_id"].to_numpy(np.int64)
        self.is_null = rows["is_null"].to_numpy(bool)
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        found = [self._anchors(at) for at in range(0, max(0, len(self.bytes) - WINDOW + 1), CHUNK)]
        join = lambda i, kind: np.concatenate([f[i] for f in found]) if found else np.zeros(0, kind)
        #: By run of windows with one anchor: the anchor's place and hash, the first and last window.
        self.at, self.hash, self.first, self.last = join(0, np.int64), join(1, np.uint64), join(2, np.int64), join(3, np.int64)
        self.doc = self.doc_id[np.searchsorted(self.start, self.at, side="right") - 1] if len(self.at) else np.zeros(0, np.int64)

    def _anchors(self, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        part = self.bytes[begin : begin + CHUNK + WINDOW - 1]
        n = len(part) - WINDOW + 1
        h = grams(part, GRAM)
        low = np.uint64((1 << 21) - 1)
        least = _least((h & ~low) | np.arange(len(h), dtype=np.uint64), WINDOW - GRAM + 1)[:n]
        anchor = (least & low).astype(np.int64)
        ok = np.ones(n, bool)
        # Windows that reach into the next document are none.
        for end in self.start[np.searchsorted(self.start, begin, side="right") : np.searchsorted(self.start, begin + n + WINDOW, side="right")]:
            ok[max(0, end - WINDOW + 1 - begin) : max(0, end - begin)] = False
        cut = np.ones(n + 1, bool)
        cut[1:n] = (anchor[1:] != anchor[:-1]) | (ok[1:] != ok[:-1])
        edges = np.flatnonzero(cut)
        first, last = edges[:-1], edges[1:] - 1
        keep = ok[first]
        first, last = first[keep], last[keep]
        return anchor[first] + begin, h[anchor[first]], first + begin, last + begin

    def contexts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some runs: the bytes around the anchor (zero outside the run's windows), first and last window in them."""
        reach = WINDOW - GRAM
        out = np.zeros((len(chosen), WINDOW + reach), np.uint8)
        for i in range(0, len(chosen), SLICE):
            own = chosen[i : i + SLICE]
            place = self.at[own][:, None] + np.arange(-reach, WINDOW)
            inside = (place >= self.first[own][:, None]) & (place < self.last[own][:, None] + WINDOW)
            out[i : i + SLICE][inside] = self.bytes[place[inside]]
        at = self.at[chosen] - reach
        return out, (self.first[chosen] - at).astype(np.uint8), (self.last[chosen] - at).astype(np.uint8)


def _context_key(context: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each context with its range of windows."""
    out = np.zeros(len(context), np.uint64)
    for i in range(0, len(context), SLICE):
        part = slice(i, i + SLICE)
        whole = np.concatenate([context[part], first[part, None], last[part, None]], axis=1)
        out[part] = grams(whole, whole.shape[1])[:, 0]
    return out


def _windows(context: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of contexts as two digits, with the context's row and the window's place in it."""
    half, k = WINDOW // 2, np.arange(WINDOW - GRAM + 1)
    parts = []
    for i in range(0, max(1, len(context)), SLICE):
        digits = grams(context[i : i + SLICE], half)
        row, place = np.nonzero((k >= first[i : i + SLICE, None]) & (k <= last[i : i + SLICE, None]))
        parts.append((digits[row, place], digits[row, place + half], (row + i).astype(np.int32), place.astype(np.uint8)))
    d1, d2, row, place = (np.concatenate(x) for x in zip(*parts))
    return d1, d2, row, place


def _distinct(context: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of the first of each distinct context (with its range of windows), and each row's number among them.

    Found by a 64-bit hash; should two different contexts share one, by the bytes themselves.
    """
    _, one, inverse = np.unique(_context_key(context, first, last), return_index=True, return_inverse=True)
    for i in range(0, len(context), SLICE):
        part, other = slice(i, i + SLICE), one[inverse[i : i + SLICE]]
        if not ((context[part] == context[other]).all() and (first[part] == first[other]).all() and (last[part] == last[other]).all()):
            whole = np.ascontiguousarray(np.concatenate([context, first[:, None], last[:, None]], axis=1))
            _, one, inverse = np.unique(whole.view(np.dtype((np.void, whole.shape[1]))).ravel(), return_index=True, return_inverse=True)
            break
    return one, inverse


def _least_docs(n: int, inverse: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The least doc of each of n distinct things."""
    least = np.full(n, LAST, np.int64)
    np.minimum.at(least, inverse, doc)
    return least


def _trimmed(rows: pd.DataFrame) -> pd.DataFrame:
    """``rows``, with the memory that its making freed given back: workers live on between groups."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
    pa.default_memory_pool().release_unused()
    return rows


def _rows(columns: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(columns, columns=["bucket", "block", "kind", "a", "b", "c"])


def _runs(bucket: np.ndarray):  # noqa: ANN202
    """(bucket, slice) of the runs of equal buckets."""
    cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield int(bucket[a]), slice(a, b)


def first_digits(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A block's distinct anchor digits by bucket, whether more than one of its documents has each, and how often."""
    texts, block = Texts(rows), int(rows["block"].iloc[0])
    key, inverse = np.unique(texts.hash >> np.uint64(32 - bits), return_inverse=True)
    least, most = np.full(len(key), LAST, np.int64), np.full(len(key), -LAST - 1, np.int64)
    np.minimum.at(least, inverse, texts.doc)
    np.maximum.at(most, inverse, texts.doc)
    several = least < most
    times = np.minimum(np.bincount(inverse, minlength=len(key)), 0xFFFF).astype(np.uint16)
    buckets = (key >> np.uint64(32)).astype(np.int64)
    return _trimmed(_rows([(b, block, 0, key[s].astype(np.uint32).tobytes(), np.packbits(several[s]).tobytes(), times[s].tobytes()) for b, s in _runs(buckets)]))


def repeated_digits(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket, each block's digits that more than one document has, and which of them are hot."""
    keys = [np.frombuffer(a, np.uint32) for a in rows["a"]]
    several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)) for b, k in zip(rows["b"], keys)]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    blocks = np.bincount(inverse, minlength=len(distinct))
    repeated = blocks > 1
    repeated[inverse[np.concatenate(several) > 0]] = True
    times = np.bincount(inverse, np.concatenate([np.frombuffer(c, np.uint16) for c in rows["c"]]), len(distinct))
    hot, out, at = times > HOT, [], 0
    for bucket, block, k in zip(rows["bucket"], rows["block"], keys):
        own = inverse[at : at + len(k)]
        at += len(k)
        mine = repeated[own]
        if mine.any():
            out.append((bucket, block, 0, k[mine].tobytes(), np.packbits(hot[own[mine]]).tobytes(), None))
    return _trimmed(_rows(out))


def _flagged(texts: Texts, flags: pd.DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs whose digit is repeated, and which of them are hot."""
    keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for bucket, a, b in zip(flags["bucket"], flags["a"], flags["b"]):
        own = np.frombuffer(a, np.uint32)
        keys.append(own.astype(np.uint64) | np.uint64(bucket << 32))
        hot.append(np.unpackbits(np.frombuffer(b, np.uint8), count=len(own)))
    key, heat = np.concatenate(keys), np.concatenate(hot)
    order = np.argsort(key)
    key, heat = key[order], heat[order]
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    own = texts.hash >> np.uint64(32 - bits)
    place = np.minimum(np.searchsorted(key, own), len(key) - 1)
    chosen = np.flatnonzero(key[place] == own)
    return chosen, heat[place[chosen]] > 0


class Sent:
    """What a block sends of its repeated anchors, in an order that it finds again when the answers come."""

    def __init__(self, texts: Texts, flags: pd.DataFrame, bits: int):
        chosen, hot = _flagged(texts, flags, bits)
        self.own, self.hot = chosen[~hot], chosen[hot]
        self.context, self.first, self.last = texts.contexts(self.own)
        one, inverse = _distinct(self.context, self.first, self.last)
        least = _least_docs(len(one), inverse, texts.doc[self.own])
        bucket = (texts.hash[self.own][one] >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        #: By distinct context, sorted by bucket: a row that has it, its least doc, its bucket; and each row's number among them.
        self.one, self.least, self.bucket, self.inverse = one[order], least[order], bucket[order], place[inverse]

    def hot_windows(self, texts: Texts, bits: int) -> None:
        """Of hot anchors the distinct windows, sorted: both digits, bucket, least doc; and of all windows their number and place."""
        context, first, last = texts.contexts(self.hot)
        d1, d2, row, place = _windows(context, first, last)
        order = np.lexsort((d2, d1))
        new = np.ones(len(order), bool)
        new[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
        self.window = np.empty(len(order), np.int64)
        self.window[order] = np.cumsum(new) - 1
        self.d1, self.d2 = d1[order][new], d2[order][new]
        self.window_bucket = (self.d1 >> np.uint64(64 - bits)).astype(np.int64)
        self.window_least = _least_docs(len(self.d1), self.window, texts.doc[self.hot[row]])
        self.window_at = texts.at[self.hot[row]] - (WINDOW - GRAM) + place


def send_contexts(rows: pd.DataFrame, flags: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A block's distinct contexts by anchor bucket, or distinct windows by window bucket for hot anchors."""
    if not len(rows) or not len(flags):
        return _rows([])
    texts, block, out = Texts(rows), int(rows["block"].iloc[0]), []
    sent = Sent(texts, flags, bits)
    for b, s in _runs(sent.bucket):
        pick = sent.one[s]
        out.append((b, block, 0, sent.context[pick].tobytes(), np.stack([sent.first[pick], sent.last[pick]], axis=1).tobytes(), sent.least[s].tobytes()))
    sent.hot_windows(texts, bits)
    for b, s in _runs(sent.window_bucket):
        out.append((b, block, 1, sent.d1[s].tobytes(), sent.d2[s].tobytes(), sent.window_least[s].tobytes()))
    return _trimmed(_rows(out))


def sorted_windows(context: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A bit mask of each context's windows that an equal window of a smaller doc precedes, by digit passes over their bytes."""
    k = np.arange(WINDOW - GRAM + 1)
    row, place = np.nonzero((k >= first[:, None]) & (k <= last[:, None]))
    digits = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(context, 8, axis=1)).view(">u8")[..., 0].astype(np.uint64)
    offsets = [*range(0, WINDOW - 8, 8), WINDOW - 8]
    masks = np.zeros(len(context), np.uint32)
    live, group = np.arange(len(row)), np.zeros(len(row), np.uint64)
    for n, offset in enumerate(offsets):
        digit = digits[row[live], place[live] + offset]
        # Groups are numbered in 32 bits, so that half a digit fits beside the number.
        for shift in (0,) if n == 0 else (32, 0):
            value = digit if n == 0 else group << np.uint64(32) | digit >> np.uint64(shift) & np.uint64(0xFFFFFFFF)
            order = np.argsort(value)
            live, value, digit = live[order], value[order], digit[order]
            start = np.ones(len(live), bool)
            start[1:] = value[1:] != value[:-1]
            size = np.diff(np.append(np.flatnonzero(start), len(live)))
            several = np.repeat(size > 1, size)
            live, digit, start = live[several], digit[several], start[several]
            group = (np.cumsum(start) - 1).astype(np.uint64)
        if not len(live):
            break
        starts = np.flatnonzero(start)
        head, same = live[starts][group.astype(np.int64)], np.ones(len(live), bool)
        for later in offsets[n + 1 :]:
            same &= digits[row[live], place[live] + later] == digits[row[head], place[head] + later]
        equal = np.logical_and.reduceat(same, starts)
        least = np.minimum.reduceat(doc[row[live]], starts)
        g = group.astype(np.int64)
        found = live[equal[g] & (doc[row[live]] > least[g])]
        np.bitwise_or.at(masks, row[found], np.uint32(1) << place[found].astype(np.uint32))
        live, g = live[~equal[g]], g[~equal[g]]
        group = (np.cumsum(np.diff(g, prepend=-1) != 0) - 1).astype(np.uint64)
    return masks


def radix(d1: np.ndarray, d2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each window (two digits) has an equal one of a smaller doc, by most-significant-digit passes."""
    later = np.zeros(len(d1), bool)
    live, group = np.arange(len(d1)), np.zeros(len(d1), np.uint64)
    # After the first digit, groups are numbered in 32 bits, and half a digit fits beside the number.
    for digit in (d1, d2 >> np.uint64(32), d2 & np.uint64(0xFFFFFFFF)):
        value = digit[live] if digit is d1 else group << np.uint64(32) | digit[live]
        order = np.argsort(value)
        live, value = live[order], value[order]
        start = np.ones(len(live), bool)
        start[1:] = value[1:] != value[:-1]
        size = np.diff(np.append(np.flatnonzero(start), len(live)))
        several = np.repeat(size > 1, size)
        live, group = live[several], (np.cumsum(start) - 1)[several].astype(np.uint64)
    group = group.astype(np.int64)
    if len(live):
        least = np.full(int(group.max()) + 1, LAST, np.int64)
        np.minimum.at(least, group, doc[live])
        later[live] = doc[live] > least[group]
    return later


def _by_anchor(context: np.ndarray):  # noqa: ANN202
    """The rows of a bucket in parts of about SLICE that keep the contexts of an anchor together.

    Equal windows have the same anchor, so parts are sorted one after the other; an anchor has HOT
    contexts at most.
    """
    reach, anchor = WINDOW - GRAM, np.zeros(len(context), np.uint64)
    for i in range(0, len(context), SLICE):
        anchor[i : i + SLICE] = grams(context[i : i + SLICE, reach : reach + GRAM], GRAM)[:, 0]
    order = np.argsort(anchor, kind="stable")
    cuts = np.concatenate([np.flatnonzero(np.diff(anchor[order])) + 1, [len(order)]])
    start = 0
    while start < len(order):
        end = cuts[min(np.searchsorted(cuts, start + SLICE), len(cuts) - 1)]
        yield order[start:end]
        start = end


def sort_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each row of a bucket the places of contexts with windows that an earlier document has, and their masks (of hot windows, 1)."""
    out = []
    for kind, own in rows.groupby("kind"):
        sizes = [len(c) // 8 for c in own["c"]]
        doc = np.frombuffer(b"".join(own["c"]), np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if kind == 0:
            context = np.frombuffer(b"".join(own["a"]), np.uint8).reshape(len(doc), -1)
            first, last = np.frombuffer(b"".join(own["b"]), np.uint8).reshape(-1, 2).T
            result = np.zeros(len(doc), np.uint32)
            for part in _by_anchor(context):
                result[part] = sorted_windows(context[part], first[part], last[part], doc[part])
        else:
            d1 = np.frombuffer(b"".join(own["a"]), np.uint64)
            d2 = np.frombuffer(b"".join(own["b"]), np.uint64)
            result = radix(d1, d2, doc).astype(np.uint32)
        for bucket, block, a, b in zip(own["bucket"], own["block"], bounds[:-1], bounds[1:]):
            told = np.flatnonzero(result[a:b]).astype(np.uint32)
            if len(told):
                out.append((bucket, block, 1 + kind, told.tobytes(), result[a:b][told].tobytes(), None))
    return _trimmed(_rows(out))


def _answers(flags: pd.DataFrame, kind: int, bucket: np.ndarray) -> np.ndarray:
    """The answer to each thing that was sent, 0 where there is none; ``bucket``: theirs, sorted."""
    result = np.zeros(len(bucket), np.uint32)
    own = flags[flags["kind"] == kind]
    for b, a, v in zip(own["bucket"], own["a"], own["b"]):
        result[np.searchsorted(bucket, b) + np.frombuffer(a, np.uint32).astype(np.int64)] = np.frombuffer(v, np.uint32)
    return result


def remove(rows: pd.DataFrame, flags: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A block's documents without the bytes of windows that an earlier document has."""
    if not len(rows):
        return pd.DataFrame({"doc_id": [], "n_bytes": [], "starts": [], "ends": [], "kept": []})
    texts = Texts(rows)
    n = len(texts.bytes)
    edges = np.zeros(n + 1, np.int32)
    sent = Sent(texts, flags[flags["kind"] == 0], bits)
    covered = [np.zeros(0, np.int64)]
    own, first, last = sent.own, sent.first, sent.last
    if len(own):
        mask = _answers(flags, 1, sent.bucket)[sent.inverse]
        mask = np.where(texts.doc[own] > sent.least[sent.inverse], np.uint32(0xFFFFFFFF), mask)
        del sent.context
        k = np.arange(WINDOW - GRAM + 1)
        for i in range(0, len(own), SLICE):
            part = slice(i, i + SLICE)
            row, place = np.nonzero((mask[part, None] >> k.astype(np.uint32) & 1 > 0) & (k >= first[part, None]) & (k <= last[part, None]))
            covered.append(texts.at[own[part][row]] - (WINDOW - GRAM) + place)
    if len(sent.hot):
        sent.hot_windows(texts, bits)
        later = _answers(flags, 2, sent.window_bucket)[sent.window] > 0
        doc = texts.doc_id[np.searchsorted(texts.start, sent.window_at, side="right") - 1]
        covered.append(sent.window_at[later | (doc > sent.window_least[sent.window])])
    for at in covered:
        np.add.at(edges, at, 1)
        np.add.at(edges, at + WINDOW, -1)
    gone = np.cumsum(edges[:n], dtype=np.int32) > 0
    out = []
    for i in range(len(texts.doc_id)):
        a, b = texts.start[i], texts.start[i + 1]
        mine, raw = gone[a:b], texts.bytes[a:b]
        turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
        out.append((texts.doc_id[i], b - a, turns[::2].astype(np.int32), turns[1::2].astype(np.int32), (raw[~mine] if len(turns) else raw).tobytes()))
    done = pd.DataFrame(out, columns=["doc_id", "n_bytes", "starts", "ends", "kept"])
    done["doc_id"] = done["doc_id"].astype("Int64").mask(texts.is_null)
    return _trimmed(done)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, starts, ends (removed byte runs), kept (remaining bytes).

    Each byte is removed that a WINDOW-byte string covers which also starts in a document of smaller doc_id;
    matches never cross documents, overlaps count, and strings are judged on the input. Nulls: a null text
    is empty, a row without doc_id comes after every other. Rows of one doc_id are no earlier than each other, so
    they lose nothing to each other. Texts shorter than the window lose nothing; an empty table gives no
    rows; very long texts are sorted whole; other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc_id"), F.col(key).isNull().alias("is_null"), whole_text(text).alias("text"))
    n_blocks = max(1, math.ceil(text_bytes(docs, text) / BLOCK_BYTES))
    bits = min(20, max(MIN_BITS, math.ceil(math.log2(2 * n_blocks))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_blocks)))
    digits = dealt.groupBy("block").applyInPandas(lambda g: first_digits(g, bits), _FLAGS)
    repeated = digits.groupBy("bucket").applyInPandas(repeated_digits, _FLAGS)
    by_block = dealt.groupBy("block")
    contexts = by_block.cogroup(repeated.groupBy("block")).applyInPandas(lambda g, f: send_contexts(g, f, bits), _FLAGS)
    answers = contexts.groupBy("bucket").applyInPandas(sort_bucket, _FLAGS)
    every = repeated.unionByName(answers)
    return by_block.cogroup(every.groupBy("block")).applyInPandas(lambda g, f: remove(g, f, bits), _KEPT)
