"""Secret scans: fixed patterns plus dictionary-primed zstandard novelty.

The base patterns find assignments, access keys and long hexadecimal runs. The novelty scan looks at
strings in a sensitive context (after words such as ``bearer`` or ``private key``): a compressor primed
with a dictionary of identifiers and common words compresses the surrounding code alone and with the
candidate; the bytes the candidate adds, against its own length or against what a random string of its own
alphabet and length adds there, are its novelty. The surroundings are the AROUND characters before and after the
whole candidate, without copies of it, so that a secret written twice is as novel as one written once. Words, paths and identifiers are mostly matched by the
dictionary or their surroundings; secrets add nearly all their bytes, or, where the alphabet is small, nearly
as many as a random string.

One pass over the texts; nothing is shuffled.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, whole_text

KINDS = ["assign", "access", "hex", "novel"]
# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_MIN = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # as [0-9a-f]+ of 24 and more: a run shorter than that has no such part
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: Sensitive context, then the candidate itself as the group.
CONTEXT_WORDS = ("auth", "bearer", "credential", "private", "access", "pwd", "passphrase", "signature", "session", "cookie", "key", "secret", "token", "passw")
CONTEXT = re.compile(
    r"""(?:auth(?:orization)?|bearer|credentials?|private[_ -]?key|access[_ -]?key(?:[_ -]?id)?|(?:client|shared)[_ -]?secret|secret|pwd|passwd|password|passphrase|signature|session(?:[_ -]?id)?|cookie|token|(?<![a-z])key)"""
    r"""["']?[\x20\t]*(?:[:=]|=>|is\b)?[\x20\t]*["'(]?(?:(?:bearer|basic|digest|negotiate|token)(?:[\x20\t]+|(?=["'(])))?["'(]?([A-Za-z0-9+/_=~.-]{16,})""",
    re.IGNORECASE | re.ASCII,
)
#: Characters of surrounding code on either side of a candidate.
AROUND = 160
#: Longer candidates are compressed in pieces of this many characters at most; a novel piece makes the whole one novel.
PIECE = 256
NOVELTY = 0.8
#: So much of what a random string of the same alphabet adds is as novel as NOVELTY bytes a character.
RANDOM = 0.92
#: Identifiers and words of code and prose that candidates are often made of.
DICTIONARY = " ".join(
    "password passwd secret token api_key apikey authorization bearer credential private_key public_key access_key session_id cookie signature "
    "client_secret username email address user_name first_name last_name created_at updated_at description configuration environment production "
    "development staging default example localhost database connection string number boolean object function return import export const class "
    "public private static void self this none null true false undefined http https www com org net html json xml yaml config settings version "
    "release update delete insert select where from table index value values request response header content type application service server "
    "client manager handler controller provider factory builder abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "AUTHENTICATION ACCESS_TOKEN REFRESH_TOKEN SECRET_KEY PRIVATE_KEY BEGIN END RSA PRIVATE KEY CERTIFICATE xxxxxxxxxxxxxxxx ****************".split()
).encode()


def primed() -> zstandard.ZstdCompressor:
    """A compressor primed with the identifier dictionary."""
    raw = zstandard.ZstdCompressionDict(DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False)


#: Alphabets of keys, smallest first; a candidate's own is the first that holds its letters and digits.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = [DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", "234567" + LOWER, "234567" + LOWER.upper(), DIGITS + LOWER, DIGITS + LOWER.upper(), DIGITS + LOWER + LOWER.upper()]


def alphabet(candidate: str) -> str:
    """The alphabet that the candidate was made of: that of its letters and digits, and its own other characters."""
    own = set(candidate)
    signs = {c for c in own if not c.isalnum()}
    return next(a for a in ALPHABETS if own - signs <= set(a)) + "".join(sorted(signs))


@lru_cache(maxsize=4096)
def random_text(letters: str) -> str:
    """PIECE random characters of an alphabet, always the same."""
    return "".join(random.Random(letters).choices(letters, k=PIECE))


def novelty(candidate: str, before: str, after: str, compressor: zstandard.ZstdCompressor, letters: str | None = None) -> float:
    """Compressed bytes that the candidate adds to its surroundings, per byte of its own.

    A random string of the candidate's length and alphabet (``letters``) in its place adds less than a byte a
    character where the alphabet is small; RANDOM of that then stands for NOVELTY. A candidate has PIECE
    characters at most.
    """
    around = (after + "\n" + before).encode("utf-8", "replace")
    alone = len(compressor.compress(around))
    added = lambda x: len(compressor.compress(around + x.encode("utf-8", "replace"))) - alone
    most = added(random_text(letters or alphabet(candidate))[: len(candidate)])
    return added(candidate) / max(1, min(len(candidate), most * RANDOM / NOVELTY))


def pieces(candidate: str) -> list[str]:
    """The candidate in as few equal parts of PIECE characters or fewer as there can be."""
    n, k = len(candidate), -(-len(candidate) // PIECE)
    return [candidate[n * i // k : n * (i + 1) // k] for i in range(k)]


def around(surroundings: str, candidate: str) -> str:
    """The surroundings without the candidate's copies, whole ones or cut off at the edges (8 characters and more)."""
    out = surroundings.replace(candidate, " ")
    for n in range(min(len(out), len(candidate)) - 1, 7, -1):
        if out.startswith(candidate[-n:]):
            out = out[n:]
            break
    for n in range(min(len(out), len(candidate)) - 1, 7, -1):
        if out.endswith(candidate[:n]):
            out = out[:-n]
            break
    return out


def mixed(candidate: str) -> bool:
    """Letters and digits both, and at least 8 different characters."""
    return any(c.isdigit() for c in candidate) and any(c.isalpha() for c in candidate) and len(set(candidate)) >= 8


def covered(candidate: str, at: int, base: list[tuple[int, int, int]]) -> bool:
    """Whether base spans hold all letters and digits of the candidate that starts at ``at``."""
    done, end = at, at + len(candidate)
    for s, e in sorted((s, e) for s, _, e in base if s < end and at < e):
        if any(map(str.isalnum, candidate[done - at : max(s, done) - at])):
            return False
        done = max(done, e)
    return done > at and not any(map(str.isalnum, candidate[done - at :]))


def find(text: str, compressor: zstandard.ZstdCompressor, least: float = NOVELTY) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in code points, sorted; kind counts as in KINDS."""
    spans, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = list(spans)
    if any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            before, after = (around(x, m[1]) for x in (text[max(0, a - AROUND) : a], text[b : b + AROUND]))
            if mixed(m[1]) and not covered(m[1], a, base) and any(novelty(x, before, after, compressor, alphabet(m[1])) >= least for x in pieces(m[1])):
                spans.append((a, 3, b))
    return sorted(spans)


def secret_spans(texts: Column) -> Column:
    """array<struct<start, end, kind>> of each text's spans, by start and then kind."""

    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def scan(batch: pd.Series) -> pd.Series:
        compressor = primed()
        return pd.Series([[{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in find(t, compressor)] for t in batch])

    return scan(texts)


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, spans (code points, end exclusive), n_assign, n_access, n_hex, n_novel.

    Null and empty texts have no spans; very long texts are scanned whole; repeated rows give repeated
    results; an empty table gives no rows; other columns are ignored.
    """
    out = docs.select(F.col(key).alias("doc_id"), secret_spans(whole_text(text)).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return out.withColumns({f"n_{k}": count(k) for k in KINDS})


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` (overlapping spans by one).

    Null and empty texts stay as they are; very long texts are scanned whole; repeated rows and equal texts
    are changed alike; an empty table gives no rows; other columns keep their values, whatever their names.
    """

    @F.pandas_udf("string")
    def redact(batch: pd.Series) -> pd.Series:
        compressor = primed()
        return pd.Series([None if t is None else _redact(t, find(t, compressor), mark) for t in batch])

    return docs.select(*[redact(F.col(text).cast("string")).alias(c) if c == text else own for c, own in zip(docs.columns, own_columns(docs))])


def _redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, done = [], 0
    for start, _, end in spans:
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])
