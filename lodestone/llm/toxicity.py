"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A linear model gives each sentence a probability, and noisy-or
combines them: ``p(doc) = 1 - prod(1 - p(sentence))``. The sentence model is trained from document labels
alone, by gradient descent through the noisy-or, so that the sentences that explain a label get the
weight; scored documents then show their offending sentences.

Training uses a bounded sample of labelled rows: ``max_train`` of them, the lowest by a hash of the key, and of
those, in the same order, as many as hold MAX_TRAIN_BYTES of text together, each of them whole. Scoring
covers every document, whole, in one pass without a shuffle. A sentence is the set of its words' features, in
training as in scoring. The model is a table of at most
``max_features`` words and word beginnings, which bounds what is broadcast.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, own_columns, whole_text

#: Labelled rows to train on at most, and the bytes of text that they hold together at most.
MAX_TRAIN = 8_000
MAX_TRAIN_BYTES = 64 << 20
MAX_FEATURES = 6_000
ROUNDS = 100
#: Numbers that features are hashed to, and lengths of the word beginnings, in bytes.
SPACE, PREFIXES = 1 << 20, (4, 5, 6)

#: Sentence ends become line feeds, other ASCII punctuation spaces; applied to lower-cased UTF-8.
_ENDS = b".!?\n\r"
FOLD = bytes(10 if i in _ENDS else 32 if i < 128 and not chr(i).isalnum() else i for i in range(256))


def sentences(text: str) -> list[list[bytes]]:
    """The words of each sentence that has any."""
    return [w for s in text.lower().encode("utf-8", "replace").translate(FOLD).split(b"\n") if (w := s.split())]


def features(word: bytes) -> tuple[int, ...]:
    """Hashed numbers of the word itself and of its beginnings, which inflected and derived forms share."""
    return (zlib.crc32(word) % SPACE, *(zlib.crc32(b"%d:%b" % (n, word[:n])) % SPACE for n in PREFIXES if len(word) > n))


class ByWord(dict):
    """A function of a word, kept for words seen before (a bounded number of them)."""

    def __init__(self, make, most: int = 200_000):  # noqa: ANN001
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: bytes):  # noqa: ANN204
        if len(self) >= self.most:
            self.clear()
        self[word] = found = self.make(word)
        return found


class SentenceModel:
    """Feature weights and a bias; the score of a sentence sums the weights of its distinct features."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known = ByWord(lambda w: tuple(f for f in features(w) if f in weights))

    def logit(self, sentence: list[bytes]) -> float:
        known, own = self.known, set()
        for word in sentence:
            if found := known[word]:
                own.update(found)
        return self.bias + sum(map(self.weights.__getitem__, own))


def choose_features(texts: list[str], labels: np.ndarray, most: int) -> np.ndarray:
    """The features whose presence tells most about the label: by G-test over documents, ties by number."""
    n, pos = len(texts), int(labels.sum())
    c, k = np.zeros(SPACE), np.zeros(SPACE)
    known = ByWord(features)
    for text, y in zip(texts, labels):
        own = list({f for s in sentences(text) for w in s for f in known[w]})
        c[own] += 1
        if y:
            k[own] += 1
    found = np.flatnonzero(c >= 3)
    c, k = c[found], k[found]
    cells = np.stack([k, c - k, pos - k, n - pos - c + k])
    expected = np.stack([c * pos, c * (n - pos), (n - c) * pos, (n - c) * (n - pos)]) / max(1, n)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.where(cells > 0, cells * np.log(cells / expected), 0).sum(axis=0)
    return found[np.argsort(-g, kind="stable")[:most]]


def train(texts: list[str], labels: list[int], max_features: int = MAX_FEATURES, rounds: int = ROUNDS, l2: float = 0.1) -> tuple[dict[int, float], float]:
    """Feature weights and bias of the sentence model, fitted through the noisy-or by Adam."""
    y = np.array(labels, float)
    chosen = choose_features(texts, y, max_features)
    place = np.full(SPACE, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    known = ByWord(lambda w: [i for f in features(w) if (i := int(place[f])) >= 0])
    found, found_sentence, sentence_doc = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for s in sentences(text):
            own = {i for w in s for i in known[w]}
            found.extend(own)
            found_sentence.extend([len(sentence_doc)] * len(own))
            sentence_doc.append(d)
    if not sentence_doc or not 0 < y.sum() < len(y):
        return {}, -20.0 if y.sum() * 2 < max(1, len(y)) else 20.0
    j, s, d = np.array(found), np.array(found_sentence), np.array(sentence_doc)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = np.log(y.mean() / max(1.0, len(d) / len(y)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(s, theta[j], len(d))
        total = np.bincount(d, np.logaddexp(0, z), len(y))
        slope = np.where(y > 0, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0)
        dz = slope[d] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(j, dz[s], len(chosen)) + l2 * theta[:-1], dz.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {int(x): float(t) for x, t in zip(chosen, theta)}, float(theta[-1])


def judged(text: str, model: SentenceModel) -> tuple[float, float, int, int, list[dict]]:
    """(document score, its highest sentence score, that sentence's number or -1, number of sentences of 0.5 and more, their numbers and scores)."""
    zs = [model.logit(s) for s in sentences(text)]
    if not zs:
        return 0.0, 0.0, -1, 0, []
    z = np.array(zs)
    p = -np.expm1(-np.logaddexp(0, z).sum())
    top = int(z.argmax())
    offending = [{"sentence": k, "score": float(1 / (1 + np.exp(-z[k])))} for k in np.flatnonzero(z >= 0).tolist()]
    return float(p), float(1 / (1 + np.exp(-z[top]))), top, len(offending), offending


def training_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, fold: int = 5, max_bytes: int = MAX_TRAIN_BYTES) -> tuple[list[str], list[int]]:
    """A bounded sample of labelled texts outside the held-out fold (crc32 of the key divides by ``fold``).

    The keys are chosen from the labels alone, so the join's small side has ``max_train`` rows at most.
    Labels that are null are no labels; of several rows of a key the highest label counts, and the shortest text.
    Texts are whole; the sample ends where they would hold more than ``max_bytes`` together.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_train)
    labelled = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    # max_train rows at most meet in this window; it sees sizes and hashes, and decides before texts are gathered.
    sizes = labelled.groupBy("doc_id", "order").agg(F.min(F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))).alias("one"))
    total = F.sum("one.size").over(W.orderBy("order", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow))
    within = sizes.select("doc_id", "one", total.alias("total")).where(F.col("total") <= max_bytes).select("doc_id", "one.size", "one.hash")
    rows = (
        labelled.join(F.broadcast(within), "doc_id").where((F.octet_length("text") == F.col("size")) & (F.xxhash64("text") == F.col("hash")))
        .groupBy("doc_id").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id").collect()
    )
    return [r.text for r in rows], [int(r.toxic > 0) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[dict[int, float], float]:
    """The sentence model learnt from ``labels``; without labels of both kinds it scores by the majority."""
    return train(*training_sample(docs, labels, max_train))


def toxicity(texts: Column, model: tuple[dict[int, float], float], spark) -> Column:  # noqa: ANN001
    """struct<score, worst_score, worst_sentence, n_offending, offending>: noisy-or and where it comes from.

    Null and empty texts score 0. Texts are scored whole; sentences are numbered from 0 among those
    with words (-1: none).
    """
    shared = spark.sparkContext.broadcast(model)

    def judge(batch: pd.Series) -> pd.DataFrame:
        own = SentenceModel(*shared.value)
        return pd.DataFrame([judged(t, own) for t in batch], columns=["score", "worst_score", "worst_sentence", "n_offending", "offending"])

    return F.pandas_udf(judge, "score double, worst_score double, worst_sentence int, n_offending int, offending array<struct<sentence:int,score:double>>")(texts)


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document: doc_id, score, worst_score, worst_sentence, n_offending, offending (sentence, score).

    Nothing but the text enters a score. Null or empty texts score 0; equal texts score equally; repeated
    rows give repeated results; empty tables give no rows; other columns are ignored.
    """
    model = fit(docs, labels, max_train)
    out = docs.select("doc_id", toxicity(whole_text(), model, docs.sparkSession).alias("t"))
    return out.select("doc_id", "t.*")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns, whatever their names.

    Null and empty texts score 0 and stay; repeated rows stay or go together; very long texts are scored
    whole; an empty table gives no rows; without labels of both kinds the majority decides.
    """
    model, name = fit(docs, labels), fresh("toxic")
    scored = docs.select(*own_columns(docs), toxicity(whole_text(), model, docs.sparkSession)["score"].alias(name))
    return scored.where(F.col(name) < threshold).drop(name)
