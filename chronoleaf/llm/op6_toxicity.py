"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, its pairs of
neighbouring words and its pairs with one word between, in 2^BITS slots; words
are lower-cased runs of letters and digits.  A word also enters by its stems,
its first 3 to 6 bytes, so that rare forms share what is learned of their family.  Training is FTRL-proximal with a
learning rate per coordinate; its L1 term leaves a sparse weight vector, whose
size 2^BITS bounds what is broadcast.

The model is fitted on a bounded sample of labelled rows (SAMPLE_PER_CLASS of
each label, the least by a hash of the id).  All rows of the sample meet in one
training task, in an order fixed by that hash, so a retry learns the same
weights.  Scoring covers every whole text.  Only the text is an input of a score.

Defined results: null or empty text scores by the bias alone; with labels of
one kind or none every score is the prior; rows with null id are scored and
never learned from; a document with several label rows counts as toxic if any
says so; of rows with one id the least text is learned from; an empty table
gives no rows.  ``score_texts`` replaces columns named
like its own; other columns pass through.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm import words as W
from chronoleaf.llm.common import small_batches, table, without

BITS = 20
SAMPLE_PER_CLASS = 4000   # most labelled rows of either label that training reads
EPOCHS = 8
STEMS = (3, 4, 5, 6)       # bytes
_MASK = np.uint64((1 << BITS) - 1)
_LOWER = bytes(range(256)).lower()


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)


def features(text: str | None) -> np.ndarray:
    """Distinct slots of a text; slot 0 is the bias."""
    buf = (text or "").encode("utf-8", "replace").translate(_LOWER)
    slots, _ = _slots([buf])
    return np.unique(np.append(slots, 0)).astype(np.int32)


def _slots(bufs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all stems and n-grams of a batch, and the text that each comes from."""
    buf = b"\n".join(bufs)
    start, end = W.spans(buf, W.ALNUM_SEPARATED)
    h = W.word_hashes(buf, start, end)
    doc = W.owners(np.array([len(b) for b in bufs]), start)
    grams, owner, view = [h], [doc], W.lanes(buf)
    for n in STEMS:
        longer = end - start > n
        grams.append(W.prefix_hashes(view, start[longer], n))
        owner.append(doc[longer])
    for gap in (1, 2):
        same = doc[gap:] == doc[:-gap]
        grams.append(W.pair(h[:-gap] + np.uint64(gap), h[gap:])[same])
        owner.append(doc[gap:][same])
    slots = (np.concatenate(grams) & _MASK).astype(np.int64)
    return np.maximum(slots, 1), np.concatenate(owner)


def train(rows: Iterable[tuple[int, str | None]], model: Ftrl = Ftrl(), epochs: int = EPOCHS) -> np.ndarray:
    """Weights of FTRL-proximal over (label, text) rows, in the order given; zero if labels are of one kind."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    data = [(y, features(text)) for y, text in rows]       # of a text only its slots are kept
    if len({y for y, _ in data}) < 2:
        return z
    for _ in range(epochs):
        for y, at in data:
            w = model.weights(z[at], n[at])
            g = _sigmoid(w.sum()) - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / model.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return model.weights(z, n)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
        trainer: Callable[[Iterable], np.ndarray] = train) -> np.ndarray:
    """Weights (2^BITS doubles, mostly zero) learned from a bounded sample of labelled documents."""
    small_batches(docs.sparkSession)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("h", F.xxhash64("doc_id", F.lit(6))))
    sample = None
    for y in (0, 1):                                       # at most 2 * per_class rows, so they may be broadcast
        own = known.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(per_class)
        sample = own if sample is None else sample.unionByName(own)
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("toxic", "h", "doc_id").agg(F.min("text").alias("text")))

    def learn(batches):
        w = trainer(row for pdf in batches for row in zip(pdf["toxic"], pdf["text"]))
        at = np.flatnonzero(w)
        yield pd.DataFrame({"w": [struct.pack("<I", len(at)) + at.astype("<i4").tobytes() + w[at].astype("<f8").tobytes()]})

    # one row back: the weights that are not zero, 12 bytes each, at most 12 MB
    found = rows.repartition(1).sortWithinPartitions("h", "doc_id", "text").mapInPandas(learn, "w binary").collect()
    w = np.zeros(1 << BITS)
    for r in found:
        n = struct.unpack_from("<I", r.w)[0]
        w[np.frombuffer(r.w, "<i4", n, 4)] = np.frombuffer(r.w, "<f8", n, 4 + 4 * n)
    return w


def score_texts(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (score >= 0.5) to every row."""
    small_batches(docs.sparkSession)
    at = np.flatnonzero(weights)
    sparse = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights[at].astype(np.float64)))
    dense: dict[str, np.ndarray] = {}

    @F.pandas_udf("double")
    def score(col: pd.Series) -> pd.Series:
        if not dense:
            dense["w"] = np.zeros(1 << BITS)
            dense["w"][sparse.value[0]] = sparse.value[1]
        w = dense["w"]
        total = np.full(len(col), w[0])
        bufs = [t.encode("utf-8", "replace").translate(_LOWER) for t in col]
        first = 0
        while first < len(bufs):                           # slices of bounded size
            last, size = first, 0
            while last < len(bufs) and (last == first or size < 2 << 20):
                size += len(bufs[last])
                last += 1
            slots, owner = _slots(bufs[first:last])
            some = w[slots] != 0
            if some.any():                                 # each distinct feature of a text counts once
                both = np.unique((owner[some] << BITS) | slots[some])
                np.add.at(total, first + (both >> BITS), w[both & int(_MASK)])
            first = last
        return pd.Series(_sigmoid(total))

    scored = without(docs, "score", "predicted").withColumn("score", score(F.coalesce(F.col(text_col), F.lit(""))))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs, weights)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
