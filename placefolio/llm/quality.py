"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are hashed 1- and 2-grams of the words, and 1- to 3-grams of their shapes (case, digits, marks at both ends), which
also say something about words never seen. Values are log counts, scaled to length 1. The training documents are a bounded
sample of the labelled rows (``MAX_TRAIN``, smallest in a seeded order). Their features are computed in parallel and pass
once through one task, as the updates need an order; the model is one array of ``2**BITS`` weights. Every document is
scored where it is read, as a sparse dot product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from placefolio.llm.common import fold
from placefolio.llm.words import Words, inside_document, mix, one_array, slices, windows, words
from placefolio.session import staged

BITS = 18
MAX_TRAIN = 12_000
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20
# FTRL-proximal: learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
SEED = 17

_KIND = np.zeros(256, np.uint64)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[128:] = 4
_MARKS = np.flatnonzero(_KIND == 0)
_KIND[_MARKS] = _MARKS.astype(np.uint64) + 10


def _shapes(w: Words) -> np.ndarray:
    """One number per word for its first and last two bytes' kinds, whether it is all upper case, and its length class."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    length = w.end - w.start
    first, last = _KIND[w.buffer[w.start]], _KIND[w.buffer[w.end - 1]]
    before = np.where(length > 1, _KIND[w.buffer[np.maximum(w.end - 2, 0)]], 0).astype(np.uint64)
    upper = np.concatenate([[0], np.cumsum((w.buffer >= 65) & (w.buffer <= 90))])
    lower = np.concatenate([[0], np.cumsum((w.buffer >= 97) & (w.buffer <= 122))])
    shout = (upper[w.end] - upper[w.start] > 1) & (lower[w.end] == lower[w.start])
    size = np.minimum(np.log2(length), 7).astype(np.uint64)
    return mix(mix(first * np.uint64(512) + last, before), size * np.uint64(2) + shout.astype(np.uint64), 3)


def features(texts: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Indexes and values of each text; a text without words has the bias (index 0) alone."""
    w = words(texts)
    n = 1 << bits
    plain, shape = w.hashes(), _shapes(w)
    doc = w.document()
    ids = []
    for source, most, seed in ((plain, 2, 21), (shape, 3, 31)):
        for k in range(1, most + 1):
            fits = inside_document(w, k)
            ids.append((doc[fits] << bits) | (windows(source, k, seed + k)[fits] >> np.uint64(64 - bits)).astype(np.int64))
    keys, counts = np.unique(np.concatenate(ids), return_counts=True)
    ends = np.searchsorted(keys, np.arange(len(w.first)) << bits)
    out = []
    for a, b in zip(ends.tolist(), ends.tolist()[1:]):
        index = np.maximum((keys[a:b] & (n - 1)).astype(np.int32), 1)
        value = np.log1p(counts[a:b])
        norm = math.sqrt(float(value @ value)) or 1.0
        out.append((np.append(index, 0).astype(np.int32), np.append(value / norm, 1.0).astype(np.float32)))
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            rows = features(one_array(part["text"]))
            yield pa.RecordBatch.from_arrays([
                one_array(part["turn"]), one_array(part["label"]), pa.array([i.tobytes() for i, _ in rows], pa.binary()),
                pa.array([v.tobytes() for _, v in rows], pa.binary())], ["turn", "label", "index", "value"])


class Ftrl:
    """FTRL-proximal for logistic loss with per-coordinate rates."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        # Two n-grams of a text may share an index.
        w = self.weights(index)
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ value)))))
        g = (p - label) * value
        s = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += g - s * w
        self.n[index] += g * g


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, seen = Ftrl(), 0
    for batch in batches:
        for label, index, value in zip(batch["label"].to_pylist(), batch["index"].to_pylist(), batch["value"].to_pylist()):
            model.learn(np.frombuffer(index, np.int32), np.frombuffer(value, np.float32).astype(np.float64), label)
            seen += 1
    yield pa.RecordBatch.from_pydict({"seen": pa.array([seen], pa.int64()), "weights": pa.array(
        [model.weights().astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights learned from ``labels`` (columns ``doc_id, quality``) on at most ``max_train`` of their documents.

    Labels that are null or neither 0 nor 1 are left out; of several labels of a document the smallest counts. Without
    labels all weights are 0, and every score is 0.5.
    """
    turn = F.xxhash64(F.lit(SEED), "label_id")
    wanted = (labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id"))
              .agg(F.min("quality").cast("int").alias("label")).withColumn("turn", turn)
              .orderBy("turn", "label_id").limit(max_train))
    # At most max_train rows of three numbers.
    rows = (docs.select(F.col(doc_id).alias("label_id"), F.col(text).alias("text"))
            .join(F.broadcast(wanted), "label_id").select("turn", "label", "text"))
    rows = staged(rows.mapInArrow(_featured, "turn long, label int, index binary, value binary"), "features")
    one = rows.repartition(1).sortWithinPartitions("turn", "label", "index")
    model = one.mapInArrow(_trained, "seen long, weights binary").first()
    if model is None:
        return np.zeros(1 << BITS, np.float32)
    return np.frombuffer(model["weights"], np.float32)


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score",
           keep_from: float | None = None) -> DataFrame:
    """``docs`` with the probability of label 1 in a new column; with ``keep_from`` only rows that reach it, without it.

    Null and empty texts are scored by the bias alone. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS floats

    def run(batches):
        w = shared.value.astype(np.float64)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                dots = np.array([w[i] @ v for i, v in features(one_array(part[text]))])
                p = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
                out = (part.append_column(score, pa.array(p)) if keep_from is None
                       else part.filter(pa.array(p >= keep_from)))
                yield from out.combine_chunks().to_batches()

    added = [T.StructField(score, T.DoubleType())] if keep_from is None else []
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5,
                    threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``. Documents of fold 0 are not learned from.

    Null and empty texts are scored by the bias alone; repeated rows are scored alike, and each is learned from if its id
    has a label. A null id is the empty text to the fold and never has a label. A score equal to ``threshold`` is predicted
    as 1. An empty table gives no rows, and without usable labels every score is 0.5.
    """
    weights = train(docs, labels.where(fold("doc_id", folds) != 0), doc_id, text, max_train)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return scored(rows, weights).select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score",
                                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 5,
                     threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, with the same columns; see :func:`score_documents`."""
    weights = train(docs, labels.where(fold("doc_id", folds) != 0), doc_id, text, max_train)
    return scored(docs, weights, text, keep_from=threshold)
