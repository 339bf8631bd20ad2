"""Quality classifier: logistic regression over hashed word n-grams, learned by follow-the-regularised-leader.

Words are runs of letters, of digits, of other signs. A text is a sparse vector of its hashed words and word pairs,
and its score one dot product with the learned weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, remainder, rewrite, slices

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_KEEP = 150_000


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers below 2**bits, and their values: the square root of a feature's share of all.

    Features are words, pairs of words, pairs of the words' shapes, and for pairs whether both are one word. Number 0
    is the bias, always there with value 1.
    """
    words = _WORD.findall(text) if text else []
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    seen: dict[str, int] = held("quality words", dict)
    if len(seen) > _KEEP:
        seen.clear()
    try:
        known = [seen[w] for w in words]
    except KeyError:
        for w in set(words):
            if w not in seen:
                seen[w] = zlib.crc32(w.encode()) << 3 | (0 if w.islower() else 1 if w.isupper() else 2 if w.istitle() else 3 if w.isdigit() else 4 if w.isalpha() else 5)
        known = [seen[w] for w in words]
    word = np.array(known, np.uint64)
    shape = np.where((word & np.uint64(7)) == np.uint64(5), word, word & np.uint64(7))  # signs count as they are
    left, right = slice(None, -1), slice(1, None)
    same = np.full(int((word[left] == word[right]).sum()), 3, np.uint64)
    mixed = np.concatenate([word + np.uint64(1), _mixed(word[left], word[right]) + np.uint64(2), _mixed(shape[left], shape[right]) + np.uint64(5), same])
    at, counts = np.unique((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits), return_counts=True)
    counts = counts[at > 0]
    return np.append(at[at > 0].astype(np.int64), 0), np.append(np.sqrt(counts / len(words)), 1.0)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(9))) * np.uint64(0xCA5A826395121157)


class Follower:
    """Follow-the-regularised-leader, one example at a time."""

    def __init__(self, bits: int = 18, alpha: float = 5.0, beta: float = 1.0, l1: float = 0.001, l2: float = 0.001):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        z, n = self.z[at], self.n[at]
        w = self._weights(z, n)
        g = (1 / (1 + np.exp(-w @ x)) - label) * x
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bits: int = 18, sample: int = 8192, epochs: int = 3) -> np.ndarray:
    """Weights learned from at most `sample` labelled rows, the ones with the least hash of their id; held-out rows give none.

    Only their feature numbers reach the driver. Of documents that share an id one teaches, the least by its features.
    Without labelled rows all weights are 0 (every score 0.5).
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)").where(remainder("id", 5) != 0).distinct()
        .orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found = [features(t, bits) for t in piece.column(1).to_pylist()]
            at, x = (pa.array([f[i].astype(kind).tobytes() for f in found], pa.binary()) for i, kind in enumerate(("<i4", "<f4")))
            yield pa.RecordBatch.from_arrays([piece.column(0), at, x, piece.column(2)], names=["id", "at", "x", "label"])

    taught = texts.join(F.broadcast(chosen), "id").select("id", "text", "label").mapInArrow(run, f"id {kind}, at binary, x binary, label int")
    rows = taught.groupBy("id", "label").agg(F.min(F.struct("at", "x")).alias("f")).select("id", "f.at", "f.x", "label").toArrow()
    ids, labelled, at, x = (rows.column(c).combine_chunks() for c in ("id", "label", "at", "x"))
    names = [str(i) for i in ids.to_pylist()]
    order = sorted(range(len(names)), key=lambda i: (zlib.crc32(names[i].encode()), names[i], labelled[i].as_py(), at[i].as_py()))
    part = lambda column, i, kind: np.frombuffer(column[i].as_buffer(), kind)
    model = Follower(bits)
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(order)):
            i = order[k]
            model.learn(part(at, i, "<i4"), part(x, i, "<f4").astype(float), labelled[i].as_py())
    return model.weights()


def scores(texts: list[str | None], weights: np.ndarray, bits: int) -> np.ndarray:
    dots = np.array([weights[at] @ x for at, x in (features(t, bits) for t in texts)])
    return 1 / (1 + np.exp(-dots))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bits: int = 18, sample: int = 8192, least: float = 0.3) -> DataFrame:
    """Per row: id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= least).

    Learns from labelled rows that aren't held out (see `train`; `sample` bounds them); scores see the text alone.
    Null and empty texts get the score of the bias. Null labels and labels other than 0 and 1 teach nothing. Repeated
    rows are scored each; other columns are left out, whatever their names. An empty table gives an empty result.
    """
    weights = train(docs, labels, id_col, text_col, label_col, bits, sample)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(scores(piece.column(1).to_pylist(), weights, bits), pa.float64())], names=["id", "score"])

    kind = picked.schema["id"].dataType.simpleString()
    scored = picked.mapInArrow(run, f"id {kind}, score double")
    held = F.coalesce(remainder("id", 5) == 0, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def good_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bits: int = 18, sample: int = 8192, least: float = 0.3) -> DataFrame:
    """The rows that `quality_scores` predicts 1 for, with all columns, in one pass without a shuffle.

    Null and empty texts have the score of the bias; ids and labels may be null and teach nothing then. Repeated rows go or
    stay together; a score of exactly `least` stays.
    """
    weights = train(docs, labels, id_col, text_col, label_col, bits, sample)
    return rewrite(docs, text_col, lambda batch, texts: batch.filter(pa.array(scores(texts, weights, bits) >= least)))
