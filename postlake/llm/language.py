"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of bytes. One gated recurrent layer reads each window forwards and one backwards; their
states give every position a distribution over languages, and a document's probabilities are the mean over its
positions. The network is trained in numpy by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_SLICE_BYTES, remainder, slices

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


class ByteBiGRU:
    """h' = n + z * (h - n); z, r = sigmoid(x + U h); n = tanh(x + r * (U h)). Byte 0 also pads windows."""

    def __init__(self, languages: int, hidden: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.hidden, self.p = hidden, {}
        for d in "fb":
            self.p[f"Eg{d}"] = rng.normal(0, 0.3, (256, 2 * hidden))  # by byte: update and reset gates
            self.p[f"En{d}"] = rng.normal(0, 0.3, (256, hidden))
            self.p[f"Ug{d}"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
            self.p[f"Un{d}"] = rng.normal(0, hidden**-0.5, (hidden, hidden))
            self.p[f"W{d}"] = rng.normal(0, hidden**-0.5, (hidden, languages))
        self.p["c"] = np.zeros(languages)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _read(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States for x (steps, windows) in its own direction: (steps, windows, hidden)."""
        eg, en, ug, un = (self.p[k + d] for k in ("Eg", "En", "Ug", "Un"))
        steps, windows, k = *x.shape, self.hidden
        states = np.empty((steps, windows, k), np.float32)
        h = np.zeros((windows, k), np.float32)
        a, u, b, s = (np.empty((windows, m), np.float32) for m in (2 * k, 2 * k, k, k))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            np.take(eg, x[t], axis=0, out=a, mode="clip")
            np.matmul(h, ug, out=u)
            a += u
            np.negative(a, out=a)
            np.exp(a, out=a)
            a += 1
            np.reciprocal(a, out=a)
            np.take(en, x[t], axis=0, out=b, mode="clip")
            np.matmul(h, un, out=s)
            if keep is not None:
                keep.append((t, h.copy(), a.copy(), s.copy()))
            s *= a[:, k:]
            b += s
            np.tanh(b, out=b)
            np.subtract(h, b, out=h)
            h *= a[:, :k]
            h += b
            states[t] = h
            if keep is not None:
                keep[-1] += (b.copy(),)
        return states

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """x (steps, windows) bytes -> (steps, windows, languages)."""
        out = self._read(x, "f") @ self.p["Wf"]
        out += self._read(x, "b") @ self.p["Wb"]
        out += self.p["c"]
        out -= out.max(axis=-1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=-1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over positions that aren't padding; y: language of each window."""
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._read(x, d, kept[d]) for d in "fb"}
        logits = states["f"] @ self.p["Wf"] + states["b"] @ self.p["Wb"] + self.p["c"]
        logits -= logits.max(axis=-1, keepdims=True)
        delta = np.exp(logits)
        delta /= delta.sum(axis=-1, keepdims=True)
        delta[:, np.arange(len(y)), y] -= 1
        real = x > 0
        delta *= real[:, :, None] / max(1, real.sum())
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["c"] = delta.sum(axis=(0, 1))
        k = self.hidden
        for d in "fb":
            g[f"W{d}"] = np.einsum("tbh,tbl->hl", states[d], delta)
            into = delta @ self.p[f"W{d}"].T
            carry = np.zeros_like(states[d][0])
            for t, h, a, s, n in reversed(kept[d]):
                dh = into[t] + carry
                z, r = a[:, :k], a[:, k:]
                dn = dh * (1 - z) * (1 - n * n)
                ds = dn * r
                dg = np.concatenate([dh * (h - n) * z * (1 - z), dn * s * r * (1 - r)], axis=1)
                np.add.at(g[f"En{d}"], x[t], dn)
                np.add.at(g[f"Eg{d}"], x[t], dg)
                g[f"Un{d}"] += h.T @ ds
                g[f"Ug{d}"] += h.T @ dg
                carry = dh * z + ds @ self.p[f"Un{d}"].T + dg @ self.p[f"Ug{d}"].T
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 260, size: int = 192, rate: float = 0.02, seed: int = 2) -> ByteBiGRU:
        """Adam over random batches in which every language weighs alike; x (windows, steps)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        of = [np.flatnonzero(y == c) for c in np.unique(y)]
        for step in range(1, steps + 1):
            at = np.concatenate([rng.choice(i, max(1, size // len(of))) for i in of])
            g = self.gradients(np.ascontiguousarray(x[at].T), y[at])
            now = rate * min(1, 4 * (1 - step / (steps + 1)))
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, width) bytes, the last window of a text padded by 0; the number of windows of each text."""
    counts = np.array([-(-len(t) // width) for t in texts], np.int64)
    flat = b"".join(t + bytes(c * width - len(t)) for t, c in zip(texts, counts.tolist(), strict=True))
    return np.frombuffer(flat, np.uint8).reshape(-1, width), counts


def pooled(net: ByteBiGRU, texts: list[bytes], languages: int, width: int, at_once: int = 2048) -> np.ndarray:
    """Mean probabilities over the positions of each text (rows of 0 for empty ones)."""
    x, counts = windows(texts, width)
    sums = np.zeros((len(x), languages + 1))
    for start in range(0, len(x), at_once):
        part = np.ascontiguousarray(x[start : start + at_once].T)
        probabilities, real = net.probabilities(part), (part > 0).astype(np.float32)
        sums[start : start + at_once, :languages] = np.einsum("tbl,tb->bl", probabilities, real)
        sums[start : start + at_once, languages] = real.sum(axis=0)
    of = np.repeat(np.arange(len(texts)), counts)
    total = np.stack([np.bincount(of, sums[:, c], len(texts)) for c in range(languages + 1)], axis=1)
    return total[:, :languages] / np.maximum(total[:, languages:], 1)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = 4096, width: int = 64, each: int = 8) -> tuple[list[str], ByteBiGRU | None]:
    """Languages and network, from about `sample` documents with a known language that aren't held out.

    Of each language about the same number of distinct rows is drawn by a hash of id and text (fewer, if it has fewer), and
    of each drawn text at most `each` windows of `width` bytes, evenly spaced over the whole text, reach the driver.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where("lang is not null and text is not null").where(remainder("id", 3) != 1)
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return [], None
    languages, want = sorted(sizes), max(1, sample // len(sizes))
    rates = docs.sparkSession.createDataFrame([(k, min(1.0, want / n)) for k, n in sizes.items()], "lang string, rate double")
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.join(F.broadcast(rates), "lang").where(draw < F.col("rate")).select("id", "text", "lang").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=LONG_SLICE_BYTES):
            cuts, langs = [], []
            for text, lang in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                x, _ = windows([text.encode()], width)
                for i in np.unique(np.linspace(0, len(x) - 1, each).astype(int)) if len(x) else ():
                    cuts.append(x[i].tobytes())
                    langs.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(cuts, pa.binary()), pa.array(langs, pa.string())], names=["bytes", "lang"])

    rows = sorted((r["lang"], bytes(r["bytes"])) for r in drawn.mapInArrow(run, "bytes binary, lang string").collect())
    if not rows:
        return [], None
    x = np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), width)
    return languages, ByteBiGRU(len(languages)).fit(x, np.array([languages.index(k) for k, _ in rows]))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 4096, width: int = 128) -> DataFrame:
    """Per row: id, held_out, lang_pred (a learned language, or `und`), score (the pooled probability; 0 for `und`).

    Learns from rows with a language that aren't held out (see `train`); predictions see the bytes of the whole text
    alone. A null text, and one without any letter (Unicode category L), is `und`, and so is every text where nothing could be learned.
    Equal probabilities go to the first language in order. Repeated rows are predicted each; other columns are left
    out, whatever their names. An empty table gives an empty result.
    """
    languages, net = train(docs, id_col, text_col, lang_col, sample)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=LONG_SLICE_BYTES):
            texts = piece.column(1).to_pylist()
            able = [net is not None and t is not None and _LETTER.search(t) is not None for t in texts]
            names, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            if any(able):
                mean = pooled(net, [t.encode() for t, ok in zip(texts, able, strict=True) if ok], len(languages), width)
                at = np.flatnonzero(able)
                names[at] = np.array(languages, object)[mean.argmax(axis=1)]
                scores[at] = np.clip(mean.max(axis=1), 0, 1)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(names.tolist(), pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    kind = picked.schema["id"].dataType.simpleString()
    predicted = picked.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    held = F.coalesce(remainder("id", 3) == 1, F.lit(False))
    return predicted.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")
