"""Benchmark decontamination: rare n-gram seeds join documents to test items, Smith-Waterman alignment scores them.

1. The n-grams of the items go into a Bloom filter of bounded size. One scan of the corpus hashes the n-grams of every
   text and keeps those that pass; how many documents hold each is counted from these.
2. Each item keeps its rare n-grams as seeds, and of every few in a row the rarest, so that no stretch of it is without.
3. Seeds join the kept n-grams; each pair of a document and an item says where in the document to look. A second scan
   picks the documents concerned, and the stretches are aligned word by word with the items, so that edited and
   paraphrased copies score in proportion to what they share in order.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, lookup, ngram_hashes, slices, without, word_hashes

_BREAKS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def words(text: str | None) -> list[bytes]:
    """Lower-case words, free of ASCII punctuation."""
    return text.lower().encode().translate(_BREAKS).split() if text else []


class Filter:
    """Bloom filter of n-gram hashes: two bits each of 2**bits, in 64-bit words."""

    def __init__(self, bits: int, held: np.ndarray | None = None):
        self.shift, self.held = np.uint64(64 - bits), held

    def places(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return grams >> self.shift, (grams * _SPREAD) >> self.shift

    def passes(self, grams: np.ndarray) -> np.ndarray:
        one = np.ones(len(grams), bool)
        for at in self.places(grams):
            one &= (self.held[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return one


def align(item: np.ndarray, text: np.ndarray, match: int = 2, miss: int = -1, gap: int = -1) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: (best score, start, end) of the aligned stretch of `text`; ties to the earliest end."""
    m = len(text)
    step = -gap * np.arange(m + 1)
    above, begun = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for code in item:
        diagonal = above[:-1] + np.where(text == code, match, miss)
        score, start = above + gap, begun.copy()
        take = diagonal >= score[1:]
        score[1:][take], start[1:][take] = diagonal[take], begun[:-1][take]
        fresh = score <= 0
        score[fresh], start[fresh] = 0, np.arange(m + 1)[fresh]
        # a gap in the item carries the best score of the left, less its length
        lifted = score + step
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(m + 1), 0))
        above, begun = top - step, start[source]
        if above.max() > best[0]:
            end = int(above.argmax())
            best = (int(above[end]), int(begun[end]), end)
    return best


def _stretches(starts: list[int], length: int, end: int, pad: int) -> list[tuple[int, int]]:
    """Disjoint stretches of a text of `end` words that hold an item which begins near any of the places."""
    out: list[tuple[int, int]] = []
    for start in sorted(starts):
        low, high = max(0, start - pad), min(end, start + length + pad)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        elif low < high:
            out.append((low, high))
    return out


def aligned(text: list[bytes], item: list[bytes]) -> tuple[float, int, int]:
    """(score, first word, end word) of the item's best alignment in a stretch of text."""
    codes: dict[bytes, int] = {}
    wanted = np.array([codes.setdefault(w, len(codes)) for w in item], np.int64)
    score, first, end = align(wanted, np.array([codes.get(w, -1) for w in text], np.int64))
    return score / (2 * len(item)), first, end


def _seeds(grams: DataFrame, frequency: DataFrame, rows: int, part: float, span: int) -> DataFrame:
    """(gram, number, at) of the n-grams that seed their items.

    All but those common in the corpus and, too, for their item: what over 50 documents and over `part` of all hold, and over
    twice the median of the item's n-grams that occur at all. Besides, of every `span` in a row the rarest that occurs.
    """
    item = Window.partitionBy("number")
    met = grams.join(frequency, "gram").withColumn("usual", F.median("docs").over(item))  # what occurs nowhere finds nothing
    ahead = item.orderBy("at").rangeBetween(0, span - 1)
    ranked = cut(met.withColumn("rarest", F.min(F.struct("docs", "at")).over(ahead)))
    rare = ranked.where(F.col("docs") <= F.greatest(F.lit(50.0), F.lit(part * rows), 2 * F.col("usual"))).select("number", "at")
    chosen = rare.union(ranked.select("number", "rarest.at")).distinct()
    return ranked.join(chosen, ["number", "at"]).select("gram", "number", "at")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 3, common: float = 1e-4, span: int = 4, least: float = 0.4, pad: int = 16, most_bits: int = 27) -> DataFrame:
    """One row per document row and item it holds: id, item id, score, first_word, end_word.

    The score is the best local alignment's (2 a shared word, -1 a changed, added or left out one) over that of the
    whole item; rows have `least` or more. Equal alignments: the earliest stretch. Words are lower-case, without ASCII
    punctuation. Null and empty texts hold nothing; an item of fewer than `n` words is found where all of them stand in a
    row, one without words nowhere. Repeated document rows, and repeated items, are reported each; other columns are left
    out, whatever their names. Empty tables give an empty result. `common`, `span`: see `_seeds`; an item is found by any
    `span` + n - 1 words of it in a row. 2**most_bits bits bound the filter that is broadcast; a fuller one lets more pass
    to the join, but loses nothing.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64(F.col("id").cast("string"), "text"))
    wanted = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    # copies of one text are one item until their ids are joined back
    texts = cut(wanted.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select(F.monotonically_increasing_id().alias("number"), "text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            numbers, ats, grams, widths = [], [], [], []
            for number, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                x = word_hashes(words(text))
                if len(x):
                    g = ngram_hashes(x, min(n, len(x)))
                    numbers.append(np.full(len(g), number, np.int64))
                    ats.append(np.arange(len(g), dtype=np.int32))
                    grams.append(g.view(np.int64))
                    widths.append(np.full(len(g), min(n, len(x)), np.int32))
            if numbers:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (numbers, ats, grams, widths)], names=["number", "at", "gram", "width"])

    grams = cut(texts.mapInArrow(split, "number bigint, at int, gram bigint, width int"))
    known = grams.groupBy("width").agg(F.count_distinct("gram").alias("n")).collect()
    widths, total = [r["width"] for r in known], sum(r["n"] for r in known)
    bits = int(np.clip(np.ceil(np.log2(16 * total + 1)), 10, most_bits))
    empty = Filter(bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(empty.places(batch.column(0).to_numpy().view(np.uint64))))
            slot, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(slot):
                marks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(marks.view(np.int64))], names=["slot", "marks"])

    marked = grams.select("gram").mapInArrow(mark, "slot bigint, marks bigint").groupBy("slot").agg(F.bit_or("marks").alias("marks")).toArrow()
    held = np.zeros(1 << (bits - 6), np.uint64)
    held[marked.column("slot").to_numpy()] = marked.column("marks").to_numpy().view(np.uint64)
    full = Filter(bits, held)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            keys, ats, kept, firsts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                x = word_hashes(words(text))
                for width in widths:
                    g = ngram_hashes(x, width)
                    at = np.flatnonzero(full.passes(g))
                    if len(at):
                        first = np.zeros(len(at), bool)
                        first[np.unique(g[at], return_index=True)[1]] = True
                        keys.append(np.full(len(at), key, np.int64))
                        ats.append(at.astype(np.int32))
                        kept.append(g[at].view(np.int64))
                        firsts.append(first)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, ats, kept, firsts)], names=["key", "at", "gram", "first"])

    hits = cut(picked.select("key", "text").where("text is not null").mapInArrow(read, "key bigint, at int, gram bigint, first boolean"))
    frequency = hits.where("first").groupBy("gram").agg(F.count(F.lit(1)).alias("docs"))
    seeds = cut(_seeds(grams.select("number", "at", "gram"), frequency, picked.count(), common, span).withColumnRenamed("at", "place"))
    starts = lookup(hits.select("key", "gram", "at"), seeds, ["gram"]).groupBy("key", "number").agg(F.collect_set(F.col("at") - F.col("place")).alias("starts"))
    lengths = cut(grams.groupBy("number").agg((F.max("at") + F.first("width")).cast("int").alias("length")))
    asked = lookup(starts, lengths, ["number"])
    per_doc = cut(asked.groupBy("key").agg(F.collect_list(F.struct("number", "length", "starts")).alias("wanted")))
    concerned = cut(lookup(picked, per_doc.select("key"), ["key"], "left_semi").withColumn("row", F.monotonically_increasing_id()))

    def carve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            found: list[tuple] = []
            for row, text, places in zip(*(piece.column(c).to_pylist() for c in range(3)), strict=True):
                own = words(text)
                found += ((row, a["number"], low, b" ".join(own[low:high])) for a in places for low, high in _stretches(a["starts"], a["length"], len(own), pad))
            columns = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["row", "number", "low", "words"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, number, low, stretch, item in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                value, first, end = aligned(stretch.split(b" "), words(item))
                if value >= least:
                    found.append((row, number, value, low + first, low + end))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["row", "number", "score", "first_word", "end_word"])

    # texts of documents and of items meet as stretches alone
    stretches = cut(lookup(concerned.select("key", "row", "text"), per_doc, ["key"]).select("row", "text", "wanted").mapInArrow(carve, "row bigint, number bigint, low int, words binary"))
    both = lookup(stretches, texts.withColumnRenamed("text", "item"), ["number"]).select("row", "number", "low", "words", "item")
    found = both.mapInArrow(score, "row bigint, number bigint, score double, first_word bigint, end_word bigint")
    best = cut(found.groupBy("row", "number").agg(F.min(F.struct((-F.col("score")).alias("less"), "first_word", "end_word")).alias("b")).select("row", "number", (-F.col("b.less")).alias("score"), "b.first_word", "b.end_word"))
    held = lookup(best, cut(wanted.join(texts, "text").select("number", "item")), ["number"]).join(concerned.select("row", "id"), "row")
    return held.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score", "first_word", "end_word")


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_text_col: str = "text", least_words: int = 3, **settings) -> DataFrame:
    """The documents that hold no item; all columns, repeated rows and rows with a null id stay.

    Items of fewer than `least_words` words are no evidence that a document was made from them, and remove none.
    """
    telling = items.where(F.size(F.regexp_extract_all(F.col(item_text_col), F.lit(r"[^\s\p{Punct}]+"), F.lit(0))) >= least_words)
    leaks = cut(contaminated(docs, telling, id_col=id_col, item_text_col=item_text_col, **settings).select(id_col).where(F.col(id_col).isNotNull()).distinct())
    return without(docs, id_col, leaks)
