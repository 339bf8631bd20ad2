"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

#: UTF-8 bytes of text that one step of a Python worker holds at once; a longer text makes a step of its own. What a step
#: makes of its text is many times as large, and a worker keeps that memory for the next one.
SLICE_BYTES = 1 << 19
#: The same where a step's matrices or packing gain from more rows and what it makes of them is small.
LONG_SLICE_BYTES = 2 << 20


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """The one large object (vocabulary, memory of words) a Python worker keeps between tasks; one of another operator goes first."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


_WORDS = 150_000
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, 3)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit number for each word; a worker remembers a bounded number of words."""
    seen: dict[bytes, int] = held("word hashes", dict)
    if len(seen) > _WORDS:
        seen.clear()
    try:
        known = [seen[w] for w in words]
    except KeyError:
        for w in set(words):
            if w not in seen:
                seen[w] = xxhash.xxh64_intdigest(w)
        known = [seen[w] for w in words]
    return np.array(known, np.uint64)


def ngram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit number for the k words from each place on; n-grams of different lengths never mean the same."""
    if len(x) < k:
        return np.zeros(0, np.uint64)
    mixed = np.full(len(x) - k + 1, k, np.uint64)
    for i in range(k):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[0] + x[i : len(x) - k + 1 + i]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[1]
    return mixed ^ (mixed >> np.uint64(29))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SIGNS = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SIGNS[ord("A") : ord("Z") + 1] = _SIGNS[ord("a") : ord("z") + 1]
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes whose running sums are held at once; each worker keeps as many powers, of 16 bytes each, to its end.
_STEP = 1 << 17


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64, kept for the next call."""
    if len(_POWERS[0]) < n:
        size = max(n, _STEP)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, _UNDO)]
    return _POWERS


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word of all texts in turn, and for each text the place of its first word (one more at the end).

    Words: runs of bytes between ASCII white space, A-Z in lower case. A word's number is a polynomial of its bytes, read off
    running sums over many words at once, at the same cost for new words and known ones.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    word = ~_BLANK[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    fresh[1:] |= ~word
    starts = np.flatnonzero(word & fresh[:-1])
    fresh[:-1], fresh[-1] = ~word, True
    fresh[offsets] = True
    ends = np.flatnonzero(word & fresh[1:]) + 1
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + _STEP, "right")))
        power, undo = _powers(int(ends[stop - 1] - low) + 1)
        part = _SIGNS[data[low : ends[stop - 1]]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power[: len(part)])])
        out[at:stop] = (sums[ends[at:stop] - low] - sums[starts[at:stop] - low]) * undo[starts[at:stop] - low]
        at = stop
    out = (out ^ (out >> np.uint64(32))) * _ODD[1]
    return out ^ (out >> np.uint64(29)), np.searchsorted(starts, offsets)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession) -> None:
    """Make checkpoint() usable: the shared folder that spark.checkpoint.dir names; a temporary one in local mode alone."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="postlake-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows read from the shared checkpoint folder, so that a lost executor costs no recomputation."""
    shared(df.sparkSession)
    return df.checkpoint()


def measured(df: DataFrame) -> DataFrame:
    """As `cut`, for tables that a loop joins again and again. The optimiser takes a join to be as large as the product of its
    sides, and a checkpoint hands this number on, with twice the digits each time; a cached table knows its real size."""
    kept = df.persist(StorageLevel.DISK_ONLY)
    kept.count()
    done = cut(kept)
    kept.unpersist()
    return done


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo: the published split of held-out rows."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def slices(batches: Iterable[pa.RecordBatch], text_at: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces balanced by the bytes of one text column."""
    for batch in batches:
        start, held = 0, 0
        sizes = batch.column(text_at).cast(pa.large_string()) if batch.num_rows else []
        for i, n in enumerate(pa.compute.binary_length(sizes).to_pylist() if batch.num_rows else []):
            if held and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)


def spread(left: DataFrame, right: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """left joined with right, where the rows of right that are `hot` are broadcast and only the keys of the others shuffled.

    The caller sees to it that few rows of right can be hot: say, keys of over 1/4096 of all rows of left.
    """
    few = F.broadcast(right.where(hot))
    rest = left.join(few.select(*on), on, "left_anti")
    return left.join(few, on).unionByName(rest.join(right.where(~hot), on))


def width(df: DataFrame) -> Column:
    """About how many bytes a row holds."""
    of = lambda f: F.octet_length(f.name) if isinstance(f.dataType, (StringType, BinaryType)) else F.octet_length(F.to_json(f.name)) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.lit(8)
    return reduce(Column.__add__, (F.coalesce(of(f), F.lit(0)).cast("long") for f in df.schema))


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", most: int = 200_000, parts: int = 4096, most_bytes: int = 32 << 20) -> DataFrame:
    """left joined with right (cut, without null keys), whatever one key holds of left.

    Up to `most` rows of right of `most_bytes` together are broadcast. Beyond, keys that hold over 1/parts of left's rows, `parts` at most, are joined
    by broadcast, the others by shuffle. `how`: inner, left, left_semi or left_anti. Rows of left with a null key match nothing.
    """
    held = right.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width(right)).alias("bytes")).first()
    if held["n"] <= most and (held["bytes"] or 0) <= most_bytes:
        return left.join(F.broadcast(right), on, how)
    whole = left.dropna(subset=on)
    heavy = cut(whole.groupBy(*on).count().where(F.col("count") * parts > whole.count()).select(*on))
    few, key = F.broadcast(heavy), [F.col(c).isNull() for c in on]
    out = whole.join(few, on, "left_semi").join(F.broadcast(right.join(few, on, "left_semi")), on, how)
    out = out.unionByName(whole.join(few, on, "left_anti").join(right.join(few, on, "left_anti"), on, how))
    if how in ("left", "left_anti"):
        out = out.unionByName(left.where(reduce(Column.__or__, key)), allowMissingColumns=True)
    return out


def without(docs: DataFrame, id_col: str, dropped: DataFrame, most: int = 200_000) -> DataFrame:
    """docs without the rows whose id is in `dropped` (one column, cut). Up to `most` ids are broadcast, more are joined by shuffle."""
    return lookup(docs, dropped.toDF(id_col), [id_col], "left_anti", most).select(docs.columns)


def rewrite(docs: DataFrame, text_col: str, change) -> DataFrame:
    """The rows, batch by batch in Arrow, with all columns: `change` maps a batch and its texts to a batch of the same schema."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, at):
            yield change(piece, piece.column(at).to_pylist())

    return docs.mapInArrow(run, docs.schema)
