"""Near-duplicate documents by MinHash with banding, confirmed on full shingle sets.

1. Every text becomes a set of 64-bit shingle hashes, universal hash minima of it, and band keys of these. Texts with
   equal sets form one class, so copies cost no pairs.
2. Classes that share a band key meet in a bucket; each is confirmed against the bucket's least class on full sets, and
   components of these links are found by alternating large-star and small-star.
3. Buckets of three or more classes that still hold several components are the rest. Rounds come first in which the classes
   of a rare shingle meet only the most typical of about their size, so that a large group of near copies becomes one
   component at a cost that grows with its size. Then pairs still not connected that share one of their rarest shingles are
   compared by signature and on full sets. No bucket is capped; rounds change the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hashed_words, lookup, ngram_hashes, slices, spread, without
from .components import components, labelled
from .prefixes import confirmed, crossing, exact_rest, prefix, shared_tokens, shingle_counts, typical_round


def shingles(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles. Words: runs between ASCII white space, A-Z in lower case."""
    x, first = hashed_words(texts)
    grams = ngram_hashes(x, width)
    made = lambda a, b: np.unique(grams[a : b - width + 1]) if b - a >= width else ngram_hashes(x[a:b], b - a) if b > a else np.zeros(0, np.uint64)
    return [made(a, b) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


class MinHash:
    """bands * rows universal hashes h(x) = a * x + b modulo 2**32, a odd, of the upper halves of shingle hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def signature(self, items: np.ndarray, step: int = 512) -> np.ndarray:
        x = (items >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for start in range(0, len(x), step):
            h = np.multiply.outer(x[start : start + step], self.a)
            h += self.b
            np.minimum(least, h.min(axis=0), out=least)
        return least

    def keys(self, signature: np.ndarray) -> list[int]:
        return [xxhash.xxh64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(signature.reshape(self.bands, self.rows))]


def _described(docs: DataFrame, width: int, hashes: MinHash) -> DataFrame:
    """(id, n_shingles, set_key, keys); set_key and keys are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            n, set_keys, keys = [], [], []
            for items in shingles(piece.column(1), width):
                n.append(len(items))
                set_keys.append(xxhash.xxh128_digest(items.tobytes()) if len(items) else None)
                keys.append(hashes.keys(hashes.signature(items)) if len(items) else None)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(set_keys, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n_shingles", "set_key", "keys"])

    return docs.mapInArrow(run, "id bigint, n_shingles bigint, set_key binary, keys array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int, hashes: MinHash) -> DataFrame:
    """(class, items, signature) of the wanted classes (class, id, set_key), each from a text of that id."""
    chosen = lookup(docs, wanted, ["id"]).select("class", "text", "set_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            ids, sets, signatures = [], [], []
            for i, items, key in zip(piece.column(0).to_pylist(), shingles(piece.column(1), width), piece.column(2).to_pylist(), strict=True):
                if len(items) and xxhash.xxh128_digest(items.tobytes()) == key:
                    ids.append(i)
                    sets.append(items.view(np.int64))
                    signatures.append(hashes.signature(items).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(signatures, pa.binary())], names=["class", "items", "signature"])

    return chosen.mapInArrow(run, "class bigint, items array<bigint>, signature binary").dropDuplicates(["class"])


def _rest(members: DataFrame, links: DataFrame, sets: DataFrame, percent: int, slack: float, block: int, counters: int, rounds: int, crowd: int) -> DataFrame:
    """Components of all links: those of the first pass and those of classes in buckets that hold more than one component after it.

    Two of them can be linked only if they share one of their rarest shingles, which texts that merely share common passages
    don't; pairs of different components that do are compared by their signatures, then on their full sets.
    """
    roots = components(links)
    rows = members.where("n > 2").join(roots, F.col("class") == F.col("node"), "left").select("key", "class", F.coalesce("root", "class").alias("root"))
    open_keys = rows.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("key")
    rest = cut(lookup(rows, cut(open_keys), ["key"], "left_semi").select("class").distinct())
    if rest.isEmpty():
        return roots
    own = cut(lookup(sets, rest, ["class"], "left_semi"))
    counts = shingle_counts(own.select("items"), lambda batch: [[x.values.to_numpy().view(np.uint64) for x in batch.column(0)]], counters)
    shift, noise = np.uint64(64 - counters.bit_length() + 1), float(counts.mean())

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [prefix(items, counts[(items >> shift).astype(np.int64)], noise, percent, 1) for items in (x.values.to_numpy().view(np.uint64) for x in batch.column(1))]
            sizes, typical = pa.array([len(x) for x in batch.column(1)], pa.int64()), pa.array([f[2] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, typical, pa.array([f[0].view(np.int64) for f in found], pa.list_(pa.int64()))], names=["class", "size", "typical", "prefix"])

    posted = cut(own.select("class", "items").mapInArrow(prefixes, "class bigint, size bigint, typical double, prefix array<bigint>"))
    shared = shared_tokens(posted.select("class", "size", F.lit(1).alias("depth"), "typical", F.posexplode("prefix").alias("pos", "token")))
    signed = lambda side: own.select(F.col("class").alias(side), F.col("signature").alias(f"sign_{side}"))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).mean(axis=1) >= percent / 100 - slack))

    tested = links.limit(0)
    for i in range(rounds + 1):
        pairs = typical_round(shared, roots, percent, crowd, i / rounds) if i < rounds else exact_rest(*crossing(shared, roots, percent), percent)
        pairs = cut(pairs.join(tested, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        tested = tested.union(pairs)
        pairs = cut(pairs.join(signed("a"), "a").join(signed("b"), "b").select("a", "b", "sign_a", "sign_b").mapInArrow(alike, "a bigint, b bigint"))
        found = cut(confirmed(pairs, lambda sends: sends.join(own.select("class", "items"), "class"), percent, block))
        if not found.isEmpty():
            links = cut(links.union(found))
            roots = components(links)
    return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 5, bands: int = 25, rows: int = 5, slack: float = 0.16, block: int = 256, counters: int = 1 << 18, rounds: int = 2, crowd: int = 32) -> DataFrame:
    """Per row: id (long), n_shingles, component_id (the least id reachable over links, itself included), kept (id = component_id).

    Linked are texts whose sets of distinct `width`-word shingles have 100 * intersection >= percent * union. A text with
    fewer words has one shingle, its whole sequence. Null, empty and blank texts have an empty set and no links. Equal
    texts are linked; rows of one id count as one document. A row with a null id has no links, a null component, and is kept.
    Other columns are left out, whatever their names; an empty table gives an empty result.

    With the defaults a link at exactly 80 % misses all bands with probability 5e-5, one at 85 % with 4e-7; a linked
    pair's signature falls short by `slack` with less. `block`: the partners of one class are dealt into parts of about as
    many. `counters` (a power of two): places by which shingles of the rest are counted for their order. `rounds`: how often
    classes of shingles that `crowd` of them or more have meet the typical one before the exact rest. These change no result.
    """
    hashes = MinHash(bands, rows)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = cut(_described(docs, width, hashes))
    filled = described.where("id is not null and set_key is not null")
    classes = filled.groupBy("set_key").agg(F.min("id").alias("least"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys"))
    classes = cut(classes.withColumn("class", F.monotonically_increasing_id()))
    banded = classes.select("class", "size", F.explode("keys").alias("key"))
    buckets = cut(banded.groupBy("key").agg(F.min(F.struct("class", "size")).alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = buckets.agg(F.sum("n")).first()[0] or 0
    members = cut(spread(banded, buckets, ["key"], F.col("n") * 4096 > total))
    # a pair knows the size of its bucket, and so into how many parts the representative's partners are dealt
    pairs = members.where("class <> rep.class").where(100 * F.least("size", "rep.size") >= percent * F.greatest("size", "rep.size"))
    pairs = cut(pairs.groupBy("class", F.col("rep.class").alias("rep")).agg(F.ceil(F.max("n") / F.lit(block)).cast("int").alias("parts")))
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", F.col("least").alias("id"), "set_key")
    sets = cut(_sets(docs, cut(wanted), width, hashes))
    a, b = sets.select("class", F.col("items").alias("x")), sets.select(F.col("class").alias("rep"), F.col("items").alias("y"))
    b = b.join(pairs.groupBy("rep").agg(F.max("parts").alias("parts")), "rep").select("rep", "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = pairs.withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int")).join(a, "class").join(b, ["rep", "part"])
    common = F.size(F.array_intersect("x", "y"))
    links = met.select(F.col("class").alias("a"), F.col("rep").alias("b"), common.alias("c"), (F.size("x") + F.size("y")).alias("s")).where(100 * F.col("c") >= percent * (F.col("s") - F.col("c")))
    # an id with several texts is one document: their classes are linked
    several = cut(filled.groupBy("id").agg(F.min("set_key").alias("k0"), F.max("set_key").alias("k1")).where("k0 <> k1").select("id"))
    links = links.select("a", "b")
    if not several.isEmpty():
        ids = lookup(filled.select("id", "set_key"), several, ["id"], "left_semi").distinct().join(classes.select("set_key", "class"), "set_key")
        links = links.union(ids.join(ids.groupBy("id").agg(F.min("class").alias("b")), "id").select(F.col("class").alias("a"), "b"))
    roots = _rest(members, cut(links), sets, percent, slack, block, counters, rounds, crowd)
    linked = lookup(filled.select("id", "n_shingles", "set_key"), labelled(classes, roots), ["set_key"]).select("id", "n_shingles", "component_id")
    alone = described.where("id is null or set_key is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The kept document of each group, with all columns; of rows that share an id one stays, rows with a null id all stay."""
    found = cut(near_duplicates(docs, id_col=id_col, **settings).select(id_col, "kept"))
    left = without(docs, id_col, cut(found.where("not kept").select(id_col).distinct()))
    if found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty():
        return left
    return left.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(left.where(F.col(id_col).isNull()))
