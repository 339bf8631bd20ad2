"""Similarity join of documents on word n-gram sets (Jaccard), by prefixes that ask for several matches.

Shingles have one global order, rare ones first by counts over all documents. If a set of n shingles shares at least t with
a partner, both share l of the first n - t + l of each. Every document chooses its own l: each step lengthens its prefix by
one shingle, whose count says how many more rows are read, but asks every candidate for one more match; the least estimated
cost wins. A pair is a candidate if it shares as many prefix shingles as the smaller of both numbers.

Links within a group of near copies grow with its square, so rounds come first in which each prefix shingle's rows meet
only the most typical one of about their size. What a round links is one component from then on; the exact rest are the pairs
of rows of a shingle that are in different components still. Rounds change the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lookup, slices
from .components import components, labelled
from .near_dedup import shingles
from .prefixes import confirmed, crossing, exact_rest, prefix, shared_tokens, shingle_counts, typical_round


def _described(docs: DataFrame, width: int, percent: int, counts: np.ndarray, deepest: int) -> DataFrame:
    """(id, n_shingles, set_key, depth, typical, prefix); all but the first two are null for empty sets."""
    shift, noise = np.uint64(64 - len(counts).bit_length() + 1), float(counts.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for items in shingles(piece.column(1), width):
                first, depth, typical = prefix(items, counts[(items >> shift).astype(np.int64)], noise, percent, deepest) if len(items) else (None, None, None)
                for column, value in zip(out, (len(items), xxhash.xxh128_digest(items.tobytes()) if len(items) else None, depth, typical, None if first is None else first.view(np.int64)), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, out, kinds)], names=["id", "n_shingles", "set_key", "depth", "typical", "prefix"])

    return docs.mapInArrow(run, "id bigint, n_shingles bigint, set_key binary, depth int, typical double, prefix array<bigint>")


def _shipped(docs: DataFrame, classes: DataFrame, sends: DataFrame, width: int) -> DataFrame:
    """(class, home, part, lead, items) of the classes that are sent somewhere, each read from a text of its least id."""
    bound = sends.groupBy("class").agg(F.collect_list(F.struct("home", "part", "lead")).alias("sends"))
    wanted = cut(bound.join(classes.select("class", F.col("least").alias("id"), "set_key"), "class"))
    chosen = lookup(docs, wanted, ["id"]).select("text", "class", "set_key", "sends")

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["class", "home", "part", "lead", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 0):
            columns, rows, held = (piece.column(k).to_pylist() for k in range(1, 4)), [], 0
            for items, name, key, to in zip(shingles(piece.column(0), width), *columns, strict=True):
                for t in to if len(items) and xxhash.xxh128_digest(items.tobytes()) == key else ():
                    rows.append((name, t["home"], t["part"], t["lead"], items.view(np.int64)))
                    held += len(items)
                    if held > 1 << 20:
                        yield packed(rows)
                        rows, held = [], 0
            yield packed(rows)

    return chosen.mapInArrow(run, "class bigint, home bigint, part int, lead boolean, items array<bigint>")


def _same_id(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of an id with several texts, which is one document."""
    several = cut(filled.groupBy("id").agg(F.min("set_key").alias("k0"), F.max("set_key").alias("k1")).where("k0 <> k1").select("id"))
    ids = lookup(filled.select("id", "set_key"), several, ["id"], "left_semi").distinct().join(classes.select("set_key", "class"), "set_key")
    return cut(ids.join(ids.groupBy("id").agg(F.min("class").alias("b")), "id").select(F.col("class").alias("a"), "b"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 4, deepest: int = 8, counters: int = 1 << 21, rounds: int = 2, crowd: int = 32, block: int = 256) -> DataFrame:
    """Per row: id (long), n_shingles, component_id (the least id reachable by links, itself included).

    Linked are texts whose sets of distinct `width`-word shingles have 100 * intersection >= percent * union. Words: runs
    between ASCII white space, A-Z in lower case; a text with fewer words has one shingle, its whole sequence. Null, empty and
    blank texts have an empty set and no links. Equal texts are linked; rows of one id count as one document. A row with a
    null id has no links and a null component. Other columns are left out, whatever their names; an empty table gives an
    empty result.

    `counters` (a power of two): places of the table by which shingles are counted for the order and the cost, 4 bytes each
    on the driver and in tasks; shingles that share a place are counted together. `deepest`: the most matches a prefix asks
    for. `rounds`: how often rows of shingles that `crowd` classes or more have meet the typical one before the exact rest.
    None changes the result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = shingle_counts(docs.select("text"), lambda batch: (shingles(piece.column(0), width) for piece in slices([batch], 0)), counters)
    described = cut(_described(docs, width, percent, counts, deepest))
    filled = described.where("id is not null and set_key is not null")
    classes = filled.groupBy("set_key").agg(F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("n_shingles", "depth", "typical", "prefix")))
    classes = cut(classes.withColumn("class", F.monotonically_increasing_id()).withColumnRenamed("n_shingles", "size"))
    posted = classes.select("class", "size", "depth", "typical", F.posexplode("prefix").alias("pos", "token"))
    members = shared_tokens(posted)
    links = _same_id(filled, classes)
    tested = links.limit(0)
    for i in range(rounds + 1):
        if i < rounds:
            pairs = typical_round(members, components(links), percent, crowd, i / rounds)
        else:
            pairs = exact_rest(*crossing(members, components(links), percent), percent)
        pairs = cut(pairs.join(tested, ["a", "b"], "left_anti"))
        tested = tested.union(pairs)
        links = cut(links.union(confirmed(pairs, lambda sends: _shipped(docs, classes, sends, width), percent, block)))
    named = labelled(classes, components(links))
    out = lookup(filled.select("id", "n_shingles", "set_key"), named, ["set_key"]).select("id", "n_shingles", "component_id")
    alone = described.where("id is null or set_key is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return out.union(alone).withColumnRenamed("id", id_col)
