"""Prefix filters for set similarity: rare shingles first, several matches asked for where that is cheaper.

Two sets that share at least t of n shingles share l of the first n - t + l of each in one global order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, lookup, spread

_CHUNK = 1 << 16


def shingle_counts(rows: DataFrame, sets: Callable[[pa.RecordBatch], Iterable[list[np.ndarray]]], counters: int) -> np.ndarray:
    """How many of all shingles of the rows, which `sets` reads from a batch some at a time, fall to each counter, by the upper bits of their hashes."""
    shift = np.uint64(64 - counters.bit_length() + 1)
    step = min(_CHUNK, counters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(counters, np.int64)
        for batch in batches:
            for found in sets(batch):
                held += np.bincount((np.concatenate([*found, np.zeros(0, np.uint64)]) >> shift).astype(np.int64), minlength=counters)
        yield from packed({i: held[i * step : (i + 1) * step] for i in range(counters // step) if held[i * step : (i + 1) * step].any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                held[i] = held.get(i, 0) + np.frombuffer(part, np.uint32)
        yield from packed(held)

    def packed(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, part in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.minimum(part, (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    total = np.zeros(counters, np.uint32)
    for row in rows.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).collect():  # counters * 4 bytes in all
        total[row["chunk"] * step : (row["chunk"] + 1) * step] = np.frombuffer(row["counts"], np.uint32)
    return total


def prefix(items: np.ndarray, held: np.ndarray, noise: float, percent: int, deepest: int) -> tuple[np.ndarray, int, float]:
    """The set's first shingles, rarest first, the number of matches to ask for, and how typical it is (mean log count).

    held: the count of each shingle's counter; noise: what a counter holds of unrelated shingles.
    """
    order = np.argsort((held.astype(np.uint64) << np.uint64(32)) | (items >> np.uint64(32)), kind="stable")
    n, least = len(items), -(-percent * len(items) // 100)
    reads = np.cumsum(np.maximum(held[order[: n - least + deepest]] - noise, 0.0) + 1)  # rows that share a shingle of the prefix
    depths = np.arange(1, min(deepest, least) + 1)
    # a candidate with l matches takes l of the rows read; it costs the reading of its set
    cost = reads[n - least + depths - 1] * (1 + n / depths)
    depth = int(depths[cost.argmin()])
    return items[order[: n - least + depth]], depth, float(np.log2(np.maximum(held - noise, 0) + 1).mean())


def _alike(common: Column, sizes: Column, percent: int) -> Column:
    """Whether two sets, of so many shingles together, with so many in common are as alike as asked."""
    return (100 + percent) * common >= percent * sizes


def _met(rows: DataFrame, others: DataFrame, on: list[str], heavy: Column | None, percent: int) -> DataFrame:
    """Pairs of rows (a, b) of one key that are in different components and can be alike by their sizes and places.

    Both sizes say how many shingles t must be common. Of alike sets the k-th common shingle is among the first n - t + k of
    both; a shingle is the k-th at most if both have k - 1 before it that others have, too.
    """
    names = ("class", "root", "size", "depth", "pos", "before")
    a, b = (side.select(*on, *(F.col(c).alias(f"{c}_{s}") for c in names), *(c for c in ("rows", "major") if c in side.columns)) for side, s in ((rows, "a"), (others, "b")))
    met = spread(a, b, on, heavy) if heavy is not None else a.join(b, on).where("major or class_a < class_b")
    least = F.ceil(percent * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    kth = F.least("depth_a", "depth_b", F.col("before_a") + 1, F.col("before_b") + 1)
    within = [F.col(f"size_{s}") - F.col(f"pos_{s}") > least - kth for s in "ab"]
    alike = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
    return met.where("root_a <> root_b").where(alike & within[0] & within[1])


def typical_pairs(rows: DataFrame, hubs: DataFrame, on: list[str], heavy: Column, percent: int) -> DataFrame:
    """Pairs (a, b) of a class and the typical one of its key."""
    met = _met(rows, hubs, on, heavy, percent)
    return met.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")).distinct()


def typical_round(members: DataFrame, roots: DataFrame, percent: int, crowd: int, shift: float) -> DataFrame:
    """Pairs (a, b) of the rows of shingles that `crowd` classes or more have and the most typical row of about their size, where they are in different components.

    Sizes within one band can be linked; `shift` (0 to 1) moves the bands, so that those of the next round lie across.
    """
    rows, heavy = crossing(members.where(F.col("n") >= crowd), roots, percent)
    band = F.floor(F.log(F.col("size").cast("double")) / F.lit(float(np.log(100 / percent))) + F.lit(shift)).cast("int")
    rows = rows.withColumn("band", band)
    first = F.max(F.struct("typical", "class", "size", "depth", "pos", "before", "root")).alias("hub")
    hubs = cut(rows.groupBy("token", "band").agg(first, F.count(F.lit(1)).alias("rows")).where("rows > 1").select("token", "band", "rows", "hub.*"))
    return typical_pairs(rows, hubs, ["token", "band"], F.col("rows") > heavy, percent)


def candidates(rows: DataFrame, others: DataFrame, on: list[str], percent: int) -> DataFrame:
    """Pairs (a, b) with enough common prefix shingles, that can still reach the similarity after the last of them."""
    after = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b")) - 1
    pairs = _met(rows, others, on, None, percent).groupBy(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.min(after).alias("after"), F.min(F.col("size_a") + F.col("size_b")).alias("sizes"), F.min(F.least("depth_a", "depth_b")).alias("depth")
    )
    return pairs.where("shared >= depth").where(_alike(F.col("shared") + F.col("after"), F.col("sizes"), percent)).select("a", "b")


def confirmed(pairs: DataFrame, ship: Callable[[DataFrame], DataFrame], percent: int, block: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike.

    Of a pair, the class with more partners is the home that the other's set is sent to; a home with many is dealt into
    parts of about `block` of them. `ship`: (class, home, part, lead) -> the same with the class's items.
    """
    partners = cut(pairs.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n")))
    for side in ("a", "b"):
        pairs = lookup(pairs, partners.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}")), [side])
    to_a = F.col("n_a") >= F.col("n_b")
    pairs = cut(pairs.select(F.when(to_a, F.col("a")).otherwise(F.col("b")).alias("home"), F.when(to_a, F.col("b")).otherwise(F.col("a")).alias("class")))
    homes = cut(pairs.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts")))
    guests = lookup(pairs, homes, ["home"]).select("class", "home", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"), F.lit(False).alias("lead"))
    leads = homes.select(F.col("home").alias("class"), "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("lead"))
    met = ship(guests.union(leads)).select("home", "part", "lead", "class", "items").repartition("home", "part").sortWithinPartitions("home", "part", F.desc("lead"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for batch in batches:
            found = []
            homes_, parts, lead, classes = (batch.column(k).to_pylist() for k in range(4))
            for row, key in enumerate(zip(homes_, parts, strict=True)):
                items = batch.column(4)[row].values.to_numpy()
                if lead[row]:
                    now, own = key, items
                elif key == now:
                    common = len(np.intersect1d(own, items, assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(items) - common):
                        found.append((homes_[row], classes[row]))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])

    return met.mapInArrow(compare, "a bigint, b bigint")


def crossing(members: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Rows of `shared_tokens` with the component they are in, where it isn't one for all rows of the shingle; and from how many rows on a shingle is hot."""
    rows = lookup(members, cut(roots.withColumnRenamed("node", "class")), ["class"], "left").withColumn("root", F.coalesce("root", "class"))
    mixed = rows.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("token")
    rows = cut(lookup(rows, cut(mixed), ["token"], "left_semi"))
    return rows, max(256, rows.count() // 4096)


def exact_rest(rows: DataFrame, heavy: int, percent: int) -> DataFrame:
    """All candidate pairs (a, b) of different components: one side of each is outside its shingle's largest component."""
    by_root = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    major = cut(by_root.groupBy("token").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all")).select("token", F.col("m.root").alias("major"), "all"))
    rows = cut(spread(rows, major, ["token"], F.col("all") > heavy).withColumn("major", F.col("root") == F.col("major")))
    return candidates(rows.where("not major").drop("major"), rows, ["token"], percent)


def shared_tokens(posted: DataFrame) -> DataFrame:
    """The rows (token, class, size, depth, pos, ...) of prefix shingles that several classes have in their prefixes.

    n: how many have it; before: how many shingles of the class's prefix that others have, too, come before it.
    """
    tokens = cut(posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = tokens.agg(F.sum("n")).first()[0] or 0
    members = spread(posted, tokens, ["token"], F.col("n") * 4096 > total)
    return cut(members.withColumn("before", F.row_number().over(Window.partitionBy("class").orderBy("pos")) - 1))
