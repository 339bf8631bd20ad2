"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group and stay in one shard, unless a group outgrows a shard. Groups of over 1/bundles of a total are
placed one by one, lighter ones are first bundled by hash; each unit goes, largest first, to the shard where the dot
product of its vector with the residual capacity is highest. The number of units has a bound that doesn't grow with
the table, so the greedy pass is small; everything by row is hash arithmetic and joins with broadcast tables of that bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LONG_SLICE_BYTES, cut, slices
from .token_counts import counter


def pack(units: np.ndarray, n_shards: int, matters: tuple[float, ...] = (20, 1, 1)) -> np.ndarray:
    """Shard of each row of `units` (weights by dimension). Larger units first, ties in the order given.

    `matters` scales the dimensions in the dot product: the first, bytes, is the law and comes before the others. With even
    weights one text of a third of a shard, beside many small ones, leaves its shard a tenth over the mean in bytes.
    """
    total = units.sum(axis=0)
    share = units / np.where(total > 0, total / n_shards, 1)
    residual = np.ones((n_shards, units.shape[1]))
    out = np.zeros(len(units), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        at = out[i] = int(np.argmax(residual @ (share[i] * matters)))
        residual[at] -= share[i]
    return out


def _measured(docs: DataFrame, id_col: str, text_col: str, model: str | None) -> DataFrame:
    """(id, size, text_crc32, group, n_tokens) of each row; texts are read once and don't travel on."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    group = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.xxhash64(F.col(text_col), F.lit(7)))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), group.alias("group"), text.alias("text"))
    if model is None:
        return rows.select("id", "size", "text_crc32", "group", F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("n_tokens"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model)
        for piece in slices(batches, 4, LONG_SLICE_BYTES):
            tokens = pa.array(pieces.counts(piece.column(4).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*piece.columns[:4], tokens], names=["id", "size", "text_crc32", "group", "n_tokens"])

    return rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, size bigint, text_crc32 bigint, group bigint, n_tokens bigint")


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16, bundles: int = 1 << 15, parts: int = 2048, model: str | None = None) -> DataFrame:
    """Per row: id, size (UTF-8 bytes + 1), n_tokens, text_crc32, law (`bytes`), shard, slot (gapless from 0 in a shard), grown_shard (null).

    `model`: a sentencepiece model that every worker can read, by which tokens are counted; without one they are runs of
    non-space characters. Null texts form one group of size 1 a row and crc32 0. A group heavier than a shard's share in
    some dimension is split by id. Repeated rows get a slot each. Other columns are left out, whatever their names; an empty
    table gives an empty result. At most 3 * bundles groups can each hold over 1/bundles of a total, and they have at most
    4 * bundles + 3 * parts parts: that bounds what is collected and broadcast.
    """
    session = docs.sparkSession
    base = cut(_measured(docs, id_col, text_col, model))
    sums = [F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("r")]
    by_group = base.groupBy("group").agg(*sums)
    b, t, r = (float(x or 0) for x in base.agg(*sums).first())
    over = lambda times: (F.col("b") * times > b) | (F.col("t") * times > t) | (F.col("r") * times > r)
    heavy = by_group.where(over(float(bundles))).select("group", "r", over(float(n_shards)).alias("apart")).toArrow().sort_by("group")
    rows, alone = heavy.column("r").to_numpy(), heavy.column("apart").to_numpy(zero_copy_only=False)
    n_parts = np.maximum(-(-rows * parts // max(int(r), 1)), np.where(alone & (rows > 1), 2 * n_shards, 1)).astype(np.int32)
    own = np.arange(len(rows), dtype=np.int32) + bundles
    places = session.createDataFrame(pa.table({"group": heavy.column("group").combine_chunks().cast(pa.int64()), "own": own, "n_parts": n_parts}))
    placed = base.join(F.broadcast(places), "group", "left").select(
        "id", "size", "n_tokens", "text_crc32",
        F.coalesce("own", F.pmod("group", F.lit(bundles)).cast("int")).alias("unit"),
        F.coalesce(F.pmod(F.xxhash64("id"), F.col("n_parts")).cast("int"), F.lit(0)).alias("part"),
    )
    cells = placed.groupBy("unit", "part").agg(*sums).toArrow().sort_by([("unit", "ascending"), ("part", "ascending")])
    unit, part = (cells.column(c).to_numpy().astype(np.int64) for c in ("unit", "part"))
    weights = np.column_stack([cells.column(c).to_numpy().astype(float) for c in ("b", "t", "r")])
    apart = np.isin(unit, own[alone])
    _, number = np.unique(unit * (parts * 64) + np.where(apart, part + 1, 0), return_inverse=True)  # parts of a group stay together unless it is split
    units = np.zeros((number.max(initial=-1) + 1, 3))
    np.add.at(units, number, weights)
    shard = pack(units, n_shards)[number]
    first = np.zeros(len(shard), np.int64)
    for k in range(n_shards):
        mine = np.flatnonzero(shard == k)
        first[mine] = np.cumsum(weights[mine, 2]).astype(np.int64) - weights[mine, 2].astype(np.int64)
    plan = session.createDataFrame(pa.table({"unit": unit.astype(np.int32), "part": part.astype(np.int32), "shard": shard.astype(np.int32), "first": first}))
    within = F.row_number().over(Window.partitionBy("unit", "part").orderBy("id")) - 1
    return (
        placed.withColumn("within", within)
        .join(F.broadcast(plan), ["unit", "part"])
        .select(
            F.col("id").alias(id_col), "size", "n_tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
