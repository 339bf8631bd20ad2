"""Hard negatives by exact integer inner products, found through product quantisation with residual norms.

Vectors become integers. Each is stored with one code a part (a few components) and a bound on the norm of what the code
leaves over. For an anchor, a table holds its product with every centre; the sum of looked-up entries is off by at most the
sum over parts of the anchor's norm times the residual's norm. These bounds are rigorous: only rows that may still win are
scored in full. One pass over all rows finds each anchor's positives, a second one completes the window of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

#: Scaled components are held to this size, so that products of up to 2**14 dimensions stay exact in 64 bits.
MOST = 1 << 24


class Quantiser:
    """Integer centres of each part of `width` components, fitted by k-means on a bounded sample."""

    def __init__(self, sample: np.ndarray, width: int, centres: int = 256, rounds: int = 6, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.width, self.centres = width, []
        for part in self.parts(sample):
            known = np.unique(part, axis=0)
            at = known[np.sort(rng.choice(len(known), min(centres, len(known)), replace=False))].astype(np.float64)
            for _ in range(rounds if len(known) > centres else 0):
                near = self._nearest(part, at)
                counts = np.bincount(near, minlength=len(at))
                sums = np.stack([np.bincount(near, part[:, j], len(at)) for j in range(part.shape[1])], axis=1)
                at = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], at)
            self.centres.append(np.rint(at).astype(np.int64))

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, i : i + self.width] for i in range(0, x.shape[1], self.width)]

    @staticmethod
    def _nearest(part: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ((at**2).sum(axis=1) - 2 * (part.astype(np.float64) @ at.T)).argmin(axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes and residual norms (rows, parts) as bytes, and a float unit a row: a norm is at most its byte times the unit."""
        codes, norms = [], []
        for part, at in zip(self.parts(x), self.centres, strict=True):
            codes.append(self._nearest(part, at.astype(np.float64)).astype(np.uint8))
            norms.append(np.sqrt(((part - at[codes[-1]]).astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12))
        norms = np.stack(norms, axis=1)
        unit = norms.max(axis=1) / 255 * (1 + 1e-9) + 1e-9
        return np.stack(codes, axis=1), np.ceil(norms / unit[:, None]).astype(np.uint8), unit

    def tables(self, anchors: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each part, the product of every centre with every anchor; and the anchors' norms (parts, anchors)."""
        own = self.parts(anchors)
        return [at @ part.T for at, part in zip(self.centres, own, strict=True)], np.stack([np.sqrt((p.astype(np.float64) ** 2).sum(axis=1)) for p in own])


def bounds(tables: list[np.ndarray], norms: np.ndarray, codes: np.ndarray, residuals: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, anchors): what each exact score is at least and at most."""
    score = tables[0][codes[:, 0]]
    for m in range(1, len(tables)):
        score += tables[m][codes[:, m]]
    off = (residuals * units[:, None]) @ norms * (1 + 1e-9) + 1e-12 * np.abs(score) + 1  # and room for rounding
    return score - off, score + off


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


class Best:
    """The k rows of highest score seen so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


class Positives:
    """The best rows of the anchor's label."""

    def __init__(self, anchor: tuple, k: int, *_: int):
        self.id, self.label, self.best = anchor[0], anchor[1], Best(k)

    def take(self, ids: np.ndarray, labels: np.ndarray, least: np.ndarray, most: np.ndarray, exact) -> None:
        able = ((labels == self.label) & (ids != self.id) & (most >= self.best.floor)).nonzero()[0]
        able = able[most[able] >= _kth(least[able], self.best.k)]
        if len(able):
            self.best.add(ids[able], exact(able))

    def rows(self) -> Iterator[tuple]:
        yield from ((self.id, self.label, int(i), int(s)) for i, s in zip(self.best.ids, self.best.scores, strict=True))


class Windows:
    """For each positive, the best rows of other labels with low * its score <= 100 * score <= high * its score."""

    def __init__(self, anchor: tuple, k: int, low: int, high: int):
        self.id, self.label, self.low, self.high = anchor[0], anchor[1], low, high
        self.windows = [(p, s, Best(k)) for p, s in zip(anchor[3], anchor[4], strict=True)]

    def take(self, ids: np.ndarray, labels: np.ndarray, least: np.ndarray, most: np.ndarray, exact) -> None:
        floors = [max(self.low * s / 100, best.floor) for _, s, best in self.windows]
        able = ((labels != self.label) & (ids != self.id) & (most >= min(floors) - 1) & (least <= max(self.high * s / 100 for _, s, _ in self.windows) + 1)).nonzero()[0]
        if not len(able):
            return
        low, high = least[able], most[able]
        wanted = np.zeros(len(able), bool)
        for (_, s, best), floor in zip(self.windows, floors, strict=True):
            sure = (100 * low >= self.low * s + 1) & (100 * high <= self.high * s - 1)
            wanted |= (high >= max(floor, _kth(low[sure], best.k)) - 1) & (low <= self.high * s / 100 + 1)
        able = able[wanted]
        scores, others = exact(able), ids[able]
        for _, s, best in self.windows:
            inside = (100 * scores >= self.low * s) & (100 * scores <= self.high * s)
            best.add(others[inside], scores[inside])

    def rows(self) -> Iterator[tuple]:
        for p, s, best in self.windows:
            yield from ((self.id, p, int(i), s, int(v)) for i, v in zip(best.ids, best.scores, strict=True))


def _scan(rows: DataFrame, anchors: DataFrame, quantiser: Quantiser, grid: tuple[int, int], keep: type, k: int, percents: tuple[int, int], schema: str) -> DataFrame:
    """What `keep` holds of each anchor after each cell's rows: anchors are dealt into blocks, rows into cells, all met."""
    blocks, cells = grid
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.withColumn("block", dealt(blocks)).withColumn("cell", every(cells)).withColumn("role", F.lit(0))
    base = rows.withColumn("cell", dealt(cells)).withColumn("block", every(blocks)).withColumn("role", F.lit(1))
    base = base.withColumn("positives", F.lit(None).cast("array<bigint>")).withColumn("scores", F.lit(None).cast("array<bigint>"))
    columns = ["block", "cell", "role", "id", "label", "own", "code", "residual", "unit", "positives", "scores"]
    names = [f.split(" ")[0] for f in schema.split(", ")]
    bytes_ = lambda column, kind, n: np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, held = None, [], None

        def result() -> pa.RecordBatch:
            found = [row for keeper in (held[0] if held else []) for row in keeper.rows()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(len(names))], names=names)

        for batch in batches:
            block, cell, role = (batch.column(i).to_numpy() for i in range(3))
            ends = np.append((np.diff(block) != 0) | (np.diff(cell) != 0) | (np.diff(role) != 0), True).nonzero()[0] + 1
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                if now != (block[start], cell[start]):
                    if held:
                        yield result()
                    now, waiting, held = (block[start], cell[start]), [], None
                if role[start] == 0:
                    part = batch.slice(start, end - start)
                    waiting += zip(*(part.column(i).to_pylist() for i in (3, 4, 5, 9, 10)), strict=True)
                    continue
                for at in range(start, end, 2048) if waiting else ():
                    if held is None:
                        vectors = np.frombuffer(b"".join(a[2] for a in waiting), np.int32).reshape(len(waiting), -1).astype(np.int64)
                        held = [keep(a, k, *percents) for a in waiting], vectors, *quantiser.tables(vectors)
                    part = batch.slice(at, min(2048, end - at))
                    ids, labels, n = part.column(3).to_numpy(), part.column(4).to_numpy(), part.num_rows
                    own = bytes_(part.column(5), np.int32, n)
                    least, most = bounds(held[2], held[3], bytes_(part.column(6), np.uint8, n), bytes_(part.column(7), np.uint8, n), part.column(8).to_numpy())
                    for i, keeper in enumerate(held[0]):
                        keeper.take(ids, labels, least[:, i], most[:, i], lambda able, v=held[1][i], own=own: own[able].astype(np.int64) @ v)
        if held:
            yield result()

    met = asked.select(columns).union(base.select(columns)).repartition(blocks * cells, "block", "cell").sortWithinPartitions("block", "cell", "role")
    return met.mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = 256, width: int = 2, sample: int = 8192, block: int = 1024, cell: int = 131_072, cells: int = 16,
) -> DataFrame:
    """anchor_id, positive_id (long), rank (int, from 1), negative_id, positive_score, negative_score (long).

    A component x counts as floor(scale * x); a score is the integer inner product with the anchor; higher scores come
    first, ties by smaller id. Anchors are the rows for which `is_anchor` holds. An anchor's positives are its first
    `positives` other rows of the same label (a whole number); for each, the first `negatives` rows of another label with
    low * positive score <= 100 * score <= high * positive score, or all if fewer.

    Rows with a null id, label or vector, or a null, NaN or infinite component, take no part. A shorter vector counts as
    filled up by zeros, a zero vector scores 0, scaled components are held to 2**24 in size. Of rows that share an id the one
    of least label and vector counts, and is an anchor if any of them is. Anchors without positives, and positives without
    negatives, give no rows. Other columns are left out, whatever their names; an empty table gives an empty result.

    `sample`: about how many rows the centres are fitted on, drawn by a hash; bounds hold for every row whatever the
    centres are. `width`: components of a part. `block` anchors at once meet `cell` rows; a table has at least `cells` cells.
    """
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    able = able.dropna(subset=["id", "label", "v"]).where(finite)
    whole = lambda x: F.floor(F.least(F.greatest(x * F.lit(float(scale)), F.lit(-float(MOST))), F.lit(float(MOST)))).cast("int")
    able = able.withColumn("v", F.transform("v", whole))
    top = able.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.max("asked").alias("asked")).agg(F.max("n").alias("copies"), F.count(F.lit(1)).alias("n"), F.max("dims").alias("dims"), F.sum(F.col("asked").cast("int")).alias("asked")).first()
    if not top["asked"]:
        return vectors.sparkSession.createDataFrame([], schema)
    if top["copies"] > 1:
        able = able.groupBy("id").agg(F.min(F.struct("label", "v")).alias("one"), F.max("asked").alias("asked")).select("id", "one.*", "asked")
    dims, n = max(1, top["dims"]), top["n"]
    able = able.withColumn("v", F.concat("v", F.array_repeat(F.lit(0), F.lit(dims) - F.size("v"))))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / n) * (1 << 30)) + 1)
    drawn = able.where(share).select("id", "v").toArrow().sort_by("id").column("v").combine_chunks()
    drawn = drawn if isinstance(drawn, pa.Array) else pa.concat_arrays(drawn.chunks)
    quantiser = Quantiser(np.asarray(drawn.flatten()).reshape(-1, dims).astype(np.int64) if len(drawn) else np.zeros((1, dims), np.int64), width)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_ in batches:
            for start in range(0, whole_.num_rows, 4096):
                batch = whole_.slice(start, 4096)
                own = batch.column(2).flatten().to_numpy().reshape(-1, dims)
                codes, residuals, units = quantiser.encode(own.astype(np.int64))
                packed = (pa.array([row.tobytes() for row in a], pa.binary()) for a in (own, codes, residuals))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *packed, pa.array(units)], names=["id", "label", "asked", "own", "code", "residual", "unit"])

    rows = cut(able.select("id", "label", "v", "asked").mapInArrow(index, "id bigint, label bigint, asked boolean, own binary, code binary, residual binary, unit double"))
    grid, percents = (-(-top["asked"] // block), max(cells, -(-n // cell))), (low, high)
    anchors = rows.where("asked")
    none = F.lit(None).cast("array<bigint>")
    found = _scan(rows, anchors.withColumn("positives", none).withColumn("scores", none), quantiser, grid, Positives, positives, percents, "id bigint, label bigint, positive_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "positive_id"))
    best = found.withColumn("place", place).where(F.col("place") <= positives).groupBy("id").agg(F.collect_list("positive_id").alias("positives"), F.collect_list("score").alias("scores"))
    windows = cut(anchors.join(best, "id"))
    inside = _scan(rows, windows, quantiser, grid, Windows, negatives, percents, "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return inside.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
