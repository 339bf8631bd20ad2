"""Approximate nearest neighbours by largest inner product: an inverted index scanned with adaptive numbers of dimensions.

Vectors get one more component that makes their lengths equal, so the largest inner product is the least distance. A
random rotation spreads what distinguishes vectors evenly over the dimensions. Each vector belongs to the list of its
nearest centre; a query probes the lists nearest to it. Within a list, columns of dimensions are read block by block, and a
candidate is abandoned as soon as a hypothesis test on its partial distance says that its distance exceeds the k-th best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut


class Index:
    """Rotation, centres and number of probes, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, longest: float, lists: int, k: int, recall: float, seed: int = 5, rounds: int = 12):
        rng = np.random.default_rng(seed)
        self.longest, dims = longest, sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0].astype(np.float32)
        x = self.rotated(sample, False)
        self.centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(rounds):
            near = self.nearest(x, 1)[:, 0]
            sums, counts = np.zeros(self.centres.shape), np.bincount(near, minlength=len(self.centres))
            np.add.at(sums, near, x)
            self.centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], self.centres).astype(np.float32)
        first = np.sort(np.unique(ids, return_index=True)[1])  # one vector of each id: k places are k ids
        asked = sample[rng.choice(len(sample), min(256, len(sample)), replace=False)]
        # in how many of the first lists a sample's own neighbours are; in the whole, which is denser, they are in fewer
        best = np.argsort(-(asked.astype(np.float32) @ sample[first].astype(np.float32).T), axis=1)[:, : k + 1]
        order = np.argsort(self.nearest(self.rotated(asked, True), len(self.centres)), axis=1)
        place = np.sort(np.take_along_axis(order, self.nearest(x[first], 1)[:, 0][best], axis=1), axis=None)
        self.probes = int(place[min(len(place) - 1, int(np.ceil(recall * len(place))))]) + 1

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Queries get a last component of 0, others what their squared length lacks to the longest."""
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x.astype(np.float64) ** 2).sum(axis=1), 0))
        return np.column_stack([x, last]).astype(np.float32) @ self.rotation

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the n nearest centres, nearest first."""
        d = (self.centres**2).sum(axis=1) - 2 * (x @ self.centres.T)
        if n >= d.shape[1]:
            return np.argsort(d, axis=1, kind="stable")
        part = np.argpartition(d, n - 1, axis=1)[:, :n]
        return np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, axis=1), axis=1, kind="stable"), axis=1)


def limit(bound, read: int, dims: int, epsilon: float):
    """What a squared distance within `bound` rarely exceeds in `read` of all dimensions; all of it, but for rounding, in the end."""
    return bound * read / dims * (1 + epsilon / np.sqrt(read)) ** 2 if read < dims else bound + 1e-4 * (1 + abs(bound))


def scan(query: np.ndarray, columns: np.ndarray, partial: np.ndarray, k: int, step: int, epsilon: float, bound: float, single: np.ndarray | None = None) -> np.ndarray:
    """Places of the candidates that no test abandons.

    columns (dimensions, candidates): rotated vectors; partial: squared distances in the first `step` dimensions;
    bound: a squared distance that k candidates elsewhere are known to be within, infinite if none is known: then one is
    taken from the k candidates nearest in the first dimensions; single: one place of each id, if ids repeat.
    """
    dims, n = columns.shape
    if bound == np.inf and (n if single is None else len(single)) > k:
        tried = np.argpartition(partial, k - 1)[:k] if single is None else single[np.argpartition(partial[single], k - 1)[:k]]
        bound = min(bound, float(((columns[:, tried] - query[:, None]) ** 2).sum(axis=0).max()) + 1e-5)
    alive, read = np.arange(n), min(step, dims)
    while True:
        stay = partial <= limit(bound, read, dims, epsilon)
        alive, partial = alive[stay], partial[stay]
        if read >= dims or not len(alive):
            return alive
        partial = partial + ((columns[read : read + step, alive] - query[read : read + step, None]) ** 2).sum(axis=0)
        read = min(read + step, dims)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, lists: int | None = None, recall: float = 0.95, sample: int = 20_000, step: int = 16, epsilon: float = 1.5, cell: int = 4096) -> DataFrame:
    """Per query id its k nearest found: query_id, rank (from 1), vec_id (long), score (double inner product of the originals).

    Queries: rows for which `is_query` holds; candidates: every row with another id. Nearest first, ties to the smaller id;
    all candidates, if fewer than k are found. Vectors that are null, of length zero, or hold a null, NaN or infinite
    component take no part. A shorter vector counts as filled up by zeros. Rows of one id: the best counts as candidate, the
    least (component by component) is asked as query; places and bounds count ids, not rows. A null id takes no part. Other
    columns are left out, whatever their names; an empty table gives an empty result.

    `sample`: about how many rows the centres are fitted on, drawn by a hash; every row is indexed. `lists`: default half the
    square root of the number of rows, 2048 at most; a query probes as many as hold the share `recall` of the neighbours within
    the sample. A query first searches the lists nearest to it that hold k candidates; their k-th best score is the bound
    that candidates of its other lists are tested against. Lists of over `cell` rows are split by id, lists asked by over
    `cell` queries by query, so that no task grows with a list.
    """
    session = vectors.sparkSession
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    able = able.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(finite, F.lit(False)) & F.exists(F.col("v"), lambda x: x != 0))
    per_id = able.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.min(F.size("v")).alias("fewest"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"))
    top = per_id.agg(F.sum("n").alias("n"), F.max("n").alias("copies"), F.max("dims").alias("dims"), F.min("fewest").alias("fewest"), F.max("longest").alias("longest")).first()
    if top["n"] is None:
        return session.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims, rows, repeated = top["dims"], top["n"], top["copies"] > 1
    if top["fewest"] < dims:
        able = able.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v"))))
    if repeated:
        able = cut(able.groupBy("id", "v").agg(F.max("asked").alias("asked")))
        rows = able.count()
    share = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / rows) * (1 << 30)) + 1)
    table = able.where(share).select("id", "v").toArrow()
    flat = table.column("v").combine_chunks()
    ids = table.column("id").to_numpy()
    data = (flat.values if hasattr(flat, "values") else flat.combine_chunks().values).to_numpy().reshape(-1, dims) if len(ids) else np.ones((1, dims))
    order = np.lexsort((*data.T[::-1], ids)) if len(ids) else np.zeros(1, np.int64)  # one table gives one index, however it is dealt
    index = Index(data[order], ids[order] if len(ids) else order, float(top["longest"]), lists or max(1, min(2048, round(rows**0.5 / 2))), k, recall)
    n_lists = len(index.centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x = batch.column(1).flatten().to_numpy().reshape(-1, dims)
                near = index.nearest(index.rotated(x, False), 1)[:, 0].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(near)], names=["id", "own", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x = batch.column(1).flatten().to_numpy().reshape(-1, dims)
                order = index.nearest(index.rotated(x, True), n_lists).astype(np.int32)
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                first = before < k + 1  # lists without which a query might get fewer than k
                taken = first | (np.arange(n_lists) < index.probes)
                lists_, firsts = ([o[t].tolist() for o, t in zip(a, taken, strict=True)] for a in (order, first))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(lists_, pa.list_(pa.int32())), pa.array(firsts, pa.list_(pa.bool_()))], names=["id", "own", "list", "first"])

    placed = cut(able.select("id", "v").mapInArrow(assign, "id bigint, own binary, list int"))
    counts = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    # an id in several lists counts in one of them, so that sums over lists never exceed the ids there
    homes = {r["list"]: r["n"] for r in placed.groupBy("id").agg(F.min("list").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()} if repeated else counts
    sizes = np.array([homes.get(i, 0) for i in range(n_lists)])
    asked = able.where("asked").groupBy("id").agg(F.min("v").alias("v")).mapInArrow(probe, "id bigint, own binary, list array<int>, first array<boolean>")
    probed = cut(asked.select("id", "own", F.explode(F.arrays_zip("list", "first")).alias("p")).select("id", "own", "p.first", "p.list"))
    parts = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def cells(wanted: DataFrame) -> DataFrame:
        """Candidates (role 0) and queries (role 1: id, own, list, floor) by cell: a part of a list with a part of its queries."""
        asks = {r["list"]: r["n"] for r in wanted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
        plan = F.broadcast(session.createDataFrame([(i, max(1, -(-counts.get(i, 0) // cell)), -(-n // cell)) for i, n in asks.items()] or [(-1, 1, 1)], "list int, bases int, asks int"))
        left = placed.withColumn("floor", F.lit(0.0)).join(plan, "list").withColumn("b", mine("bases")).withColumn("a", parts("asks")).withColumn("role", F.lit(0))
        right = wanted.join(plan, "list").withColumn("a", mine("asks")).withColumn("b", parts("bases")).withColumn("role", F.lit(1))
        columns = ["list", "b", "a", "role", "id", "own", "floor"]
        return left.select(columns).union(right.select(columns)).repartition("list", "b", "a").sortWithinPartitions("list", "b", "a", "role")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = lambda rows, kind=np.float64: np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)

        def settle(base: list[tuple], asks: list[tuple], out: list[list]) -> None:
            """The k best of the cell's candidates for each of its queries, unless known to be beaten elsewhere."""
            if not base or not asks:
                return
            others, originals = np.array([b[0] for b in base]), matrix([b[1] for b in base])
            single = np.unique(others, return_index=True)[1]
            single = single if len(single) < len(others) else None
            columns_ = np.ascontiguousarray(index.rotated(originals, False).T)
            head = columns_[:step]
            for start in range(0, len(asks), 256):
                part = asks[start : start + 256]
                queries = matrix([a[1] for a in part])
                turned = index.rotated(queries, True)
                partial = (turned[:, :step] ** 2).sum(axis=1)[:, None] + (head**2).sum(axis=0) - 2 * (turned[:, :step] @ head)
                bounds = (queries**2).sum(axis=1) + index.longest**2 - 2 * np.array([floor for *_, floor in part])
                # queries whose every candidate the first columns already abandon need no scan
                open_ = (partial.min(axis=1) <= limit(bounds, min(step, columns_.shape[0]), columns_.shape[0], epsilon)).nonzero()[0]
                for i in open_.tolist():
                    name, _, floor = part[i]
                    alive = scan(turned[i], columns_, partial[i], k + 1, step, epsilon, float(bounds[i]), single)
                    alive = alive[others[alive] != name]
                    if not len(alive):
                        continue
                    scores = (originals[alive] * queries[i]).sum(axis=1)
                    best = np.lexsort((others[alive], -scores))
                    if single is not None:
                        best = best[np.sort(np.unique(others[alive][best], return_index=True)[1])]
                    best = best[:k]
                    best = best[scores[best] >= floor]
                    out[0].extend([name] * len(best))
                    out[1].extend(others[alive][best].tolist())
                    out[2].extend(scores[best].tolist())

        def packed(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

        now, held = None, ([], [])
        for batch in batches:
            out: list[list] = [[], [], []]
            for *key, role, name, own, floor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    settle(*held, out)
                    now, held = key, ([], [])
                held[role].append((name, own, floor))
            yield packed(out)
        settle(*held, out := [[], [], []])
        yield packed(out)

    scored = "query_id bigint, vec_id bigint, score double"
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = lambda found: found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", place).where(F.col("rank") <= k)
    near = cut(best(cells(probed.where("first").withColumn("floor", F.lit(float("-inf")))).mapInArrow(search, scored)))
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    others = probed.where("not first").join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    far = cells(cut(others)).mapInArrow(search, scored)
    return best(near.select("query_id", "vec_id", "score").union(far)).select("query_id", "rank", "vec_id", "score")
