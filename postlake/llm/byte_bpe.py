"""Byte-level BPE encoding and decoding with a public rank file.

Texts are cut by the tokenizer's pattern; distinct cuts of a step are put into padded matrices, one per length
class. In each round every row joins its leftmost pair of least rank. Ranks of pairs come from an open-addressing
hash table held in numpy arrays; joined rows close up, finished rows leave the matrix. A very long cut comes apart where
no token holds both bytes; what stays long is a matrix of one row, whose round joins all pairs of the least rank, left
to right, unless a pair that arises in between has a lesser one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, slices

_NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> joined id, by linear probing over arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(joined), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] < 0]
            first = free[np.unique(slots[free], return_index=True)[1]]  # one newcomer to each free slot
            self.keys[slots[first]], self.values[slots[first]] = keys[first], joined[first]
            todo = todo[self.keys[slots[todo]] != keys[todo]]
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids, _NONE where no entry exists or an id is negative (padding)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -1
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], _NONE)
        out[keys < 0] = _NONE
        todo = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


class ByteBPE:
    """Encoder and decoder. Remembers the ids of at most `keep` cuts; `cells` bounds a matrix."""

    def __init__(self, path: str, pattern: str, keep: int = 150_000, cells: int = 1 << 17, longest_row: int = 256):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.vocabulary = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.vocabulary[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.beside = np.zeros((256, 256), bool)
        for token in self.ranks:
            x = np.frombuffer(token, np.uint8)
            self.beside[x[:-1], x[1:]] = True
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.cut = regex.compile(pattern)
        self.keep, self.cells, self.longest_row = keep, cells, longest_row
        self.known: dict[str, bytes] = {}

    def _rounds(self, rows: list[bytes], width: int) -> list[bytes]:
        """Ids of each row as packed little-endian numbers; rows are at most `width` bytes."""
        ids = np.full((len(rows), width), -1, np.int32)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ids[np.arange(width) < lengths[:, None]] = self.single[np.frombuffer(b"".join(rows), np.uint8)]
        out: list[bytes] = [b""] * len(rows)
        at = np.arange(len(rows))
        rank = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(at):
            where = rank.argmin(axis=1)  # the leftmost of the least
            best = rank[np.arange(len(at)), where]
            done = best == _NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[at[i]] = ids[i, : lengths[i]].astype("<u4").tobytes()
                stay = ~done
                at, ids, rank, where, best, lengths = at[stay], ids[stay], rank[stay], where[stay], best[stay], lengths[stay]
                if not len(at):
                    break
            n, line = len(at), np.arange(len(at))
            ids[line, where] = best
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > where[:, None]), axis=1)
            lengths = lengths - 1
            if ids.shape[1] > lengths.max():
                ids = ids[:, : lengths.max()]
            if ids.shape[1] == 1:
                rank = np.full((n, 1), _NONE, np.int32)
                continue
            columns = np.arange(rank.shape[1] - 1)
            rank = np.take_along_axis(rank, columns + (columns > where[:, None]), axis=1)[:, : ids.shape[1] - 1]
            for shift in (-1, 0):  # only the pairs beside the joined one are new
                k = where + shift
                ok = np.flatnonzero((k >= 0) & (k < rank.shape[1]))
                rank[ok, k[ok]] = self.pairs.get(ids[ok, k[ok]], ids[ok, k[ok] + 1])
        return out

    def _row(self, row: bytes) -> bytes:
        """Ids of one very long row; a round costs its length, and there are at most as many rounds as distinct ranks it joins by, but for undercut ones."""
        ids = self.single[np.frombuffer(row, np.uint8)]
        rank = self.pairs.get(ids[:-1], ids[1:])
        while len(ids) > 1 and (best := rank.min()) != _NONE:
            at = np.flatnonzero(rank == best)
            start = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of neighbours that overlap, the first, third and so on join
            at = at[(np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))) % 2 == 0]
            joined = np.full(len(at), best, np.int32)
            follows = at + 2 < len(ids)
            if self.pairs.get(joined[follows], ids[at[follows] + 2]).min(initial=_NONE) < best:
                at, joined = at[:1], joined[:1]
            now, kept = ids.copy(), np.ones(len(ids), bool)
            now[at], kept[at + 1] = best, False
            now, place = now[kept], at - np.arange(len(at))
            left = place[place > 0]
            if len(at) > 1 and self.pairs.get(now[left - 1], now[left]).min(initial=_NONE) < best:
                at = at[:1]
                now, place = np.delete(ids, at + 1), at.copy()
                now[at] = best
            rank = np.delete(rank, at)
            beside = np.unique(np.concatenate([place - 1, place]))
            beside = beside[(beside >= 0) & (beside < len(now) - 1)]
            rank[beside] = self.pairs.get(now[beside], now[beside + 1])
            ids = now
        return ids.astype("<u4").tobytes()

    def _parts(self, row: bytes) -> list[bytes]:
        """The row in pieces that no join crosses: cut between bytes that stand side by side in no token."""
        x = np.frombuffer(row, np.uint8)
        at = np.flatnonzero(~self.beside[x[:-1], x[1:]]) + 1
        return [row[a:b] for a, b in zip([0, *at.tolist()], [*at.tolist(), len(row)], strict=True)]

    def encode_cuts(self, cuts: list[bytes]) -> list[bytes]:
        """Packed ids of distinct cuts."""
        out: list[bytes] = [b""] * len(cuts)
        classes: dict[int, list[int]] = {}
        for i, cut in enumerate(cuts):
            if (whole := self.ranks.get(cut)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(cut) > self.longest_row:
                parts = self._parts(cut)
                out[i] = b"".join(self.encode_cuts(parts)) if len(parts) > 1 else self._row(cut)
            elif cut:
                classes.setdefault(max(4, 1 << (len(cut) - 1).bit_length()), []).append(i)
        for width, members in classes.items():
            step = max(1, self.cells // width)
            for start in range(0, len(members), step):
                part = members[start : start + step]
                for i, ids in zip(part, self._rounds([cuts[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _learn(self, cuts: Iterable[list[str]]) -> None:
        every = set().union(*cuts)
        new = list(every - self.known.keys())
        if len(self.known) + len(new) > self.keep:
            self.known.clear()
            new = list(every)
        self.known.update(zip(new, self.encode_cuts([x.encode() for x in new]), strict=True))

    def encode(self, texts: list[str | None], at_once: int = 200_000) -> list[bytes]:
        """Packed ids of each text; texts of one call should be of bounded total size. Longer texts go in runs of cuts."""
        cuts: list[list[str]] = []
        out: list[bytes] = [b""] * len(texts)
        for i, text in enumerate(texts):
            if text and len(text) > 8 * at_once:
                found, runs = self.cut.finditer(text), []
                while run := [m[0] for m in islice(found, at_once)]:
                    self._learn([run])
                    runs.append(b"".join(map(self.known.__getitem__, run)))
                out[i] = b"".join(runs)
                cuts.append([])
            else:
                cuts.append(self.cut.findall(text) if text else [])
        if cuts:
            self._learn(cuts)
        for i, c in enumerate(cuts):
            if c:
                out[i] = b"".join(map(self.known.__getitem__, c))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBPE:
    return held(f"bpe {path} {pattern}", lambda: ByteBPE(path, pattern))


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids (binary: little-endian unsigned 32-bit numbers), decoded (binary, from the ids alone).

    A null or empty text has no ids. Special tokens are not known: their strings are ordinary text. Repeated rows
    are encoded each; other columns are left out, whatever their names. An empty table gives an empty result.
    `path`: a rank file that every worker can read; `pattern`: the expression that cuts texts before joins.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for piece in slices(batches):
            ids = bpe.encode(piece.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.binary())],
                names=["id", "n_tokens", "ids", "decoded"],
            )

    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, decoded binary").withColumnRenamed("id", id_col)
