"""Token counts under a sentencepiece model, without keeping the tokens.

Texts travel to Python workers in Arrow batches, are dealt into steps of about equal bytes, and only lengths
come back. No vocabulary entry of a model of this kind joins a letter to a following word mark, so the place
between a character and the next space is a safe boundary: what stands on its sides is tokenized alike together
and apart. Long texts are cut there, and so each distinct segment of a step is encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_SLICE_BYTES, held, slices

_MARK = "▁"
_SEGMENT = re.compile(r" +[^ ]*")


class PieceCounter:
    """Counts tokens of texts; remembers the counts of at most `keep` segments."""

    def __init__(self, path: str, keep: int = 150_000, part_chars: int = 1 << 18):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # only where no entry crosses a boundary may texts be cut there
        self.safe = not any(_MARK in p.lstrip(_MARK) or (p.startswith(_MARK * 2) and p.strip(_MARK)) for p in pieces)
        self.keep, self.part_chars = keep, part_chars
        # a space that ends a text is a word mark alone, which no call with an empty string would give
        self.lone = {"": 1 if self.model.piece_to_id(_MARK) != self.model.unk_id() else len(_MARK.encode())}
        self.known: dict[str, int] = dict(self.lone)

    def parts(self, text: str) -> Iterator[str]:
        """The text without its first, implied space, cut at safe boundaries into parts of bounded length; each part lacks the space before it."""
        start = 0
        while len(text) - start > self.part_chars:
            at = text.find(" ", start + self.part_chars)
            while at > start and text[at - 1] == " ":  # inside a run of spaces no cut is safe: take the next run
                at = text.find(" ", at + 1)
            if at < 0:
                break
            yield text[start:at]
            start = at + 1
        yield text[start:]

    @staticmethod
    def segments(part: str) -> list[str]:
        words = part.split(" ")
        return words if "" not in words else [x[1:] for x in _SEGMENT.findall(" " + part)]

    def counts(self, texts: list[str | None]) -> list[int]:
        texts = [(t or "").replace(_MARK, " ") for t in texts]
        if not self.safe:
            return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []
        out, waiting, held = [0] * len(texts), [], 0

        def settle() -> None:
            new = list(set().union(*(s for _, s in waiting)) - self.known.keys())
            if len(self.known) + len(new) > self.keep:
                self.known = dict(self.lone)
                new = list(set().union(*(s for _, s in waiting)) - self.lone.keys())
            self.known.update(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True))
            for i, s in waiting:
                out[i] += sum(map(self.known.__getitem__, s))
            waiting.clear()

        for i, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                waiting.append((i, self.segments(part)))
                held += len(part)
                if held >= 4 * self.part_chars:
                    settle()
                    held = 0
        if waiting:
            settle()
        return out


def counter(path: str) -> PieceCounter:
    return held(f"pieces {path}", lambda: PieceCounter(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; other columns are left out,
    whatever their names. An empty table gives an empty result. `path`: a sentencepiece model that every worker can read.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for piece in slices(batches, most=LONG_SLICE_BYTES):
            texts = piece.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), pa.array(count.counts(texts), pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = picked.schema["id"].dataType.simpleString()
    counted = picked.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
