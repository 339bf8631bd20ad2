"""Secret scans: named patterns, and strings that a tokenizer finds hard to compress.

Text a vocabulary was learned on has several characters a token; keys and passwords have hardly more than one or
two. A candidate is a long unbroken run of key characters; known digests and identifiers are set aside, and of
the rest those with few characters per token are taken for secrets of kind `random`.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, rewrite, slices

#: Order of kinds where spans begin at one place.
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
#: The base pattern takes whole runs and drops those under 16; a run of 16 or more is the same match.
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Characters outside base spans that a run they cut into must still hold to be judged.
_LEAST = 8
#: Set aside: digests by their lengths in hex, and 8-4-4-4-12 identifiers.
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
_ALPHABET = "abcdefghijklmnopqrstuvwxyz" * 2
_IDENTIFIER = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the named patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def encoding(path: str, pattern: str):
    return held(f"tiktoken {path} {pattern}", lambda: _encoding(path, pattern))


def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _spelled(run: str) -> bool:
    """Whether a run without digits is no key by its letters: few different ones, many separators, or the alphabet."""
    letters = re.sub("[^A-Za-z]", "", run)
    return len(set(letters.lower())) < 8 or 6 * (len(run) - len(letters)) > len(run) or letters.lower() in _ALPHABET


def random_spans(text: str, base: list[tuple[int, int, int]], tokenizer, most: float) -> list[tuple[int, int, int]]:
    """Runs with at most `most` characters a token that are neither digest nor identifier.

    What base spans cover of a run is left out of the measure; a run counts whole if `_LEAST` or more of its characters are
    left and random, and so overlaps the base spans in it. A run must hold a letter: rules and numbers are no secrets.
    Without a digit it must not be spelled out (`_spelled`); words run together have two or more characters a token.
    """
    found, first = [], 0
    for m in _RUN.finditer(text):
        run, start, end = m[0], m.start(), m.end()
        while first < len(base) and base[first][2] <= start:
            first += 1  # the runs come in order, and so do spans: those before this run are of no use to later ones
        pieces, at = [], start
        for s, _, e in base[first:]:
            if s >= end:
                break
            pieces.append(text[at:s] if s > at else "")
            at = max(at, min(e, end))
        pieces.append(text[at:end])
        rest = "".join(pieces)
        if len(rest) < _LEAST or not re.search("[A-Za-z]", rest) or (not re.search("[0-9]", rest) and _spelled(rest)):
            continue
        if _DIGEST.fullmatch(run) or _IDENTIFIER.fullmatch(run):
            continue
        if len(rest) / sum(len(tokenizer.encode_ordinary(p)) for p in pieces if p) <= most:
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each covered stretch (overlapping spans together) replaced by the mark."""
    out, at, covered = [], 0, 0
    for s, _, e in sorted(spans):
        if s >= covered:
            out += [text[at:s], mark]
            at = covered = e
        elif e > covered:
            at = covered = e
    return "".join([*out, text[at:]])


def secret_spans(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", most: float = 1.9, mark: str | None = None) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_spans, spans (texts of kind:start:end, code points, end exclusive).

    With `mark`, also `redacted`: the text with every span replaced (null stays null). A null or empty text has no
    spans. Spans of equal start are in the order of KINDS. Repeated rows are scanned each; other columns are left out,
    whatever their names. An empty table gives an empty result. `most`: characters a token up to which a run is random.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(path, pattern)
        for piece in slices(batches):
            rows = []
            for text in piece.column(1).to_pylist():
                base = base_spans(text) if text else []
                every = sorted(base + random_spans(text, base, tokenizer, most)) if text else []
                kinds = [k for _, k, _ in base]
                redacted = redact(text, every, mark) if mark is not None and every else text
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), joined(base), joined(every), redacted))
            n, a, h, b, s, r = zip(*rows, strict=True)
            columns = [piece.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(h, pa.int64()), pa.array(b, pa.string()), pa.array(s, pa.string())]
            names = ["id", "n_assign", "n_access", "n_hex", "base_spans", "spans"]
            if mark is not None:
                columns, names = [*columns, pa.array(r, pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = picked.schema["id"].dataType.simpleString()
    more = ", redacted string" if mark is not None else ""
    return picked.mapInArrow(run, f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string{more}").withColumnRenamed("id", id_col)


def without_secrets(docs: DataFrame, path: str, pattern: str, text_col: str = "text", chars_col: str = "n_chars", most: float = 1.9, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with every secret in a text replaced by the mark, and `chars_col`, where it exists, by the new length of such a text.

    Spans that overlap or touch get one mark; a null or empty text stays as it is. Repeated rows are changed alike, each by
    itself; no order among rows or spans matters. Random runs of under 20 characters are not judged, see `random_spans`.
    """
    names = docs.columns

    def change(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        tokenizer, out, lengths = encoding(path, pattern), [], batch.column(names.index(chars_col)).to_pylist() if chars_col in names else None
        for i, text in enumerate(texts):
            spans = base_spans(text) if text else []
            spans += random_spans(text, spans, tokenizer, most) if text else []
            out.append(redact(text, spans, mark) if spans else text)
            if spans and lengths is not None:
                lengths[i] = len(out[-1])
        new = {text_col: out} | ({chars_col: lengths} if lengths is not None else {})
        return pa.RecordBatch.from_arrays([pa.array(new[n], f.type) if n in new else batch.column(i) for i, (n, f) in enumerate(zip(names, batch.schema, strict=True))], schema=batch.schema)

    return rewrite(docs, text_col, change)
