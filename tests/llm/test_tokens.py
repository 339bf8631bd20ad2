import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from postlake.llm import queries
from postlake.llm.byte_bpe import ByteBPE, PairTable, encode_decode
from postlake.llm.token_counts import PieceCounter, token_counts

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
_rnd = random.Random(1)
ODD = [
    None, "", " ", "  a  b ", "<|endoftext|> <s> a </s> <unk> <0x0A>", "a" * 3000, "\x1c\x1d a\x85b​c d", "é" * 700, "日本語テキスト漢字" * 40,
    "don't I'LL we've 123456 ____---===\n\n\n  \t x", " " * 1000 + "x", "ab" * 9000, "﻿ x\x00y ▁ ▁▁a x▁y", "▁", " a", "a ",
    "".join(_rnd.choice("abcdefghij") for _ in range(20_000)),
    "".join(chr(_rnd.choice([_rnd.randrange(32, 127), _rnd.randrange(160, 0x3000), _rnd.randrange(0x1F300, 0x1F700)])) for _ in range(3000)),
]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, make, reference):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "x")]
    got = encode_decode(make(rows), RANKS, P.PATTERN).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i, t in rows:
        want = reference.encode_ordinary(t or "")
        assert np.frombuffer(bytes(by[i]["ids"]), "<u4").tolist() == want and by[i]["n_tokens"] == len(want)
        assert bytes(by[i]["decoded"]) == (t or "").encode()


def test_bpe_in_small_matrices_and_long_runs(reference):
    bpe = ByteBPE(RANKS, P.PATTERN, keep=50, cells=64, longest_row=16)
    for texts in (ODD, ODD[::-1]):
        for t, ids in zip(texts, bpe.encode(texts, at_once=100), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t or "")


def test_pair_table():
    left, right = np.divmod(np.arange(900), 30)
    table = PairTable(left, right, np.arange(900, dtype=np.int32))
    assert (table.get(left, right) == np.arange(900)).all()
    assert (table.get(np.array([-1, 31]), np.array([0, 0])) == 2**31 - 1).all()


def test_bpe_query_digests(spark, sf, reference):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op2_byte_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(reference.encode_ordinary(docs[r["doc_id"]] or ""), "<u4").tobytes()
        assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()


def test_counts_equal_the_library(spark, make):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3])]
    got = token_counts(make(rows), MODEL, limit=100).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(
        (i, len((t or "").encode()), n := len(model.encode(t or "")), n > 100) for i, t in rows
    )
    small = PieceCounter(MODEL, keep=20, part_chars=7)
    assert small.safe and small.counts(ODD) == [len(model.encode(t or "")) for t in ODD]


def test_empty_tables(spark, make):
    empty = make([(1, "x")]).where("false")
    assert encode_decode(empty, RANKS, P.PATTERN).count() == 0
    assert token_counts(empty, MODEL).count() == 0
