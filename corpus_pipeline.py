"""From raw documents to token ids, in five stages. Each takes (spark, docs, sf_dir); all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.byte_bpe import encode_decode
from postlake.llm.common import cut, table
from postlake.llm.decontaminate import without_contaminated
from postlake.llm.near_dedup import one_of_each
from postlake.llm.quality import good_quality
from postlake.llm.secrets import without_secrets

RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts get the score of the bias; null labels teach nothing; repeated rows are judged alike.
    """
    return good_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group linked by five-word shingles at 0.8 or more.

    Null and empty texts are linked with nothing and stay; of rows that share an id one stays, rows with a null id all do.
    """
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of three words or more.

    Null and empty texts hold none; rows with a null id stay; repeated rows go or stay together.
    """
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; a null text stays null. Overlapping spans get one mark."""
    return without_secrets(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (packed little-endian unsigned 32-bit), with digests of the ids and of the bytes decoded from them.

    A null or empty text has no ids. Repeated rows are encoded each.
    """
    done = encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("encode", encode)]

#: Learned weights and random projections have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; what a stage keeps is written to the shared checkpoint folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if i < len(STAGES) - 1 else docs
    return docs
