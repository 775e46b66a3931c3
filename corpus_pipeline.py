"""The corpus pipeline: documents to shuffled, tokenised training rows.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's documents. Every stage works on all
rows its predecessor kept. Nulls, empty texts, repeated rows, empty tables and
extra columns are treated as the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, mixing, neardup, repeats
from tidemark.llm.common import table
from tidemark.sinks.scratch import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those it rejects go."""
    found = language.identify(docs, language.fit(docs), into="_pred", score="_score")
    return found.where(language.accepted("_pred", "_score")).drop("_pred", "_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies, that of the smallest id. Rows without an id stay."""
    gone = neardup.groups(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(materialize(spark, gone, "near-copies"), "doc_id", "left_anti")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    done = repeats.remove_repeats(docs, as_text=True)
    done = done.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")})
    return done.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have weights by the root of their sizes, in shuffled order."""
    return mixing.mix(docs).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian u32) of every document, with the hash of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, offsets=None, decoded="decoded")
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return done.select("doc_id", "lang", "source", n_tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", remove_repeats),
    ("mix", mix_sources),
    ("tokens", tokenise),
]
#: Compression, sketches and merges have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
