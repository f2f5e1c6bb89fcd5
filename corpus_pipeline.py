"""The corpus pipeline: quality rules, near duplicates, repeated passages, source mix, token ids.

Each stage takes all documents that its predecessor kept and returns them with the columns of `documents`; the last returns
token ids. `run` writes each stage's result to the shared folder and reads it back, so a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, simhash, suffix_dedup
from tidemark.llm.common import saved, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines. Null and empty texts go."""
    model = quality.train_lines(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("text", F.struct("*").alias("doc")), model).where("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Two documents link if their sets of five-word shingles have an exact similarity of 0.8 or more; groups are what links
    reach. Fingerprints of 1,024 bits only propose: at 0.8 they differ in about 155 bits, give or take 11, so a radius of 224
    proposes such pairs, and those it proposes down to 0.6 are compared and refused.
    """
    return simhash.one_of_each(docs, shingle=5, words=16, radius=224, min_keys=8, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 50 bytes that a document with a smaller id has too; none is dropped.

    A character that loses a byte goes whole. n_chars, if there, is counted anew.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    cleaned = suffix_dedup.without_repeats(docs.select("doc_id", "text", others.alias("doc")), length=50, as_text=True)
    renewed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cleaned.select(*[(renewed[c] if c in renewed else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not, once or twice."""
    return mixing.repeated_docs(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with n_tokens and ids, and as text what the ids decode to."""
    # written in between, so that no task runs the workers of both, and in small blocks, for less memory
    encoded = saved(bpe.encode(docs, RANKS, block_bytes=2 << 20), "encoded").withColumn("text", F.col("ids"))
    return bpe.decode(encoded, RANKS, ids="text", out="text").withColumn("text", F.col("text").cast("string"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# Models, XXH64 and merges have no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
