"""Corpus pipeline: quality classifier, SimHash near-dedup, suffix-array dedup, decontamination, BPE encoding.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a frame. ``run`` applies them to the
documents table, writing each stage's result as Parquet in the shared scratch folder and reading it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partnerkpi.llm import bpe, decontam, quality_crf, simhash, suffix_dedup
from partnerkpi.llm.common import read_table, ship_code, written
from partnerkpi.llm.queries import training_labels

#: Documents of a lower quality score are rejected (the cut of op6's ``predicted``).
MIN_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_crf.fit(docs, training_labels(spark, sf_dir), label="quality")
    return docs.withColumn("__score", quality_crf.score_column(model)).where(f"__score >= {MIN_QUALITY}").drop("__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words or more are cut where they are not held first."""
    return suffix_dedup.cut_repeats(docs, min_words=50)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    return decontam.remove_documents(docs, read_table(spark, sf_dir, "benchmark"), n=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their packed token ids and token counts."""
    import public_tokenizers

    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(docs, ranks).withColumn("n_tokens", bpe.n_tokens())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Trained and hashed stages have no SQL form; tests hold run() against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole documents table."""
    ship_code(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
