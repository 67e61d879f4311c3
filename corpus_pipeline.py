"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lingualake.llm.common import cut, release, scratch, table
from lingualake.llm.jaccard import without_near_copies
from lingualake.llm.mixing import mixed_documents
from lingualake.llm.packing import pack
from lingualake.llm.quality_model import accepted
from lingualake.llm.secrets import redact_secrets


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return without_near_copies(docs, k=5, percent=80, stored=True)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack_sequences),
]

#: The classifier, the sampling and the packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. Each result is written to the shared folder; what a stage needed on its way there is then freed."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with scratch():
            kept = cut(stage(spark, docs, sf_dir), keep=True)
        if k:
            release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
