"""The thin opN_ queries over `documents`."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align
from .caps import near_vectors
from .common import table
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .mixing import mix_sources
from .packing import pack
from .pii import detect_pii, pii_digest
from .pages import extract_pages
from .periods import periodic_runs, run_digest
from .quality_model import quality_scores
from .quality_rules import quality_rules
from .secrets import find_secrets
from .winnow import contamination


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85, stored=True)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    one = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["stop"].cast("string"), x["differences"].cast("string")))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(one, ",").alias("findings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(detect_pii(table(spark, sf_dir, "documents")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return find_secrets(table(spark, sf_dir, "documents")).select("doc_id", "n_candidates", F.size("found").cast("long").alias("n_secrets"), spans.alias("spans"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op10_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def repeated_tail(doc_id: int | None, words: list) -> list:
    """The contract's planted runs: a tenth of the documents, by a checksum of their ids, repeat some words up to their end."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(table(spark, sf_dir, "documents"), prepare=repeated_tail))
