"""A training-corpus pipeline: quality rules, line deduplication, near-duplicates, mixing, packing.

Each stage takes all that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.llm import lines, mixing, packing, quality, simhash
from taxoloom.llm.common import materialize
from taxoloom.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go; ``n_chars`` follows. Documents left without a word go where lines were removed."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = lines.dedup_lines(docs.select("doc_id", "text", F.struct(*rest).alias("rest")))
    out = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("rest.n_chars"))
    return out.select(*(length.alias(c) if c == "n_chars" else F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: links are five-word shingle sets with a Jaccard similarity of 0.8 or more."""
    return simhash.dedup(docs, ngram=5, similarity=0.8)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, twice at most; nothing is dropped. A copy is a row of its own."""
    return mixing.mix(docs, max_repeats=2.0).select("own.*")


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(docs, tokenizer_path(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing sources", mixing_sources),
    ("packing", sequence_packing),
]

#: Hashed shingles, the search for the exponent and the tokenizer can't be written in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
