"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.llm import chat, lines, mixing, packing, quality, simhash, suffix, urls, vectors, warc
from taxoloom.sources.scratch import dealt_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt_out(df) if name == "documents" else df


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), ngram=3, radius=3)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"), min_bytes=0).drop("payload")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    turns = chat.parse_transcripts(chat.transcripts(rows), chat.fit_on(rows))
    return turns.select("conv_id", "turn", "role", F.char_length("text").cast("long").alias("n_chars"), F.md5("rendered").alias("rendered_md5"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = quality.apply_policy(quality.apply_policy(rows, quality.BASE, into="base_kept"), quality.POLICIES[-1])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures", (~F.col("base_kept")).alias("base_failed"), "kept")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does, from the ledger of all documents."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents").select("text")), quality.POLICIES[-1])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two mixes: no source read more than twice as often as the least repeated one, nothing dropped; and, of as many tokens as there are, one of an entropy of 2 nats."""
    docs, out = table(spark, sf_dir, "documents").select("doc_id", "text", "source"), []
    for variant, rule in (("repeats", {"max_repeats": 2.0}), ("entropy", {"max_repeats": None, "entropy": 2.0, "epochs": 1.0})):
        rows = mixing.mix(docs, **rule)
        out.append(rows.select(F.lit(variant).alias("variant"), "own.doc_id", "own.source", "epoch", F.col("block").alias("block_key"), F.col("row").alias("row_key"), F.round("weight", 9).alias("weight"), F.round("repeats", 9).alias("repeats")))
    return out[0].unionByName(out[1])


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.drop_repeats(table(spark, sf_dir, "documents"), with_kept=False).drop("kept")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_chat": op3_chat,
    "op4_url_filters": op4_url_filters,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "quality_ablations": quality_ablations,
}

ORACLE_SQL = {
    "op4_url_filters": urls.ORACLE,
    "op7_quality_rules": quality.ORACLE,
    "op8_line_dedup": lines.ORACLE,
    "quality_ablations": quality.ABLATIONS,
}
