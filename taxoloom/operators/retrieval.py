"""Lexical and dense retrieval as joins, and fusion by reciprocal ranks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators.ranking import max_by_key, rank, top_k
from taxoloom.sources.scratch import materialize


def postings(docs: DataFrame, doc: str, text: Column) -> DataFrame:
    """``(doc, dl, term, tf)``; each posting carries its document's length, so that scoring needs no join for it."""
    rows = docs.select(F.col(doc).alias("doc"), tx.tokenize(text).alias("tokens"))
    # An outer explode: for an inner one Spark would filter on the size of the tokens first, and so tokenise twice.
    terms = rows.select("doc", F.size("tokens").alias("dl"), F.explode_outer("tokens").alias("term")).where("term is not null")
    return terms.groupBy("doc", "dl", "term").agg(F.count("*").alias("tf"))


def idf(post: DataFrame, n_docs: int, epsilon: float = 0.25) -> DataFrame:
    """``(term, df, idf)``; negative values become ``epsilon`` times the mean of the raw ones."""
    raw = post.groupBy("term").agg(F.count("*").alias("df")).withColumn("raw", F.log((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    raw = materialize(raw, "terms")
    mean = raw.agg(F.avg("raw")).first()[0] or 0.0
    return raw.select("term", "df", F.when(F.col("raw") < 0, F.lit(epsilon * mean)).otherwise(F.col("raw")).alias("idf"))


@dataclass(frozen=True)
class Index:
    """Postings ``(doc, dl, term, tf)`` and ``(term, df, idf)`` as tables, the number of documents that have a term, and their mean length."""

    post: DataFrame
    idf: DataFrame
    n_docs: int
    avgdl: float


def build_index(docs: DataFrame, doc: str, text: Column, epsilon: float = 0.25) -> Index:
    """Tokenises ``docs`` once. Texts without a term, empty tables too, leave no trace."""
    post = materialize(postings(docs, doc, text), "postings")
    # A document's terms add up to its length.
    n, total = post.agg(F.count_distinct("doc"), F.sum("tf")).first()
    return Index(post, idf(post, n, epsilon), n, total / n if n else 0.0)


def bm25(queries: DataFrame, index: Index, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """``queries(query, text)`` against an index -> ``(query, doc, score)`` for pairs that share a term.

    Only postings of the queries' terms are scored (equi joins, which adaptive execution splits at hot terms). Repeated query tokens
    count again.
    """
    asked = queries.select("query", F.explode(tx.tokenize("text")).alias("term")).groupBy("query", "term").agg(F.count("*").alias("qtf"))
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / (index.avgdl or 1.0)))
    terms = asked.join(index.idf.select("term", "idf"), "term")
    return terms.join(index.post, "term").groupBy("query", "doc").agg(F.sum(F.col("qtf") * weight).alias("score"))


def bm25_top(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """The first ``k`` documents of each query; non-positive scores go after the cut."""
    scored = bm25(queries, index).withColumn("score", F.round("score", 6))
    return top_k(scored, ["query"], [F.col("score").desc(), F.col("doc")], k).where("score > 0")


def l2_normalize(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / norm)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)


#: Bytes of query vectors that may go to every task, and scores that a task holds at once.
QUERY_BYTES, SCORES = 64 << 20, 1 << 22


def dense_top(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
    """``queries(query, vector)``, ``corpus(doc, vector)`` -> the first ``k`` by inner product.

    Queries are gathered in blocks of at most ``QUERY_BYTES`` and scored by matrix products in Arrow batches over the
    corpus; each batch keeps its own first ``k``, so the shuffle carries k rows a query and batch.
    """
    found = None
    n = queries.count()
    dim = (queries.select(F.max(F.size("vector"))).first()[0] or 1) if n else 1
    block = max(1, QUERY_BYTES // (8 * dim))
    parts = -(-n // block) or 1
    for i in range(parts):
        mine = queries if parts == 1 else queries.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == i)
        rows = mine.select("query", F.col("vector").cast("array<double>").alias("vector")).toArrow()
        part = dense_block(rows, corpus, k, exclude_self)
        found = part if found is None else found.unionAll(part)
    return top_k(found, ["query"], [F.col("score").desc(), F.col("doc")], k)


def dense_block(rows: pa.Table, corpus: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    ids = rows.column("query").to_numpy()
    q = np.array(rows.column("vector").to_pylist(), np.float64).reshape(len(ids), -1) if len(ids) else np.zeros((0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc = b.column("doc").to_numpy()
            if not len(doc) or not len(ids):
                continue
            x = b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(doc), -1)
            some = max(1, SCORES // len(doc))
            for lo in range(0, len(ids), some):
                yield best(ids[lo : lo + some], q[lo : lo + some], doc, x)

    def best(own: np.ndarray, q: np.ndarray, doc: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        s = np.round(np.einsum("qd,nd->qn", q, x, optimize=True), 6) + 0.0
        if exclude_self:
            s[own[:, None] == doc[None, :]] = -np.inf
        least = np.partition(s, -k, axis=1)[:, -k] if k < len(doc) else np.full(len(own), -np.inf)
        row, at = np.nonzero((s >= least[:, None]) & np.isfinite(s))
        by = np.lexsort((doc[at], -s[row, at], row))
        row, at = row[by], at[by]
        first = np.searchsorted(row, row)
        kept = np.arange(len(row)) - first < k
        row, at = row[kept], at[kept]
        return pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(doc[at]), pa.array(s[row, at])], ["query", "doc", "score"])

    return corpus.select(F.col("doc").cast("long"), "vector").mapInArrow(run, "query long, doc long, score double")


#: Bytes of texts without an inner word that may go to every task.
SHORT_BYTES = 8 << 20


def containing(queries: DataFrame, docs: DataFrame, index: Index) -> DataFrame:
    """``queries(query, text)``, ``docs(doc, text)`` and their index -> ``(query, doc)`` for documents that hold the query's text as it is.

    All words of a text but the first and the last are words of a document that holds it, so that only postings of the rarest of these are
    compared. Texts of fewer words are tried on all documents, behind a check of their size. Null and empty texts are held by none.
    """
    asked = queries.select("query", "text").where("text <> ''").distinct()
    tokens = tx.tokenize("text")
    inner = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0)))
    words = asked.select("query", "text", F.explode(inner).alias("term")).join(index.idf.select("term", "df"), "term", "left")
    rarest = words.groupBy("query", "text").agg(F.min_by("term", F.struct(F.coalesce("df", F.lit(0)).alias("n"), "term")).alias("term"))
    likely = rarest.join(index.post.select("doc", "term"), "term").join(docs.select("doc", F.col("text").alias("whole")), "doc")
    found = likely.where(F.contains("whole", "text")).select("query", "doc")
    few = asked.where(F.size(inner) == 0)
    n, size = few.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if size > SHORT_BYTES:
        raise ValueError(f"{size} bytes of texts of fewer than three words: ask for them in parts of {SHORT_BYTES}")
    if n:
        found = found.unionByName(docs.join(few.select("query", F.col("text").alias("needle")).hint("broadcast"), F.contains("text", "needle")).select("query", "doc"))
    return found.distinct()


def channel_ranks(hits: DataFrame, by: list[str]) -> DataFrame:
    """``hits(*by, channel, uri, score)`` deduplicated by the best score, and ranked within each channel."""
    best = max_by_key(hits, [*by, "channel", "uri"], "score", ["channel"]) if "rank" not in hits.columns else hits.groupBy(*by, "channel", "uri").agg(F.max("score").alias("score"), F.min("rank").alias("query_rank"))
    return rank(best, [*by, "channel"], [F.col("score").desc(), F.col("uri")], "channel_rank")


def agreement(a: Column, b: Column) -> Column:
    """How two channels' ranks agree."""
    return (
        F.when(a.isNull() | b.isNull(), "SINGLE_RETRIEVER")
        .when((a <= 5) & (b <= 5), "STRONG")
        .when((a > 15) & (b > 15), "WEAK")
        .otherwise("PARTIAL")
    )


def rrf(hits: DataFrame, by: list[str], k: int = 60, top: int | None = None, channels: tuple[str, ...] = ("bm25", "dense")) -> DataFrame:
    """Reciprocal rank fusion: the sum over channels of 1 / (k + rank), each channel's least rank, their agreement.

    ``hits`` may hold several passes and evidences of one channel; ``by`` then names the course alone, and ranks are
    taken within (course, evidence, channel) if ``hits`` has ``evidence_id``.
    """
    inner = [*by, *(["evidence_id"] if "evidence_id" in hits.columns else [])]
    ranked = channel_ranks(hits, inner)
    shown = "query_rank" if "query_rank" in ranked.columns else "channel_rank"
    fused = ranked.groupBy(*by, "uri").agg(
        F.sum(1 / (k + F.col("channel_rank"))).alias("rrf"),
        *(F.min(F.when(F.col("channel") == c, F.col(shown))).alias(f"{c}_rank") for c in channels),
        F.array_sort(F.collect_set("channel")).alias("channels"),
    )
    fused = fused.withColumn("rrf", F.round("rrf", 8))
    if len(channels) >= 2:
        fused = fused.withColumn("agreement", agreement(F.col(f"{channels[0]}_rank"), F.col(f"{channels[1]}_rank")))
    fused = rank(fused, by, [F.col("rrf").desc(), F.col("uri")], "fused_rank")
    return fused if top is None else fused.where(F.col("fused_rank") <= top)


def ordered_distinct(value: Column | str, position: Column | str) -> Column:
    """Aggregate: distinct values in the order in which they are first seen."""
    pairs = F.array_sort(F.collect_set(F.struct(tx.col(position).alias("p"), tx.col(value).alias("v"))))
    return F.array_distinct(F.transform(pairs, lambda x: x["v"]))


def mention_map(df: DataFrame, by: list[str]) -> DataFrame:
    """``evidence_id -> mentions`` as a map, mentions in order of ``pos``."""
    lists = df.groupBy(*by, "evidence_id").agg(ordered_distinct("mention", "pos").alias("mentions"))
    return lists.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("evidence_id", "mentions")))).alias("evidence_mentions"))


def hybrid(queries: DataFrame, index: Index, vectors: DataFrame, corpus: DataFrame, k: int, context_vectors: DataFrame | None = None, direct: DataFrame | None = None) -> DataFrame:
    """All channels' hits in one table ``(query, channel, uri, score, rank)``.

    ``context_vectors(query, vector)``: a second dense pass, over queries with their source text (:func:`with_context`); its hits join
    the ``dense`` channel, a document's better score and rank counting. ``direct(query, uri, score)``: candidates that an extractor
    names itself, as the channel ``esco_extract``.
    """
    hits = lambda df, channel: df.select("query", F.lit(channel).alias("channel"), F.col("doc").alias("uri"), "score", "rank")
    dense = hits(dense_top(vectors, corpus, k), "dense")
    if context_vectors is not None:
        both = dense.unionByName(hits(dense_top(context_vectors, corpus, k), "dense"))
        dense = both.groupBy("query", "channel", "uri").agg(F.max("score").alias("score"), F.min("rank").alias("rank"))
    out = hits(bm25_top(queries, index, k), "bm25").unionByName(dense)
    if direct is not None:
        named = rank(direct, ["query"], [F.col("score").desc(), F.col("uri")])
        out = out.unionByName(named.select("query", F.lit("esco_extract").alias("channel"), "uri", "score", "rank"))
    return out


def with_context(text: Column, source: Column) -> Column:
    """The text of a context pass; null where there is no source text, so that no second pass is made."""
    return F.when(F.coalesce(source, F.lit("")) != "", F.concat(text, F.lit(". Context: "), source))


def rerank_texts(candidates: DataFrame) -> DataFrame:
    """``candidates(course_title, label, description, mentions, source_texts, ...)`` with what a cross scorer compares: ``context``, the
    title and the first mention (without one, the first source text), and ``candidate``, label and description."""
    one = lambda c: F.get(F.col(c), F.lit(0))
    said = F.when(F.size("mentions") > 0, one("mentions")).otherwise(F.coalesce(one("source_texts"), F.lit("")))
    joined = lambda a, b: F.trim(F.concat(F.coalesce(a, F.lit("")), F.lit(". "), F.coalesce(b, F.lit(""))))
    return candidates.withColumn("context", joined(F.col("course_title"), said)).withColumn("candidate", joined(F.col("label"), F.col("description")))
