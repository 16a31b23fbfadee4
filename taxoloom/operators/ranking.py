"""Ranks, caps and keep-first operators. Each takes a total order, so results don't depend on partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxoloom.functions import text as tx


def rank(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], into: str = "rank") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int, into: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts groups before the shuffle."""
    return rank(df, by, order, into).where(F.col(into) <= k)


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[str], key: bool = True) -> DataFrame:
    """One row a key, the least by ``order``, by a partial aggregate rather than a window: a hot key costs one row a task."""
    rest = [c for c in df.columns if c not in by]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*by).agg(first.alias("_row")).select(*by, "_row.*").select(*df.columns)


def max_by_key(df: DataFrame, by: Sequence[str], score: str, tie: Sequence[str]) -> DataFrame:
    """The row of each key with the largest score; ties go to the least ``tie``."""
    return keep_first(df.withColumn("_neg", -F.col(score)), by, ["_neg", *tie]).drop("_neg")


def consecutive_dedup(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Drops a row whose value equals that of the row before it."""
    before = F.lag(F.struct(value)).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_before", before).where(F.col("_before").isNull() | ~F.col(f"_before.{value}").eqNullSafe(F.col(value))).drop("_before")


def suffix_duplicates(df: DataFrame, by: Sequence[str], key: str, order: Sequence[str], into: str) -> DataFrame:
    """A key that occurs once in its group stays; else its occurrences get ``_A``, ``_B`` and so on, as characters from ``A`` up:
    past the 26th they are no letters, as in the flow that others read."""
    same = Window.partitionBy(*by, key)
    n = F.count("*").over(same)
    at = F.row_number().over(same.orderBy(*order))
    return df.withColumn(into, F.when(n == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("_"), F.char(64 + at))))


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, into: str, include: bool = False) -> DataFrame:
    """The last non-null ``value`` of the rows before (and of this row if ``include``)."""
    frame = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    return df.withColumn(into, F.last(value, ignorenulls=True).over(frame))


def batches(df: DataFrame, by: Sequence[str], order: Sequence[str], size: int, into: str = "batch") -> DataFrame:
    """Numbers of fixed-size runs within each group."""
    spec = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    at = F.row_number().over(spec.orderBy(*order))
    return df.withColumn(into, F.floor((at - 1) / size).cast("long"))


def global_batches(df: DataFrame, order: Sequence[str], size: int, into: str = "batch") -> DataFrame:
    """Numbers of fixed-size runs of the whole table in order, without one task for all rows.

    Rows are range-partitioned and numbered within their part; the parts' sizes (a row a part) give the offsets.
    """
    parts = df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    sized = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    offset = sized.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    return parts.join(F.broadcast(offset.select("_part", "_before")), "_part").withColumn(into, F.floor((at - 1) / size).cast("long")).drop("_part", "_before")


def hard_cap(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], cap: Column | int) -> DataFrame:
    """Adds ``cap_rank`` and ``reject_reason`` (``exceeds_hard_cap_n``) past the cap."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    ranked = rank(df, by, order, "cap_rank")
    return ranked.withColumn("reject_reason", F.when(F.col("cap_rank") > cap, F.concat(F.lit("exceeds_hard_cap_"), cap.cast("string"))))


def min_max(df: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """``value`` scaled to 0..1 in its group; 1 where all are equal."""
    w = Window.partitionBy(*by)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    return df.withColumn(into, F.when(hi == lo, F.lit(1.0)).otherwise((F.col(value) - lo) / (hi - lo)))


def weighted(df: DataFrame, parts: dict[str, float], into: str) -> DataFrame:
    total = F.lit(0.0)
    for c, w in parts.items():
        total = total + F.lit(w) * F.col(c)
    return df.withColumn(into, total)


def multi_signal(df: DataFrame, by: str, key: str, alpha: float, beta: float, gamma: float, k: int) -> DataFrame:
    """``rrf``, ``esco`` and ``evidence`` -> ``final_score`` and the first ``k`` of each group. Evidence isn't scaled."""
    scaled = min_max(min_max(df, [by], "rrf", "rrf_norm"), [by], "esco", "esco_norm")
    scored = weighted(scaled, {"rrf_norm": alpha, "esco_norm": beta, "evidence": gamma}, "final_score")
    return top_k(scored, [by], [F.round(F.col("final_score"), 6).desc(), F.col(key)], k, "final_rank")


def rerank_prefix(df: DataFrame, by: str, key: str, k: int, w_rerank: float, w_rrf: float) -> DataFrame:
    """The first ``k`` by ``rrf`` take ``w_rerank * cross + w_rrf * rrf``; the others keep ``rrf``. Then all are ranked again.

    ``cross`` is the scorer's column; it is null where the scorer wasn't asked.
    """
    first = rank(df, [by], [F.col("rrf").desc(), F.col(key)], "rrf_rank")
    score = F.when((F.col("rrf_rank") <= k) & F.col("cross").isNotNull(), w_rerank * F.col("cross") + w_rrf * F.col("rrf")).otherwise(F.col("rrf"))
    return rank(first.withColumn("combined", score), [by], [tx.rounded("combined", 6).desc(), F.col(key)], "combined_rank")


def evidence_scores(sims: DataFrame) -> DataFrame:
    """``sims(course, uri, origin, sentence, sim)`` -> score (mean over origins of their best sentence) and the best sentence of the best origin."""
    best = sims.groupBy("course", "uri", "origin").agg(F.max("sim").alias("top"), F.min_by("sentence", F.struct((-F.col("sim")).alias("s"), "sentence")).alias("text"))
    return best.groupBy("course", "uri").agg(F.avg("top").alias("evidence"), F.min_by("text", F.struct((-F.col("top")).alias("s"), "origin")).alias("evidence_text"))


def origin_sentences(sims: DataFrame) -> DataFrame:
    """The best sentence of each origin."""
    best = sims.groupBy("course", "uri", "origin").agg(F.max("sim").alias("score"), F.min_by("sentence", F.struct((-F.col("sim")).alias("s"), "sentence")).alias("sentence"))
    return rank(best, ["course", "uri"], [F.col("score").desc(), F.col("origin")], "origin_rank")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of a key: the same rows however the table is partitioned."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
