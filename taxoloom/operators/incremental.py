"""Change detection and caches as anti joins on hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions import text as tx


def stored_hash(stored: Column, *cols: str) -> Column:
    """The hash that came with a record, else one of its fields."""
    return F.coalesce(F.nullif(stored, F.lit("")), tx.content_hash(*cols))


def changes(now: DataFrame, before: DataFrame, key: str, digest: str) -> DataFrame:
    """``status``: ``new``, ``changed``, ``unchanged`` or ``gone`` for every key of either table."""
    a, b = now.select(key, F.col(digest).alias("_now")), before.select(key, F.col(digest).alias("_then"))
    status = (
        F.when(F.col("_then").isNull(), "new").when(F.col("_now").isNull(), "gone").when(F.col("_now") == F.col("_then"), "unchanged").otherwise("changed")
    )
    return a.join(b, key, "full").select(key, status.alias("status"))


def to_process(now: DataFrame, before: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows that are new or changed: nothing else is worked on again."""
    return now.join(before.select(key, digest), [key, digest], "left_anti")


def rebuild(now: DataFrame, before: DataFrame, existing: DataFrame, key: str, digest: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``existing`` with the rows of keys that are new or changed worked out again by ``work``, and without those of keys that are gone.

    ``now`` and ``before`` hold keys and their hashes; what ``work`` returns has ``key`` and the columns of ``existing``.
    """
    same = now.select(key, digest).join(before.select(key, digest), [key, digest], "left_semi").select(key)
    kept = existing.join(same, key, "left_semi")
    return kept.unionByName(work(to_process(now, before, key, digest)).select(*existing.columns))


def cache_misses(rows: DataFrame, cache: DataFrame, evidence: str = "evidence_id", version: str = "v1") -> DataFrame:
    keyed = rows.withColumn("cache_key", tx.cache_key(evidence, version))
    return keyed.join(cache.select("cache_key"), "cache_key", "left_anti")
