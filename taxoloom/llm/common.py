"""What several operators share: slices of texts, equal rows spread, and connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.sources.scratch import forget, materialize, scratch_path, shared_dir

__all__ = ["SEED", "connected_components", "forget", "materialize", "pieces", "scratch_path", "shared_dir", "spread"]

#: Of the hashes of shingles.
SEED = 42
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """Slices of about ``size`` bytes that end between words."""
    at = 0
    while at < len(data):
        to = at + size
        if to < len(data) and (m := BLANK.search(data, to)):
            to = m.start()
        elif to < len(data):
            to = len(data)
        yield data[at:to]
        at = to


def spread(rows: DataFrame, most: int = 1000) -> DataFrame:
    """Adds ``h``, a hash of the row, and ``copy``, which numbers equal rows where there are more than ``most``, so that ``(h, copy)`` deals
    out any table evenly. Both follow from the rows alone, so a task that is run again gives each row the same.

    Rows that recur so often are looked for first, by their hashes; they are counted, and dealt out again from their counts.
    """
    keyed = rows.withColumn("h", F.xxhash64(*rows.columns))
    hot = materialize(keyed.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") > most).select("h"), "hot")
    plain = keyed.withColumn("copy", F.lit(0).cast("long"))
    if hot.isEmpty():
        forget(hot)
        return plain
    runs = keyed.join(hot, "h", "left_semi").groupBy(*keyed.columns).agg(F.count("*").alias("c"))
    runs = runs.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / most)))).repartition("h", "run")
    copies = F.sequence(F.col("run") * most, F.least((F.col("run") + 1) * most, F.col("c")) - 1)
    again = runs.select(*keyed.columns, F.explode(copies).alias("copy"))
    return plain.join(hot, "h", "left_anti").select(*again.columns).unionByName(again)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(src, dst)`` -> ``(node, component)`` with the smallest reachable id, for every node of an edge.

    Alternating large-star and small-star rounds. A round keeps at most one row an edge, uses
    partial aggregates and plain equi joins (which adaptive execution splits when a centre is hot),
    and ends as a table in the shared folder. The driver sees a count and a checksum a round.
    Null ends and self loops are dropped.
    """
    now = edges.where("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")
    )
    now, before = materialize(now.distinct(), "edges"), None
    for _ in range(max_rounds):
        sym = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select("b", "a"))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = sym.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        new = (
            star.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        new = materialize(new, "edges")
        mark = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b") % 1_000_033)).first())
        forget(now)
        now = new
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
