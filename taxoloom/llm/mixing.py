"""Mixing sources to target weights by temperature, and realising the weights as block permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxoloom.llm.common import materialize, spread

#: A source is cut into cells of about so many rows, and into so many cells at most (its cells are ranked in one window).
CELL_ROWS, CELLS = 256, 65536
#: Each job tries so many exponents, and narrows the interval as often.
TRIALS, ROUNDS = 16, 9


def hashed(*parts: Column | int | str) -> Column:
    """32 bits of an MD5 as a long."""
    text = F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_key(c: Column) -> Column:
    """A key that is never null: a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def fit_exponent(shares: DataFrame, max_repeats: float | None = None, entropy: float | None = None) -> float:
    """``shares(p)``, positive and summing to 1 -> the exponent a in [0, 1] of weights p ** a.

    ``max_repeats``: the least a at which no source is repeated more often, if the least repeated is read once.
    ``entropy`` (nats): the largest a whose weights have at least that entropy. Both fall as a grows, so the
    interval is cut by evaluating a row of exponents in one aggregate; no share is collected.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give max_repeats or entropy")
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        tries = [lo + (hi - lo) * i / TRIALS for i in range(TRIALS + 1)]
        if max_repeats is not None:
            got = shares.agg(*(F.max(F.pow("p", F.lit(a - 1))) / F.min(F.pow("p", F.lit(a - 1))) for a in tries)).first()
            good = [x is None or x <= max_repeats for x in got]
            at = next((i for i, g in enumerate(good) if g), TRIALS)
            lo, hi = tries[max(0, at - 1)], tries[at]
            if at == 0:
                return tries[0]
        else:
            z = [F.sum(F.pow("p", F.lit(a))) for a in tries]
            got = shares.agg(*(F.log(x) - F.lit(a) * F.sum(F.pow("p", F.lit(a)) * F.log("p")) / x for a, x in zip(tries, z, strict=True))).first()
            good = [x is None or x >= entropy for x in got]
            at = max((i for i, g in enumerate(good) if g), default=0)
            lo, hi = tries[at], tries[min(TRIALS, at + 1)]
            if at == TRIALS:
                return tries[-1]
    return hi if max_repeats is not None else lo


def keyed(docs: DataFrame) -> DataFrame:
    """``(own, h, copy, s, n)``: a row of ``docs`` as a struct, what tells it from other rows, its source's key and its tokens."""
    rows = spread(docs.select(F.struct(*docs.columns).alias("own")))
    return rows.select("own", "h", "copy", source_key(F.col("own")["source"]).alias("s"), tokens_of(F.col("own")["text"].cast("string")).alias("n"))


def plan(rows: DataFrame, max_repeats: float | None = 2.0, entropy: float | None = None, budget: int | None = None, epochs: float | None = None, seed: int = 0) -> DataFrame:
    """How often the rows of :func:`keyed` are taken, a row a source: ``(s, source_tokens, weight, repeats, whole, cells, ...)``.

    Each row of a source is taken ``whole`` times, and once more if it comes before the edge (``edge_block, edge_cell, edge_row,
    edge_h, edge_copy``) in the next permutation of blocks and of rows in them. ``budget``: tokens in all, or ``epochs``: as a multiple
    of all tokens; by default so many that the least repeated source is read exactly once, so nothing is dropped. Sources without a
    token are read once.
    """
    slim = materialize(rows.select("s", "h", "copy", "n"), "slim")
    cells = max(1, min(CELLS, -(-slim.count() // CELL_ROWS)))
    slim = slim.withColumn("cell", cell_of(F.lit(cells), seed))
    blocks = materialize(slim.groupBy("s", "cell").agg(F.sum("n").alias("t")), "blocks")
    sources = blocks.groupBy("s").agg(F.sum("t").alias("source_tokens"))
    total = sources.agg(F.sum("source_tokens")).first()[0] or 1
    shares = sources.where("source_tokens > 0").withColumn("p", F.col("source_tokens") / F.lit(total))
    a = fit_exponent(shares, max_repeats, entropy)
    norm = shares.agg(F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a)))).first()
    size = budget if budget is not None else epochs * total if epochs is not None else None
    # repeats = weight * size / source_tokens, written so that the least repeated source gets exactly 1 by default.
    level = F.lit(norm[1] or 1.0) if size is None else F.lit(size / total / (norm[0] or 1))
    weight = F.pow("p", F.lit(a)) / F.lit(norm[0] or 1.0)
    rated = sources.withColumn("p", F.col("source_tokens") / F.lit(total))
    repeats = F.when(F.col("source_tokens") == 0, 1.0).otherwise(F.pow("p", F.lit(a - 1)) * level)
    rated = rated.select("s", "source_tokens", F.when(F.col("source_tokens") > 0, weight).otherwise(0.0).alias("weight"), F.round(repeats, 9).alias("repeats"))
    rated = rated.withColumn("whole", F.floor("repeats").cast("int"))
    rated = rated.withColumn("left", F.floor((F.col("repeats") - F.col("whole")) * F.col("source_tokens")).cast("long"))
    order = Window.partitionBy("s").orderBy("block", "cell").rowsBetween(Window.unboundedPreceding, -1)
    ranked = blocks.join(rated, "s").withColumn("block", block_key(seed)).withColumn("room", F.col("left") - F.coalesce(F.sum("t").over(order), F.lit(0)))
    edge = materialize(ranked.where("room >= 0 and room < t").select("s", "cell", "block", "room", "whole"), "edge")
    inner = Window.partitionBy("s").orderBy("row", "h", "copy").rowsBetween(Window.unboundedPreceding, 0)
    upto = slim.join(edge, ["s", "cell"]).withColumn("row", row_key(seed)).withColumn("upto", F.sum("n").over(inner)).where("upto <= room")
    last = upto.groupBy("s").agg(F.max(F.struct("row", "h", "copy")).alias("e"))
    told = edge.select("s", F.col("block").alias("edge_block"), F.col("cell").alias("edge_cell")).join(last, "s", "left")
    return rated.join(told, "s", "left").select(
        "s", "source_tokens", "weight", "repeats", "whole", F.lit(cells).alias("cells"), "edge_block", "edge_cell", F.col("e.row").alias("edge_row"), F.col("e.h").alias("edge_h"), F.col("e.copy").alias("edge_copy")
    )


def cell_of(cells: Column, seed: int) -> Column:
    return F.pmod(hashed(seed, "cell", F.col("h"), F.col("copy")), cells).cast("int")


def block_key(seed: int) -> Column:
    return hashed(seed, "block", F.col("whole"), F.col("s"), F.col("cell"))


def row_key(seed: int) -> Column:
    return hashed(seed, "row", F.col("whole"), F.col("h"), F.col("copy"))


#: A plan of so many sources at most (some 200 bytes each) goes to every task; a larger one is joined by its key.
SMALL = 50_000


def mix(docs: DataFrame, max_repeats: float | None = 2.0, entropy: float | None = None, budget: int | None = None, epochs: float | None = None, seed: int = 0) -> DataFrame:
    """``(own, epoch, block, row, weight, repeats)``, a row for each copy of a row of ``docs``, which is the struct ``own``.

    Ordered by ``(epoch, block, row)`` an epoch is a permutation of blocks, and of rows in them; nothing is sorted
    here. Null and empty texts have no tokens; a null source is a source. Ids aren't read: null ids and repeated rows are rows as others.
    Columns may have any names, as they stay in ``own``. An empty table gives none.
    """
    rows = keyed(docs)
    todo = materialize(plan(rows, max_repeats, entropy, budget, epochs, seed), "plan")
    joined = rows.join(F.broadcast(todo) if todo.count() <= SMALL else todo, "s").withColumn("cell", cell_of(F.col("cells"), seed))
    joined = joined.withColumn("block", block_key(seed)).withColumn("row", row_key(seed))
    before = (F.col("block") < F.col("edge_block")) | ((F.col("block") == F.col("edge_block")) & (F.col("cell") < F.col("edge_cell")))
    inside = (F.col("cell") == F.col("edge_cell")) & (F.struct("row", "h", "copy") <= F.struct(F.col("edge_row").alias("row"), F.col("edge_h").alias("h"), F.col("edge_copy").alias("copy"))) & F.col("edge_row").isNotNull()
    n = F.col("whole") + F.coalesce(before | inside, F.lit(False)).cast("int")
    copies = joined.where(n > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("whole", F.col("epoch"))
    return copies.select("own", "epoch", block_key(seed).alias("block"), row_key(seed).alias("row"), "weight", "repeats")
