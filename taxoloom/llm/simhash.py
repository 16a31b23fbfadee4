"""SimHash near-duplicates: fingerprints, and links between them by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.llm import shingles
from taxoloom.llm.common import SEED, connected_components, forget, materialize, pieces

BITS = 64
#: Rows of one window of the comparison, and of one bucket before it is split into pairs of parts.
WINDOW, BUCKET = 512, 2048
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Shingles that are hashed at once.
SLICE = 1 << 16


def fingerprint(text: str | None, ngram: int = 3) -> int:
    """The 64-bit SimHash of the lower-cased (A-Z) words' shingles, repeats counted; 0 without words.

    Fewer words than ``ngram`` make one shingle. A long text is split and hashed in slices.
    """
    total, ones, words = 0, np.zeros(BITS, np.int64), []
    for piece in pieces((text or "").encode()):
        words += piece.lower().split()
        for at in range(0, max(0, len(words) - ngram + 1), SLICE):
            part = words[at : at + SLICE + ngram - 1]
            grams = map(b" ".join, zip(*(part[i:] for i in range(ngram)), strict=False))
            n = len(part) - ngram + 1
            ones += counts(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", n))
            total += n
        if len(words) >= ngram:
            words = words[len(words) - ngram + 1 :]
    if not total and words:
        total, ones = 1, counts(np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], "<u8"))
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, ngram: int = 3) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp)``, a row a row; ``fp`` is the fingerprint as a signed long. Null and empty texts: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, ngram) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def close_pairs(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of ``fps`` (uint64, one or more words a row) that differ in ``radius`` bits or fewer.

    Bit planes hold one bit of 64 fingerprints a word. A query is XORed against a plane at a time;
    the differences are added into vertical counters by carry-save, which start so that the count
    ``radius + 1`` overflows. Every 8 planes, words in which all 64 lanes have overflowed are abandoned.
    """
    m, words = len(fps), -(-len(fps) // 64)
    bits = np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8).reshape(m, -1), axis=1, bitorder="little")
    lanes = np.zeros((words * 64, bits.shape[1]), np.uint8)
    lanes[:m] = bits
    planes = np.packbits(np.ascontiguousarray(lanes.T), axis=1, bitorder="little").view("<u8")
    masks = np.where(bits.T, ONES, np.uint64(0))
    q, w = (x.astype(np.int32) for x in np.nonzero(np.arange(m)[:, None] // 64 <= np.arange(words)[None, :]))
    #: Lanes up to the query itself and those past the end count as over from the start.
    low = np.clip(q - 64 * w + 1, 0, 64).astype(np.uint64)
    over = np.where(low == 64, ONES, (np.uint64(1) << (low & np.uint64(63))) - np.uint64(1))
    if m % 64:
        over |= np.where(w == words - 1, ONES << np.uint64(m % 64), np.uint64(0))
    width = max(1, (radius + 1 - 1).bit_length())
    start = (1 << width) - 1 - radius
    counters = [np.full(len(q), ONES if start >> b & 1 else 0, np.uint64) for b in range(width)]
    for b in range(len(planes)):
        if b % 8 == 0:
            alive = over != ONES
            if not alive.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if alive.mean() < 0.8:
                q, w, over, counters = q[alive], w[alive], over[alive], [c[alive] for c in counters]
        carry = planes[b][w] ^ masks[b][q]
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
        over |= carry
    near = np.flatnonzero(over != ONES)
    row, lane = np.nonzero(np.unpackbits((~over[near]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return q[near[row]].astype(np.int64), w[near[row]].astype(np.int64) * 64 + lane


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def cells(reps: DataFrame, radius: int, n: int, bucket: int = BUCKET) -> DataFrame:
    """``reps(fp, rep)`` -> ``(t, key, i, j, fp, rep)``: rows to be compared share the first four.

    The bits are cut into blocks of which two fingerprints within ``radius`` share all but
    ``radius``; a table ``t`` keys on one choice of those. More blocks make narrower keys as ``n`` grows.
    Hot buckets are cut, see :func:`cut`.
    """
    blocks = next(b for b in range(radius + 1, BITS + 1) if n >> sum(BITS * (i + 1) // b - BITS * i // b for i in range(b - radius)) <= 64 or b > radius + 4)
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    tables = []
    for t, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in kept)
        mask -= (1 << 64) * (mask >> 63)
        tables.append(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("key")))
    return cut(reps.select(F.explode(F.array(*tables)).alias("x"), "fp", "rep").select("x.t", "x.key", "fp", "rep"), ["t", "key"], F.xxhash64("fp"), bucket)


def cut(dealt: DataFrame, by: list[str], h: Column, bucket: int = BUCKET) -> DataFrame:
    """Adds ``i, j``, which the rows of a bucket (equal in ``by``) that are to be compared share, and ``part``.

    A bucket of over ``bucket`` rows is cut into parts by the hash ``h``, and every two parts meet in a cell
    of their own, so that no cell grows with the data and no pair is lost.
    """
    hot = dealt.groupBy(*by).count().where(F.col("count") > bucket)
    hot = hot.select(*by, F.ceil(F.col("count") / F.lit(bucket / 2)).cast("int").alias("parts"))
    part = F.pmod(h, F.col("parts")).cast("int")
    pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != part), lambda j: F.struct(F.least(j, part).alias("i"), F.greatest(j, part).alias("j")))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    rest = [c for c in dealt.columns if c not in by]
    return dealt.join(hot, by, "left").select(*by, F.explode(F.when(F.col("parts").isNull(), single).otherwise(pairs)).alias("_cell"), F.coalesce(part, F.lit(0)).alias("part"), *rest).select(*by, "_cell.i", "_cell.j", "part", *rest)


def links(reps: DataFrame, radius: int = 3, bucket: int = BUCKET, window: int = WINDOW) -> DataFrame:
    """``reps(fp, rep)`` of distinct fingerprints -> ``(src, dst)``: links that join all fingerprints within ``radius``.

    A window's links come as a spanning forest, so a group of m near copies gives m - 1 rows, not m * m.
    """
    n = reps.count()
    dealt = cells(reps, radius, n, bucket).drop("part").repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")

    def compare(t: pa.Table) -> pa.RecordBatch:
        """A spanning forest. What is within the radius in a window, though not in a cell, is a true link as well."""
        a, b = close_pairs(t.column("fp").to_numpy().view(np.uint64), radius)
        rep, label = t.column("rep").to_numpy(), forest(a, b, t.num_rows)
        child = np.flatnonzero(label != np.arange(t.num_rows))
        return pa.RecordBatch.from_arrays([pa.array(rep[child]), pa.array(rep[label[child]])], ["src", "dst"])

    return dealt.mapInArrow(lambda x: windows(x, ["t", "key", "i", "j"], window, compare), "src long, dst long")


def windows(batches: Iterator[pa.RecordBatch], by: list[str], window: int, compare: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``compare`` of windows of sorted rows: whole cells (rows equal in ``by``), several to a window where they are small."""

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in by:
            x = t.column(c).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def compared(t: pa.Table, end: int) -> Iterator[pa.RecordBatch]:
        cells = [s for s in starts(t).tolist() if s < end] + [end]
        at = 0
        while at < len(cells) - 1:
            to = at + 1
            while to < len(cells) - 1 and cells[to + 1] - cells[at] <= window:
                to += 1
            if cells[to] - cells[at] > 1 and (out := compare(t.slice(cells[at], cells[to] - cells[at]))).num_rows:
                yield out
            at = to

    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= 8 * window:
            t = pa.Table.from_batches(held)
            yield from compared(t, last := int(starts(t)[-1]))
            held, rows = t.slice(last).combine_chunks().to_batches(), t.num_rows - last
    if rows:
        t = pa.Table.from_batches(held)
        yield from compared(t, t.num_rows)


def simhash_groups(docs: DataFrame, ngram: int = 3, radius: int = 3) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, fingerprint, component_id)``, a row a row.

    ``component_id`` is the smallest doc_id that links reach. Equal fingerprints are one class from the
    start; only classes are compared. A null doc_id keeps its fingerprint and joins the component of
    its class but never names one (null if no other id does). Repeated rows stay repeated; rows of one id with different texts are
    linked each for itself. Null, empty and blank texts have fingerprint 0 and are one class. A text of any length is hashed in slices.
    Other columns are not read; an empty table gives no rows.
    """
    fps = materialize(fingerprints(docs, ngram), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comp = connected_components(links(reps.where("rep is not null"), radius))
    named = reps.join(comp, reps.rep == comp.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near(by: Column, other: Column, most: Column) -> Column:
    """Whether two fingerprints (arrays of longs) differ in ``most`` bits or fewer."""
    return F.aggregate(F.zip_with(by, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x) <= most


def similar_groups(docs: DataFrame, ngram: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs(doc_id, th, text)`` -> ``(doc_id, th, cls, group)`` of the rows that can be alike others: rows of one ``group`` are.

    Links are true similarities of shingle sets (Jaccard) of ``similarity`` or more. Blocks of 64-bit fingerprints can't find these:
    they differ in ten bits, and in 16 or more at times, which leaves blocks of three bits. So candidates share a rare shingle
    (:mod:`taxoloom.llm.shingles`); their wide fingerprints are compared bit-sliced, within the radius of that similarity; and those left
    are verified. First each class meets the least one that it shares a shingle with, which joins large groups by rows in
    proportion; then only classes that are still apart meet. A hot bucket is cut into cells.
    """
    wide, most = shingles.radius(similarity, True), shingles.radius(similarity)
    rows = materialize(shingles.candidates(docs, ngram, similarity), "candidates")
    sets = materialize(rows.where("tokens is not null").groupBy("cls").agg(F.min_by(F.struct("n", "fp", "take", "tokens"), F.struct("doc_id", "th")).alias("s")).select("cls", "s.*"), "sets")
    entries = sets.where("take > 0").select("cls", "n", "fp", F.size("tokens").alias("own"), F.posexplode(F.slice("tokens", F.lit(1), F.col("take"))).alias("pos", "token"))
    entries = entries.select("cls", "n", "fp", (F.col("own") - F.col("pos")).alias("rest"), "token")
    shared = entries.groupBy("token").agg(F.count("*").alias("c"), F.min_by(F.struct("cls", "n", "fp"), "cls").alias("m")).where("c > 1")
    met = materialize(entries.join(shared, "token").select("token", "cls", "n", "fp", "rest", "m"), "entries")
    sizes = F.least("n", "m.n") >= similarity * F.greatest("n", "m.n") - shingles.EPS
    star = met.where((F.col("cls") > F.col("m.cls")) & sizes & near(F.col("fp"), F.col("m.fp"), F.when(F.least("n", "m.n") < shingles.SMALL, wide).otherwise(most)))
    first = materialize(shingles.alike(star.select(F.col("cls").alias("a"), F.col("m.cls").alias("b")).distinct(), sets, similarity), "alike")
    joined = connected_components(first.toDF("src", "dst"))
    named = met.join(joined, met.cls == joined.node, "left").select("token", "cls", "n", "fp", "rest", F.coalesce("component", "cls").alias("c"))
    apart = named.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
    # A pair with a small set meets among the small ones, whose sizes reach up to those of the sets that can be alike one.
    sorts = F.filter(F.array(F.when(F.col("n") < shingles.SMALL / similarity + 1, True), F.when(F.col("n") >= shingles.SMALL, False)), lambda x: x.isNotNull())
    apart = materialize(named.join(apart, "token", "left_semi").withColumn("small", F.explode(sorts)), "apart")
    by = ["token", "small", "i", "j"]
    dealt = cut(apart, ["token", "small"], F.xxhash64("cls")).drop("part").repartition(*by).sortWithinPartitions(*by)

    def compare(t: pa.Table) -> pa.RecordBatch:
        """A window's pairs, but for those of one component and of one cell with another.

        ``rest``: a set's hashes from this one on, which in their common order come after it. At the first hash that two sets
        share these are all that they can share; so a pair with too few is not alike, or has met before.
        """
        t = t.combine_chunks()
        fp = t.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(t.num_rows, -1)
        n, rest, small = t.column("n").to_numpy(), t.column("rest").to_numpy(), t.column("small").to_numpy(zero_copy_only=False)
        a, b = close_pairs(fp, wide if small.any() else most)
        c, token = t.column("c").combine_chunks().dictionary_encode().indices.to_numpy(), t.column("token").to_numpy()
        good = (c[a] != c[b]) & (token[a] == token[b]) & (small[a] == small[b]) & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - shingles.EPS)
        good &= np.minimum(rest[a], rest[b]) >= similarity / (1 + similarity) * (n[a] + n[b]) - shingles.EPS
        if small.any():
            far = np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1)
            good &= np.where(small[a], np.minimum(n[a], n[b]) < shingles.SMALL, far <= most)
        cls = t.column("cls").combine_chunks()
        return pa.RecordBatch.from_arrays([cls.take(pa.array(a[good])), cls.take(pa.array(b[good]))], ["a", "b"])

    found = dealt.mapInArrow(lambda x: windows(x, by, WINDOW, compare), "a binary, b binary")
    pairs = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    second = materialize(shingles.alike(pairs, sets, similarity), "alike")
    comp = connected_components(first.unionAll(second).toDF("src", "dst"))
    out = rows.select("doc_id", "th", "cls").join(comp, F.col("cls") == F.col("node"), "left")
    return out.select("doc_id", "th", "cls", F.coalesce("component", "cls").alias("group"))


def dedup(docs: DataFrame, ngram: int = 5, similarity: float = 0.8) -> DataFrame:
    """Keep one row of each group of near duplicates (:func:`similar_groups`), with all columns of ``docs``.

    The row with the smallest doc_id stays; where one id has several texts of a group, that whose text has the smallest hash.
    Texts that are not alike stay, also if they share an id. Of rows with equal ids and texts one stays. Rows
    without a word and those with a null id are kept as they are. No column's name can clash: only ``doc_id`` and ``text`` are read.
    """
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") & F.col("doc_id").isNotNull()
    keyed = docs.where(worded).select(F.struct(*docs.columns).alias("own"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text"))
    found = materialize(similar_groups(distinct_rows(keyed.select("doc_id", "th", "text"), ["doc_id", "th"]), ngram, similarity), "groups")
    least = found.groupBy("group").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    gone = found.join(least, "group").where(F.struct("doc_id", "th") != F.col("first")).select("doc_id", "th").distinct()
    kept = distinct_rows(keyed.drop("text"), ["doc_id", "th"]).join(gone, ["doc_id", "th"], "left_anti")
    return kept.select("own.*").unionByName(docs.where(~worded))


def distinct_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """One of the rows of each key. Keys that recur are looked for first, without the rows' texts, as they are few."""
    again = materialize(rows.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").select(*key), "again")
    if again.isEmpty():
        return rows
    return rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").dropDuplicates(key))
