"""Sets of word shingles: which texts can be alike, and which are.

Of two sets with a Jaccard similarity of ``s`` or more, either holds at least ``s`` times its own size of hashes that the
other one holds too. So a text with more hashes of its own than that is settled without a comparison, and for the others a
hash among their rarest leads to each partner.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.common import SEED, pieces

#: Guards products of the threshold with whole numbers against rounding.
EPS = 1e-9
#: Bytes of text that a group holds on average.
GROUP_BYTES = 6 << 20
#: Words of a fingerprint, and what turns a hash into its further words. The wider, the less do texts of lesser similarity pass.
WORDS = 16
#: Sets of fewer hashes have a wider radius, for ties.
SMALL = 32
MIX = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)


def shingles(text: str | None, ngram: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the lower-cased (A-Z) words. Fewer words than ``ngram`` make one shingle."""
    parts, words = [], []
    for piece in pieces((text or "").encode()):
        words += piece.lower().split()
        n = len(words) - ngram + 1
        if n > 0:
            grams = map(b" ".join, zip(*(words[i:] for i in range(ngram)), strict=False))
            parts.append(np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", n)))
            words = words[n:]
    if not parts and words:
        parts.append(np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], "<u8"))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")


def sketch(s: np.ndarray) -> np.ndarray:
    """The SimHash of a set of hashes, ``WORDS`` words long: the majority of the hashes at each bit, then of the hashes mixed."""
    out = []
    for _ in range(WORDS):
        bits = np.unpackbits(np.ascontiguousarray(s, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(s), bitorder="little").view("<u8")[0])
        s = (s ^ s >> HALF) * MIX
        s ^= s >> np.uint64(29)
    return np.array(out, np.uint64)


def radius(similarity: float, small: bool = False, bits: int = 64 * WORDS) -> int:
    """Bits in which the fingerprints of two sets of that similarity differ: the mean and six deviations.

    The cosine of two sets is at least 2 s / (1 + s). A pair of the least similarity goes unseen once in a million or less, a
    more similar pair more seldom.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi + 0.06 * small
    return min(bits - 1, math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p))))


class Group:
    """The texts of a group by class (equal sets), and their hashes in the order of buckets."""

    def __init__(self, t: pa.Table, ngram: int, buckets: int):
        self.classes: dict[bytes, list[int]] = {}
        self.sets: list[np.ndarray] = []
        for i, text in enumerate(t.column("text")):
            s = shingles(text.as_py(), ngram)
            key = xxhash.xxh3_128_digest(s.tobytes())
            if key not in self.classes:
                self.classes[key] = []
                self.sets.append(s)
            self.classes[key].append(i)
        every = np.concatenate([*self.sets, np.zeros(0, "<u8")])
        # Bucket in the upper half, 32 bits of the hash in the lower one.
        self.keys, self.at, self.count = np.unique((every >> HALF) % np.uint64(buckets) << HALF | every & LOW, return_inverse=True, return_counts=True)
        bucket = (self.keys >> HALF).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        self.start = np.concatenate([[0], cut]) if len(bucket) else cut
        self.end = np.append(cut, len(bucket)) if len(bucket) else cut
        self.bucket = bucket[self.start]


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Bytes of ``data[a:b]`` for each a, b of adjoining slices."""
    ends = np.concatenate([start[:1], end]).astype(np.int64) * data.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def candidates(docs: DataFrame, ngram: int, similarity: float, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs(doc_id, th, text)`` -> ``(doc_id, th, cls, n, fp, take, tokens)`` of the rows that can be alike another one.

    Rows with equal sets share ``cls``, 16 bytes of a hash. Of each class and group one row has ``tokens``: the set's hashes that
    more than one class holds, rarest first; the first ``take`` lead to all partners. ``n`` is the size of the whole set.
    Groups count each of their hashes once, whatever number of their texts has it, so that a hash that all texts hold comes
    in one entry a group; what goes back is four bits a hash.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-total // group_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.select("doc_id", "th", "text", F.pmod(F.xxhash64("doc_id", "th"), F.lit(groups)).alias("g"))

    def offer(key, t):
        x = Group(t, ngram, groups)
        g = pa.array(np.full(len(x.start), key[0].as_py()))
        count = slices(np.minimum(x.count, 255).astype(np.uint8), x.start, x.end)
        return pa.table([pa.array(x.bucket), g, slices((x.keys & LOW).astype("<u4"), x.start, x.end), count], names=["b", "g", "low", "count"])

    def tally(key, t):
        """In how many classes a hash is, as the number of binary digits, counting classes of each group for themselves."""
        low = [np.frombuffer(x, "<u4") for x in t.column("low").to_pylist()]
        one = np.concatenate([np.frombuffer(x, np.uint8) for x in t.column("count").to_pylist()])
        _, at = np.unique(np.concatenate(low), return_inverse=True)
        df = np.bincount(at, weights=one)
        level = np.minimum(np.floor(np.log2(df)), 15).astype(np.uint8)[at]
        ends = np.cumsum([0, *map(len, low)]).tolist()
        rows = [(g, b, np.packbits(level[i:j, None] >> np.arange(3, -1, -1, dtype=np.uint8) & 1).tobytes()) for g, b, i, j in zip(t.column("g").to_pylist(), t.column("b").to_pylist(), ends, ends[1:], strict=False) if level[i:j].any()]
        return pa.Table.from_pylist([dict(zip(("g", "b", "level"), r, strict=True)) for r in rows], TOLD)

    def pick(key, t, told):
        if not t.num_rows:
            return FOUND.empty_table()
        x = Group(t, ngram, groups)
        level = np.zeros(len(x.keys), np.uint8)
        place = dict(zip(x.bucket.tolist(), zip(x.start.tolist(), x.end.tolist(), strict=True), strict=True))
        for b, packed in zip(told.column("b").to_pylist(), told.column("level").to_pylist(), strict=True):
            i, j = place[b]
            level[i:j] = np.packbits(np.unpackbits(np.frombuffer(packed, np.uint8), count=4 * (j - i)).reshape(-1, 4), axis=1)[:, 0] >> 4
        out, lo = [], 0
        doc, th = t.column("doc_id").to_pylist(), t.column("th").to_pylist()
        for (cls, rows), s in zip(x.classes.items(), x.sets, strict=True):
            own = level[x.at[lo : lo + len(s)]]
            lo += len(s)
            shared, least = int((own > 0).sum()), math.ceil(similarity * len(s) - EPS)
            if shared < least and len(rows) < 2:
                continue
            some = own > 0
            tokens = s[some][np.lexsort((s[some], own[some]))].view(np.int64)
            take = max(0, shared - least + 1)
            for k, i in enumerate(rows):
                out.append((doc[i], th[i], cls, len(s), sketch(s).view(np.int64) if not k else None, take, tokens if not k else None))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [()] * 7, FOUND, strict=True)], schema=FOUND)

    offers = dealt.groupBy("g").applyInArrow(offer, "b long, g long, low binary, count binary")
    told = offers.groupBy("b").applyInArrow(tally, "g long, b long, level binary")
    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(pick, "doc_id long, th long, cls binary, n int, fp array<long>, take int, tokens array<long>")


TOLD = pa.schema([("g", pa.int64()), ("b", pa.int64()), ("level", pa.binary())])
FOUND = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("cls", pa.binary()), ("n", pa.int32()), ("fp", pa.list_(pa.int64())), ("take", pa.int32()), ("tokens", pa.list_(pa.int64()))])


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``pairs(a, b)`` of classes in ``sets(cls, n, tokens)`` -> those of at least ``similarity``. What two sets have in common is in both ``tokens``."""
    x = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return pairs.join(x, "a").join(y, "b").where(common >= similarity * (F.col("na") + F.col("nb") - common) - EPS).select("a", "b")
