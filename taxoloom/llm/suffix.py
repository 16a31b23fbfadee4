"""Removal of repeated byte passages by two-stage suffix sorting.

Every byte covered by a ``span``-byte string that also starts in a document with a smaller id goes.

Documents are dealt into groups of bounded size. Passes over the groups exchange only compact arrays:

1. Each window of ``span`` bytes elects its least hashed k-gram (an anchor), so equal windows elect
   equal anchors at equal offsets. A group sends the distinct hashes of its anchors to buckets; a bucket
   answers with those that two documents hold.
2. Around each such anchor a group cuts the bytes of the windows that elected it (a context) and sends each
   distinct context once with its least doc_id. A bucket sorts the suffixes of its contexts in two stages,
   compares neighbours, and answers which windows also start in an earlier document.
3. The groups mark, cut and hash.

Hot passages: a group sends a hash or a context once however many of its documents hold it, so a bucket
gets a row a group at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.common import spread

SPAN = 50
#: Bytes of an anchor. A window holds SPAN - GRAM + 1 of them; two in REACH + 1 positions become anchors.
GRAM = 24
REACH = SPAN - GRAM + 1
WIDTH = SPAN + REACH - 1
SLICE = 1 << 17
GROUP_BYTES = 6 << 20
U = np.uint64
#: Masks that keep the first 0 to 8 symbols of a big-endian word.
SHIFT = np.array([0, *((1 << 64) - (1 << 8 * (8 - k)) for k in range(1, 9))], np.uint64)
MIX = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]


def word_at(buf: np.ndarray, kind: str) -> np.ndarray:
    """The 8 bytes from each offset as one integer; the last 7 bytes start none."""
    n = len(buf) - 7
    out = np.empty((-(-n // 8), 8), np.uint64)
    spare = np.concatenate([buf, np.zeros(16, np.uint8)])
    for k in range(8):
        out[:, k] = spare[k : k + 8 * len(out)].view(kind)
    return out.reshape(-1)[:n]


def anchors(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that elect the same anchor: first window, number of windows, 64-bit anchor hash.

    ``buf`` holds the documents end to end, ``ends`` their ends. Windows never cross an end. Runs are cut at
    slices of 128 KiB, so that memory doesn't follow the length of a document.
    """
    out = []
    starts = np.concatenate([[0], ends[:-1]])
    for at in range(0, len(buf), SLICE):
        n = min(SLICE, len(buf) - at)
        part = np.zeros(SLICE + SPAN + 64, np.uint8)
        piece = buf[at : at + SLICE + SPAN]
        part[: len(piece)] = piece
        w = word_at(part[: n + SPAN + 24], "<u8")
        m = n + REACH - 1
        h = w[:m] * MIX[0]
        h ^= h >> U(32)
        h += w[8 : m + 8]
        h *= MIX[1]
        h ^= h >> U(29)
        h += w[16 : m + 16]
        h *= MIX[2]
        h ^= h >> U(32)
        least = (h & ~U(0x1FFFFF)) | np.arange(m, dtype=np.uint64)
        held = 1
        while 2 * held <= REACH:
            least = np.minimum(least[:-held], least[held:])
            held *= 2
        if held < REACH:
            least = np.minimum(least[: n], least[REACH - held : REACH - held + n])
        at_gram = (least[:n] & U(0x1FFFFF)).astype(np.int64)
        valid = np.zeros(n + 1, np.int32)
        lo, hi = np.clip(starts - at, 0, n), np.clip(ends - SPAN + 1 - at, 0, n)
        some = hi > lo
        np.add.at(valid, lo[some], 1)
        np.add.at(valid, hi[some], -1)
        idx = np.flatnonzero(np.cumsum(valid[:n]) > 0)
        if not len(idx):
            continue
        new = np.concatenate([[True], (np.diff(idx) != 1) | (np.diff(at_gram[idx]) != 0)])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(idx)))
        x = h[at_gram[idx[first]]] * MIX[3]
        x ^= x >> U(31)
        x *= MIX[0]
        x ^= x >> U(33)
        out.append((idx[first] + at, count, x))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Group:
    """The documents of a group, end to end. A null doc_id has no order: its document neither removes nor loses."""

    def __init__(self, t: pa.Table):
        t = t.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # each pass must cut the same slices
        self.ids = t.column("doc_id")
        texts = [x or b"" for x in t.column("text").to_pylist()]
        self.ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        self.null = self.ids.is_null().to_numpy()
        self.doc = self.ids.fill_null(0).to_numpy()

    def runs(self) -> tuple[np.ndarray, ...]:
        first, count, h = anchors(self.buf, self.ends)
        row = np.searchsorted(self.ends, first, side="right")
        known = ~self.null[row] if len(row) else np.zeros(0, bool)
        return first[known], count[known], h[known], self.doc[row[known]]

    def contexts(self, shared: np.ndarray, offers_to: int, buckets: int) -> tuple[np.ndarray, ...]:
        """Of the runs whose anchors are ``shared``: first window, windows, doc, context number; and of each
        distinct context: its bytes with the number of windows last, least doc, bucket."""
        first, count, h, doc = self.runs()
        key = keys(h, offers_to)
        at = np.minimum(np.searchsorted(shared, key), max(0, len(shared) - 1))
        hit = shared[at] == key if len(shared) else np.zeros(len(key), bool)
        first, count, doc, h = first[hit], count[hit], doc[hit], h[hit]
        padded = np.concatenate([self.buf, np.zeros(WIDTH, np.uint8)])
        cut = np.zeros((len(first), WIDTH + 1), np.uint8)
        for lo in range(0, len(first), 1 << 15):
            rows = slice(lo, lo + (1 << 15))
            part = padded[first[rows, None] + np.arange(WIDTH)]
            part[np.arange(WIDTH)[None, :] >= (count[rows, None] + SPAN - 1)] = 0
            cut[rows, :WIDTH] = part
        cut[:, WIDTH] = count
        pick, number = distinct(cut)
        least = np.full(len(pick), np.iinfo(np.int64).max)
        np.minimum.at(least, number, doc)
        return first, count, doc, number, cut[pick], least, (keys(h[pick], buckets) >> U(32)).astype(np.int64)


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a byte matrix: one row of each distinct kind, and each row's kind. Kinds are found by hash and compared."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    words, h = wide.view("<u8"), np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * MIX[k % 2]
        h ^= h >> U(32)
    _, pick, number = np.unique(h, return_index=True, return_inverse=True)
    if not (words[pick[number]] == words).all():
        _, pick, number = np.unique(wide.view(np.dtype((np.void, wide.shape[1])))[:, 0], return_index=True, return_inverse=True)
    return pick, number


def keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper half, 32 bits of the hash in the lower one."""
    return ((h >> U(32)) % U(buckets)) << U(32) | (h & U(0xFFFFFFFF))


def sort_words(big: np.ndarray, at: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The order of the suffixes ``at`` by their first 56 symbols, symbols past an end counting as 0.

    Sorted by 8 symbols at a time; suffixes that are alone with their symbols so far, or share all 56 with
    every other such, are settled.
    """

    def word(j: int, x: np.ndarray) -> np.ndarray:
        left = np.clip(rest[x] - 8 * j, 0, 8)
        keep = SHIFT[left]
        return big[np.minimum(x + 8 * j, len(big) - 1)] & keep

    first = word(0, at)
    order = np.argsort(first, kind="stable")
    new = np.concatenate([[True], np.diff(first[order]) != 0]) if len(at) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    places = np.arange(len(at))
    for j in range(1, 7):
        if not len(places):
            break
        start = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0]))
        size = np.diff(np.append(start, len(group)))
        head = np.repeat(start, size)
        x = at[order[places]]
        words = word(j, x)
        odd = words != words[head]
        for k in range(j + 1, 7):
            y = word(k, x)
            odd |= y != y[head]
        open_ = np.repeat(np.logical_or.reduceat(odd, start), size)
        places, group, words = places[open_], group[open_], words[open_]
        by = np.lexsort((words, group))
        order[places] = order[places[by]]
        group, words = group[by], words[by]
        if len(group):
            group = np.cumsum(np.concatenate([[True], (np.diff(group) != 0) | (np.diff(words) != 0)])) - 1
    return order


def suffix_array(text: np.ndarray, big: np.ndarray, rest: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Offsets of the ``wanted`` suffixes of ``text`` in the order of their first SPAN symbols, in two stages.

    ``text``: symbols from 1 up, 0 after each context, 64 spare zeros; ``big``: its 8 symbols from each offset;
    ``rest``: symbols up to the next 0.
    Stage 1 sorts the suffixes that are smaller than their successors. Stage 2 scans the buckets of first
    symbols in ascending order and appends each suffix that is larger than its successor to its bucket when that
    successor is met. Suffixes other than the wanted ones take part only where a wanted one is induced from them.
    """
    n = len(rest)
    # The type of a run of equal symbols is that of its last one.
    turn = np.flatnonzero((text[:n] != text[1 : n + 1]) | (rest == 0))
    smaller = np.repeat((text[turn] < text[turn + 1]) | (rest[turn] == 0), np.diff(np.concatenate([[-1], turn])))
    active = np.zeros(n, bool)
    active[wanted] = True
    chain = wanted[~smaller[wanted]] + 1
    while len(chain := chain[~active[chain]]):
        active[chain] = True
        chain = chain[~smaller[chain]] + 1
    direct = np.flatnonzero(active & smaller)
    order = direct[sort_words(big, direct, rest)]
    heads = text[order]
    bound = np.searchsorted(heads, np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(sa: np.ndarray, symbol: int) -> np.ndarray:
        """Deal out the larger predecessors of ``sa``; those that begin with ``symbol`` too are returned."""
        pred = sa[sa > 0] - 1
        pred = pred[active[pred] & ~smaller[pred]]
        head = text[pred]
        same, pred, head = pred[head == symbol], pred[head != symbol], head[head != symbol]
        if len(pred):
            by = np.argsort(head, kind="stable")
            head, pred = head[by], pred[by]
            cut = np.flatnonzero(np.diff(head)) + 1
            for s, part in zip(head[np.concatenate([[0], cut])].tolist(), np.split(pred, cut), strict=True):
                pending[s].append(part)
        return same

    out = []
    for symbol in range(256):
        now = np.concatenate(pending[symbol]) if pending[symbol] else np.zeros(0, np.int64)
        while len(now):
            out.append(now)
            now = induce(now, symbol)
        if bound[symbol] < bound[symbol + 1]:
            out.append(part := order[bound[symbol] : bound[symbol + 1]])
            induce(part, symbol)
    sa = np.concatenate(out) if out else np.zeros(0, np.int64)
    is_wanted = np.zeros(n, bool)
    is_wanted[wanted] = True
    return sa[is_wanted[sa]]


def common_prefixes(big: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to SPAN symbols (which all lie before an end)."""
    lcp = np.zeros(len(sa), np.int64)
    alive = np.arange(1, len(sa))
    for j in range(0, SPAN, 8):
        if 2 * len(alive) > len(sa):
            x = big[sa + j]
            x = x[alive] ^ x[alive - 1]
        else:
            x = big[sa[alive] + j] ^ big[sa[alive - 1] + j]
        zero = x == 0
        lead = np.full(len(x), 8)
        some = x[~zero]
        n = np.zeros(len(some), np.int64)
        for s in (32, 16, 8):
            up = some >> U(64 - s) == 0
            n[up] += s // 8
            some = np.where(up, some << U(s), some)
        lead[~zero] = n
        lcp[alive] += lead
        alive = alive[zero]
    return np.minimum(lcp, SPAN)


def repeated(cut: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Of each context (bytes, number of windows last; least doc): the windows, as bits, that start in an earlier document's context."""
    count = cut[:, WIDTH].astype(np.int32)
    size = count + SPAN - 1
    cols = np.arange(WIDTH + 1, dtype=np.int32)[None, :]
    inside = cols <= size[:, None]
    text = np.concatenate([np.where(cols < size[:, None], cut + np.uint8(1), np.uint8(0))[inside], np.zeros(64, np.uint8)])
    start = np.concatenate([[0], np.cumsum(size + 1)])
    rest = (size[:, None] - cols)[inside]
    owner = np.repeat(np.arange(len(cut)), count)
    wanted = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count - start[:-1], count)
    big = word_at(text, ">u8")
    sa = suffix_array(text, big, rest, wanted)
    new = common_prefixes(big, sa) < SPAN
    new[:1] = True
    number = np.zeros(len(rest), np.int32)
    number[wanted] = owner
    who = number[sa]
    offset = (sa - start[who]).astype(np.int32)
    first = np.flatnonzero(new)
    floor = np.minimum.reduceat(least[who], first) if len(first) else least[:0]
    early = floor[np.cumsum(new) - 1] < least[who]
    return np.bincount(who[early], weights=np.exp2(offset[early]), minlength=len(cut)).astype(np.uint64)


def repeated_in_all(cut: np.ndarray, least: np.ndarray) -> np.ndarray:
    """:func:`repeated` where contexts may be equal: equal ones are sorted as one with the least doc, and the others of them
    repeat it in all their windows."""
    pick, number = distinct(cut)
    floor = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(floor, number, least)
    every = (U(1) << cut[:, WIDTH].astype(np.uint64)) - U(1)
    return np.where(least > floor[number], every, repeated(cut[pick], floor)[number])


def drop_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES, with_kept: bool = True) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)``, a row a row.

    ``kept`` holds the remaining bytes (null unless ``with_kept``). Null and empty texts: no bytes. Rows with one doc_id are one document, so
    they don't remove from each other. A null doc_id has no order: such rows are kept whole and remove nothing. Equal rows in
    quantity spread over groups; a text of any length is in one group, read in slices. Other columns are not read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-total // group_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A bucket of anchors (4 bytes each) serves several groups; contexts (78 bytes, and far more while they are sorted) get more buckets.
    offers_to, buckets = max(groups // 4, int(spark.conf.get("spark.sql.shuffle.partitions"))), 2 * groups
    dealt = spread(slim).select("doc_id", "text", F.pmod(F.xxhash64("h", "copy"), F.lit(groups)).alias("g"))

    def offer(key, t):
        _, _, h, doc = Group(t).runs()
        k = keys(h, offers_to)
        order = np.argsort(k, kind="stable")
        k, doc = k[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(k) else np.zeros(0, bool)
        k = k[first]
        bucket, low = (k >> U(32)).astype(np.int64), (k & U(0xFFFFFFFF)).astype("<u4")
        cut = np.flatnonzero(np.diff(bucket)) + 1
        at = [0, *cut.tolist(), len(k)] if len(k) else [0]
        rows = [(int(bucket[a]), key[0].as_py(), low[a:b].tobytes(), np.packbits(many[a:b]).tobytes()) for a, b in zip(at, at[1:], strict=False)]
        return pa.Table.from_pylist([dict(zip(("b", "g", "low", "many"), r, strict=True)) for r in rows], OFFER)

    def shared(key, t):
        low = [np.frombuffer(x, "<u4") for x in t.column("low").to_pylist()]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(y)) for x, y in zip(t.column("many").to_pylist(), low, strict=True)]) > 0
        v = np.concatenate(low)
        order = np.argsort(v, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], v[order][1:] != v[order][:-1]]))
        count = np.diff(np.append(first, len(v)))
        good = np.zeros(len(v), bool)
        good[order] = np.repeat((count > 1) | np.logical_or.reduceat(many[order], first), count)
        at = np.cumsum([0, *map(len, low)])
        return pa.table({"g": t.column("g"), "b": t.column("b"), "low": pa.array([x[good[a:b]].tobytes() for x, a, b in zip(low, at, at[1:], strict=False)], pa.binary())})

    def load(t: pa.Table) -> np.ndarray:
        out = [np.uint64(b) << U(32) | np.frombuffer(x, "<u4").astype(np.uint64) for b, x in zip(t.column("b").to_pylist(), t.column("low").to_pylist(), strict=True) if x]
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.uint64)

    def ask(key, t, got):
        if not t.num_rows:
            return ASK.empty_table()
        *_, cut, least, bucket = Group(t).contexts(load(got), offers_to, buckets)
        order = np.argsort(bucket, kind="stable")
        at = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)] if len(order) else [0]
        rows = [(int(bucket[o[0]]), key[0].as_py(), o.astype("<u4").tobytes(), least[o].astype("<i8").tobytes(), cut[o].tobytes()) for a, b in zip(at, at[1:], strict=False) for o in [order[a:b]]]
        return pa.Table.from_pylist([dict(zip(("b", "g", "number", "least", "cut"), r, strict=True)) for r in rows], ASK)

    def answer(key, t):
        cut = [np.frombuffer(x, np.uint8).reshape(-1, WIDTH + 1) for x in t.column("cut").to_pylist()]
        least = np.concatenate([np.frombuffer(x, "<i8") for x in t.column("least").to_pylist()])
        bits = repeated_in_all(np.concatenate(cut), least)
        rows, at = [], 0
        for g, c, x in zip(t.column("g").to_pylist(), cut, t.column("number").to_pylist(), strict=True):
            own = bits[at : at + len(c)]
            at += len(c)
            if own.any():
                rows.append({"g": g, "number": np.frombuffer(x, "<u4")[own > 0].tobytes(), "bits": own[own > 0].astype("<u4").tobytes()})
        return pa.Table.from_pylist(rows, ANSWER)

    def remove(key, t, got):
        if not t.num_rows:
            return DONE.empty_table()
        group = Group(t)
        is_answer = got.column("bits").is_valid()
        first, count, doc, number, _, least, _ = group.contexts(load(got.filter(got.column("low").is_valid())), offers_to, buckets)
        bits = np.zeros(len(least), np.uint64)
        told = got.filter(is_answer)
        for n, b in zip(told.column("number").to_pylist(), told.column("bits").to_pylist(), strict=True):
            bits[np.frombuffer(n, "<u4")] = np.frombuffer(b, "<u4")
        mark = np.zeros(len(group.buf) + 1, np.int32)
        own = np.where(doc > least[number], ~U(0), bits[number]) if len(number) else bits[:0]
        for w in range(REACH):
            at = first[(count > w) & (own >> U(w) & U(1) > 0)] + w
            mark[at] += 1
            mark[at + SPAN] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        rows, lo = [], 0
        for i, hi in enumerate(group.ends.tolist()):
            out = gone[lo:hi]
            kept = group.buf[lo:hi][~out].tobytes()
            rows.append((hi - lo, int(out.sum()), int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            lo = hi
        return pa.Table.from_arrays([group.ids.combine_chunks(), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(DONE)[1:], strict=True))], schema=DONE)

    names = "b long, g long"
    offers = dealt.groupBy("g").applyInArrow(offer, f"{names}, low binary, many binary")
    hashes = offers.groupBy("b").applyInArrow(shared, "g long, b long, low binary").where("octet_length(low) > 0")
    asks = dealt.groupBy("g").cogroup(hashes.groupBy("g")).applyInArrow(ask, f"{names}, number binary, least binary, cut binary")
    answers = asks.groupBy("b").applyInArrow(answer, "g long, number binary, bits binary")
    told = hashes.unionByName(answers, allowMissingColumns=True)
    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


OFFER = pa.schema([("b", pa.int64()), ("g", pa.int64()), ("low", pa.binary()), ("many", pa.binary())])
ASK = pa.schema([("b", pa.int64()), ("g", pa.int64()), ("number", pa.binary()), ("least", pa.binary()), ("cut", pa.binary())])
ANSWER = pa.schema([("g", pa.int64()), ("number", pa.binary()), ("bits", pa.binary())])
DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
