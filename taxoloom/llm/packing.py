"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.common import spread

#: Words, and runs of letters, whose ids a worker remembers, and the longest word it remembers.
CACHE_WORDS, CACHE_CHARS = 600_000, 64


#: Words of Latin-1 letters with marks behind: their ids are those of the letters in lower case, then of the marks.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")
#: Texts of more characters are cut at blanks before they are encoded.
LONG = 1 << 20
#: Bytes of text that a group holds on average.
GROUP_BYTES = 3 << 20


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, the others from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a public tokenizer file that lower-cases, and whose tokens cross neither white space nor the
    border between letters and marks.

    Blanks, tabs and newlines split a text into words; each word's ids are looked up, and only new words are
    encoded: runs of letters by the merges alone, other words by the whole tokenizer. Texts that may hold one of the
    file's special tokens are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.merge = self.tokenizer.model.tokenize
        self.letter = byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {"": b""}
        probe = ["straße", "été", "ungetüm", "a"]
        if [self.letters(w) for w in probe] != self.raw(probe):
            raise ValueError(f"{path}: its words are more than merges of byte letters")

    def raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def letters(self, run: str) -> bytes:
        """Ids of a run of lower-case letters."""
        if not run.isascii():
            run = "".join(map(self.letter.__getitem__, run.encode()))
        return array(self.kind.char, [t.id for t in self.merge(run)]).tobytes()

    def learn(self, words: list[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known = {"": b""}
        if len(self.runs) > CACHE_WORDS:
            self.runs = {"": b""}
        match, runs, known, letters, odd = PLAIN.fullmatch, self.runs, self.known, self.letters, []
        for w in words:
            if (m := match(w)) is None:
                odd.append(w)
                continue
            core, marks = m[1].lower(), m[2]
            if (ids := runs.get(core)) is None:
                ids = runs[core] = letters(core)
            if marks:
                if marks not in runs:
                    runs[marks] = self.raw([marks])[0]
                ids = ids + runs[marks]
            known[w] = ids
        known.update(zip(odd, self.raw(odd), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if any(s in t for s in self.special):
                out.append(np.frombuffer(self.raw([t])[0], self.kind))
            else:
                out.append(np.concatenate([np.frombuffer(self.words(parted(x).split(" ")), self.kind) for x in pieces(t)]))
        return out

    def words(self, words: list[str]) -> bytes:
        found = list(map(self.known.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self.learn(list({words[i] for i in new}))
            for i in new:
                found[i] = self.known[words[i]]
            for w in [words[i] for i in new if len(words[i]) > CACHE_CHARS]:
                self.known.pop(w, None)
        return b"".join(found)


def kinds() -> bytes:
    """Latin-1 characters as ``a`` (letters, digits), a space (blanks), ``.`` (stops and commas) or ``!`` (all others)."""
    kind = lambda c: "." if c in ".," else " " if c in " \n\t" else "a" if c.isascii() and c.isalnum() or c >= "\u00c0" and c.isalpha() else "!"
    return "".join(kind(chr(i)) for i in range(256)).encode()


KINDS = kinds()


def parted(text: str) -> str:
    """The text with spaces for other blanks. Latin-1 texts come in lower case, with stops and commas at words' ends as words
    of their own, unless such a mark follows another one, with which it may share a token. That changes no id."""
    text = text.replace("\n", " ").replace("\t", " ")
    try:
        shape = text.encode("latin-1").translate(KINDS)
    except UnicodeEncodeError:
        return text
    if b"!. " in shape or b".. " in shape:
        return text
    return text.lower().replace(", ", " , ").replace(". ", " . ")


def pieces(text: str) -> list[str]:
    """Slices of a long text that end at blanks."""
    out, at = [], 0
    while len(text) - at > LONG and (to := text.find(" ", at + LONG)) >= 0:
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Tournament:
    """Remaining capacities of bins as a tree of maxima; finds the first bin that fits in log time."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.size)

    def place(self, length: int) -> int:
        best, at = self.best, 1
        while at < self.size:
            at *= 2
            if best[at] < length:
                at += 1
        spot = at - self.size
        best[at] -= length
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return spot


def pack(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cut and pack items of the given lengths into bins: a list of (item, start, length) a bin.

    Items are cut at the capacity; the pieces go first-fit decreasing. The emptiest bins are then
    dissolved into the gaps of the others, cut where they must be, so the gaps left are less than one bin in all.
    """
    bins = [[(i, s, capacity)] for i, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    rest = sorted(((n % capacity, i) for i, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
    tree = Tournament(max(1, len(rest)), capacity)
    loose: list[list[tuple[int, int, int]]] = [[] for _ in rest]
    for n, i in rest:
        loose[tree.place(n)].append((i, lengths[i] - n, n))
    loose = sorted((b for b in loose if b), key=lambda b: -sum(x[2] for x in b))
    need = -(-sum(x[2] for b in loose for x in b) // capacity)
    spare = [x for b in loose[need:] for x in b]
    bins_left = loose[:need]
    for b in bins_left:
        gap = capacity - sum(x[2] for x in b)
        while gap and spare:
            i, s, n = spare.pop()
            b.append((i, s, min(n, gap)))
            if n > gap:
                spare.append((i, s + gap, n - gap))
            gap -= min(n, gap)
    return bins + bins_left


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group_bytes: int = GROUP_BYTES, seed: int = 0) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids``: little-endian unsigned 32-bit ids. Each document ends in ``end_id``; null and empty texts
    are that id alone. Groups hold about ``group_bytes`` of text, chosen by a hash of the row, and are packed
    independently: a group is packed the same wherever it runs. ``sequence_id`` has the group in its upper half.
    Rows with equal or null ids are packed row by row; equal rows in quantity spread over groups. A text of any length is in one
    group, encoded in slices. Other columns are not read. An empty table gives no rows.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    groups = max(1, -(-(slim.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // group_bytes))
    dealt = spread(slim).select("doc_id", "text", F.pmod(F.xxhash64("h", "copy", F.lit(seed)), F.lit(groups)).alias("g"))

    def run(key, t):
        t = t.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        enc = encoder(tokenizer_path)
        texts = t.column("text")
        ids: list[np.ndarray] = []
        for lo in range(0, t.num_rows, 64):
            ids += enc.encode(texts.slice(lo, 64).to_pylist())
        ids = [np.append(x.astype("<u4"), np.uint32(end_id)).astype("<u4") for x in ids]
        placed = pack([len(x) for x in ids], capacity)
        rows, out, base = [], [], key[0].as_py() << 32
        for k, pieces in enumerate(placed):
            offset = 0
            for i, s, n in pieces:
                rows.append((i, s, n, len(ids[i]), base + k, offset))
                out.append(ids[i][s : s + n].tobytes())
                offset += n
        cols = list(np.array(rows, np.int64).T) if rows else [np.zeros(0, np.int64)] * 6
        doc = t.column("doc_id").combine_chunks().take(pa.array(cols[0]))
        return pa.table([doc, cols[1], cols[2], pa.array(out, pa.binary()), cols[3], cols[4], cols[5]], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return dealt.groupBy("g").applyInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
