import hashlib
import random

import numpy as np
import pytest
import xxhash

from taxoloom.llm import simhash, suffix
from taxoloom.llm.common import connected_components


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def corpus(seed, n=60):
    rng = random.Random(seed)
    base = [[f"W{rng.randint(0, 80)}é" for _ in range(rng.randint(1, 150))] for _ in range(15)]
    texts = [None, "", " \n", "A b", "a B", "one"]
    while len(texts) < n:
        w = list(rng.choice(base))
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = "changed"
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    return texts


@pytest.mark.parametrize("text", ["", None, "A", "a B c", "x\x0by z\x0c q Ä Q", "same same same same same same"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_texts(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["aB ", "c\n", "long" * 9 + " ", "d"]) for _ in range(4000))
    want = slow_fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 37)
    whole = simhash.pieces
    for size in (1, 50, 700):
        monkeypatch.setattr(simhash, "pieces", lambda data: whole(data, size))
        assert simhash.fingerprint(text) == want
    assert b"".join(whole(text.encode(), 50)) == text.encode()


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    f = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for k in range(1, 200):
        f[k] = f[k // 3] ^ (np.uint64(1) << np.uint64(rng.integers(0, 64)))
    f[200:210] = f[0]
    a, b = simhash.close_pairs(f, radius)
    want = np.nonzero(np.triu(np.bitwise_count(f[:, None] ^ f[None, :]) <= radius, 1))
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(zip(*(x.tolist() for x in want)))


@pytest.mark.parametrize("bucket", [4, 2048])
def test_links_split_hot_buckets(spark, bucket):
    rng = np.random.default_rng(5)
    f = sorted({int(x) for x in (np.uint64(12345) ^ rng.integers(0, 1 << 9, 150, dtype=np.uint64) ^ (rng.integers(0, 4, 150, dtype=np.uint64) << np.uint64(40)))})
    reps = spark.createDataFrame([(x, i) for i, x in enumerate(f)], "fp long, rep long")
    got = {r.node: r.component for r in connected_components(simhash.links(reps, 3, bucket, 8)).collect()}
    want = slow_components(range(len(f)), lambda a, b: (f[a] ^ f[b]).bit_count() <= 3)
    assert {i: got.get(i, i) for i in want} == want


def test_simhash_groups(spark):
    texts = corpus(3)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[8], "x"), (7, texts[7], "x")], "doc_id long, text string, fp string")
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == len(texts) + 2
    fps = [slow_fingerprint(t) for t in texts]
    want = slow_components(range(len(texts)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    for r in rows:
        i = 8 if r.doc_id is None else r.doc_id
        assert (r.fingerprint, r.component_id) == (f"{fps[i]:016x}", want[i])
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def slow_drop(rows, span=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - span + 1):
            if d is not None:
                first[b[i : i + span]] = min(first.get(b[i : i + span], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if d is not None and first[b[i : i + span]] < d:
                gone[i : i + span] = b"\1" * span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((-1 if d is None else d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(6)] + ["a" * 120, "ab" * 70, "z" * 49, "z" * 50, "é" * 40]
    rows = [(i, " ".join(rng.choice([word(), word(), rng.choice(shared)[rng.randint(0, 9) :]]) for _ in range(rng.randint(0, 25)))) for i in range(70)]
    return [*rows, (70, None), (71, ""), (72, "z" * 50), (73, "z" * 300), (5, rows[6][1]), (None, rows[7][1]), (74, rows[7][1]), (None, rows[9][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_drop_repeats(spark, seed):
    rows = passages(seed)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, g int")
    got = suffix.drop_repeats(docs, group_bytes=600).drop("kept").collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == slow_drop(rows)


def test_drop_repeats_slices(spark, monkeypatch):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    groups = [suffix.anchors(np.frombuffer(body.encode(), np.uint8), np.array([len(body)])) for _ in range(1)]
    monkeypatch.setattr(suffix, "SLICE", 256)
    cut = suffix.anchors(np.frombuffer(body.encode(), np.uint8), np.array([len(body)]))
    spread = lambda r: {(int(f) + i): int(h) for f, c, h in zip(*r) for i in range(int(c))}
    assert spread(cut) == spread(groups[0]) and len(spread(cut)) == 2951


def test_drop_repeats_empty(spark):
    assert suffix.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
