import random

import numpy as np

import corpus_pipeline
from taxoloom.llm import shingles, simhash


def grams(text, ngram=5):
    w = text.encode().lower().split()
    return {tuple(w[i : i + ngram]) for i in range(max(1, len(w) - ngram + 1))}


def kept(rows, similarity=0.8):
    """Brute force over all pairs: the least id of each component."""
    sets, label = {i: grams(t) for i, t in rows}, {i: i for i, _ in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {i for i in label if label[i] == i}


def planted(seed):
    """Copies of 6 to 300 words with a few words changed, whose similarities lie on both sides of 0.8, with a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    passage, texts = [word() for _ in range(20)], []
    for n in (1, 4, 5, 6, 9, 30, 60, 120, 200, 300):
        for _ in range(3):
            base = [word() for _ in range(n)] + passage * (n >= 30)
            texts.append(base)
            for changed in {1, 2, 3, 4, 5, 6}:
                copy = list(base)
                for at in rng.sample(range(n), min(n, changed)):
                    copy[at] = word()
                texts += [copy, copy[1:], [*copy, word()]]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts) if t]


def test_stage_finds_all_that_are_alike(spark):
    rows = planted(1)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert {r.doc_id for r in got} == kept(rows) and len(got) == len(kept(rows))


def test_similarities(spark):
    rows = planted(2)
    for similarity in (0.5, 0.9):
        got = simhash.dedup(spark.createDataFrame(rows, "doc_id long, text string"), similarity=similarity)
        assert {r.doc_id for r in got.collect()} == kept(rows, similarity)


def test_hot_buckets_are_cut(spark, monkeypatch):
    """A family whose members are alike only by pairs, all with the same passage, in cells of a few rows."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage, rows = [word() for _ in range(60)], []
    for k in range(40):
        own = [word() for _ in range(12)]
        rows += [(3 * k, " ".join(passage + own)), (3 * k + 1, " ".join(passage + own[:-1])), (3 * k + 2, " ".join([word(), *passage, *own]))]
    monkeypatch.setattr(simhash.cut, "__defaults__", (8,))
    got = simhash.dedup(spark.createDataFrame(rows, "doc_id long, text string"), similarity=0.9)
    assert {r.doc_id for r in got.collect()} == kept(rows, 0.9)


def test_ids_and_repeated_rows(spark):
    """Texts that share an id but aren't alike stay; repeated rows, also in quantity, are one; alike texts of one id are one."""
    words = lambda seed, n: " ".join(random.Random(seed).choice("abcdefgh") * random.Random(seed * 99 + i).randint(1, 9) + str(i) for i in range(n))
    a, b, c = words(1, 60), words(2, 60), words(3, 60)
    rows = [(3, a), (3, b), (5, c), (5, c), (7, a + " more"), (5, c.upper()), (9, None), (9, None), (None, a), (None, a), (11, " \n"), (12, "x"), (13, "X")]
    rows += [(20, words(4, 50))] * 300
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, cls string").repartition(7)
    got = sorted(((r.doc_id, r.text, r.cls) for r in simhash.dedup(df).collect()), key=str)
    want = [(3, a, "k"), (3, b, "k"), (9, None, "k"), (9, None, "k"), (None, a, "k"), (None, a, "k"), (11, " \n", "k"), (12, "x", "k"), (20, words(4, 50), "k")]
    five = [g for g in got if g[0] == 5]
    assert len(five) == 1 and five[0][1].lower() == c.lower() and sorted([g for g in got if g[0] != 5], key=str) == sorted(want, key=str)
    assert simhash.dedup(df.limit(0)).count() == 0


def test_shingles():
    text = "A b  c\nd E f " * 50
    assert len(shingles.shingles(text)) == len(grams(text))
    assert shingles.shingles("").size == 0 and shingles.shingles("One two").size == 1
    assert shingles.sketch(shingles.shingles(text)).shape == (shingles.WORDS,)


def test_radius_holds_what_is_alike():
    """Random sets of the least similarity, small and large: none beyond the radius; sets of a similarity of a half are."""
    rng, most, wide = np.random.default_rng(0), shingles.radius(0.8), shingles.radius(0.8, True)
    differ = lambda x, y: int(np.bitwise_count(shingles.sketch(np.sort(x)) ^ shingles.sketch(np.sort(y))).sum())
    for n in (5, 10, 40, 41, 50, 500):
        for _ in range(200):
            s = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            same = -(-4 * n // 5)
            assert differ(s[:n], s[:same]) <= (wide if same < shingles.SMALL else most)
    for _ in range(200):
        s = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        assert differ(s[:300], s[100:]) > most
