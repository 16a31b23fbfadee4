"""Embedding and chat operators, the pipeline, and the registered queries on tiny tables."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from taxoloom.llm import chat, mixing, queries, vectors
from test_llm_tables import slow_lines, slow_measures
from test_shingles import kept

SF = "/root/testdata/sf0.001"


def slow_links(v, threshold=0.9):
    n = np.linalg.norm(v, axis=1)
    s = (v @ v.T) / np.outer(n, n) >= threshold
    np.fill_diagonal(s, False)
    label = np.arange(len(v))
    while True:
        new = np.array([min(label[i], *(label[np.flatnonzero(s[i])]), label[i]) for i in range(len(v))])
        if (new == label).all():
            return s.sum(axis=1), label
        label = new


@pytest.mark.parametrize("p", [vectors.Index(), vectors.Index(shard=60, most=90, overlap=3), vectors.Index(shard=40, most=300, overlap=4, centres=8)])
def test_near_duplicates(spark, p):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(200, 16))
    near = base[rng.integers(0, 40, 150)] + 0.12 * rng.normal(size=(150, 16))
    hot = base[0] + 0.05 * rng.normal(size=(120, 16))
    v = np.concatenate([base, near, hot, np.repeat(base[3:4], 60, 0), base[5:6] * 3])
    v = v.astype(np.float32)
    rows = [(i, [float(x) for x in r], 0) for i, r in enumerate(v)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [1.0, None] + [0.0] * 14, 0), (n + 3, [float("nan")] * 16, 0), (n + 4, [float("inf")] * 16, 0), (n + 5, [1.0, 2.0], 0), (n + 6, [2.0, 4.0], 0), (None, rows[3][1], 0), (n + 7, [], 0)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep int"), p=p).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    count, label = slow_links(np.concatenate([v, v[3:4]]).astype(np.float64))
    found = sum(by[i].n_links for i in range(n))
    assert found >= 0.95 * count[:n].sum() and all(by[i].n_links <= count[i] for i in range(n))
    assert np.mean([by[i].component_id == label[i] for i in range(n)]) > 0.95
    for i in [n, n + 1, n + 2, n + 3, n + 4, n + 7]:
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert by[n + 5].n_links == by[n + 6].n_links == 1 and by[n + 6].component_id == n + 5 and not by[n + 6].kept
    assert by[None].component_id == label[3] and not by[None].kept


def test_rare_links_are_audited(spark):
    """A few links among many vectors: the audit asks until it has seen one, and counts what a poor result misses."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(3000, 24))
    v[:10] = v[100:110] + 0.01 * rng.normal(size=(10, 24))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    known = vectors.classes(df)
    p = vectors.Index()
    none = spark.createDataFrame([], "cid long, links long, root long")
    assert vectors.audit(known, none, 0.9, p) == 0
    assert vectors.audit(known.where("rep between 200 and 260"), none, 0.9, p) is None
    every = vectors.all_links(known, 0.9, vectors.Index(most=400))
    assert vectors.audit(known, every, 0.9, p) == 1
    count, label = slow_links(v)
    got = {r.vec_id: r for r in vectors.near_duplicates(df, p=vectors.Index(degree=1, near=1, far=1, beam=1, medoids=1, overlap=1)).collect()}
    assert [got[i].n_links for i in range(3000)] == count.tolist() and [got[i].component_id for i in range(3000)] == label.tolist()


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(df).count() == 0


def test_prune_keeps_the_nearest():
    x = vectors.unit(np.array([[1, 0], [0.99, 0.1], [0.98, 0.12], [0, 1], [-1, 0.0]])).astype(np.float32)
    pool = np.array([[1, 2, 3, 4]])
    kept = vectors.prune(x[[0, 1, 2, 3, 4]], np.repeat(pool, 5, 0), (x @ x[[1, 2, 3, 4]].T), 3, 1.2)
    assert kept[0][0] == 1 and 2 not in kept[0]


def speak(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8)))
    line = lambda k: " ".join(word() for _ in range(k))
    rows = []
    for c in range(n):
        t = 0
        if rng.random() < 0.3:
            rows.append((c, t, "system", line(12) + "."))
            t += 1
        for _ in range(rng.randint(1, 4)):
            rows.append((c, t, "user", line(rng.randint(5, 25)) + rng.choice([".", "?"])))
            rows.append((c, t + 1, "assistant", "\n".join(line(rng.randint(10, 60)) + "." for _ in range(rng.randint(1, 5)))))
            t += 2
    return rows


COLS = "conv_id long, turn long, role string, text string"


def test_chat_held_out(spark):
    """Roles of conversations other than those the model is fitted on, two fifths of them in styles that it hasn't seen."""
    seen = [x for x in speak(1, 600) if hashlib.md5(str(x[0]).encode()).digest()[0] % len(chat.STYLES) not in (1, 3)]
    model = chat.fit_on(spark.createDataFrame(seen, COLS))
    rows = [(c + 1000, *r) for c, *r in speak(2, 150)]
    got = chat.parse_transcripts(chat.transcripts(spark.createDataFrame([(*r, 1, "x") for r in rows], COLS + ", part int, transcript string")), model).collect()
    said = {}
    for c, t, role, text in rows:
        said.setdefault(c, []).append((role, text.strip()))
    heard = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.turn)):
        heard.setdefault(r.conv_id, []).append((r.role, r.text))
    turns = sum(map(len, said.values()))
    right = sum((Counter(said[c]) & Counter(heard.get(c, []))).total() for c in said)
    assert right / turns > 0.8, right / turns
    marked = [c for c in said if len(said[c]) == len(heard.get(c, []))]
    assert len(marked) > 0.6 * len(said)
    assert all(r.rendered == chat.canonical(r.role, r.text) for r in got)


def test_viterbi_finds_the_best_of_all_paths():
    """Brute force over all paths of states; and the parts of a run sum up to the same."""
    rng = np.random.default_rng(3)
    lines = ["User: hi", "", "A: yes?", "- no", "x " * 60]
    for _ in range(5):
        model = chat.fit(rng.integers(0, 9, len(chat.counts([], []))).astype(float))
        for n in (1, 2, 4):
            some = [lines[i] for i in rng.integers(0, len(lines), n)]
            score = model.scores(some, chat.START)
            worth = lambda p: model.first[p[0]] + score[p[0], 0] + sum(model.step[a, b] + score[b, t + 1] for t, (a, b) in enumerate(zip(p, p[1:])))
            best = max(map(worth, itertools.product(range(chat.K), repeat=n)))
            assert worth(model.viterbi(some)) == best
            assert model.span(some, chat.START)[0].max() == best
        whole = model.span(lines, chat.PLAIN)
        first, second = model.span(lines[:2], chat.PLAIN), model.span(lines[2:], chat.BLANK)
        assert (whole == (first[:, :, None] + second[None]).max(axis=1)).all()


def test_where_a_conversation_is_cut_does_not_matter(spark):
    """Long conversations over many partitions, equal rows in quantity, and cuts within a turn: the same turns as in one piece."""
    rng = random.Random(4)
    long = speak(5, 40)
    rows = [(1, i, r, x) for i, (_, _, r, x) in enumerate(long)] + [(2, 0, "user", "yes")] * 2500 + [(None, None, None, None), (None, 2, "tool", ""), (3, None, "user", "no number"), (3, None, "assistant", "so\nwhat"), (4, 0, "user", "hi")]
    df = spark.createDataFrame(rows, COLS)
    model = chat.fit_on(df)
    assert chat.transcripts(df).agg(F.sum(F.size(F.split("transcript", "\n")))).first()[0] == chat.in_order(df).rdd.map(lambda r: len(chat.render_raw(chat.key_of(r.conv_id), f"{r.turn}", r.role, r.text)[0])).sum()
    show = lambda out: sorted(((r.conv_id, r.turn, r.role, r.text, r.rendered) for r in out.collect()), key=str)
    whole = {}
    for r in chat.in_order(df).collect():
        whole.setdefault(r.conv_id, []).extend(chat.render_raw(chat.key_of(r.conv_id), f"{r.turn}", r.role, r.text)[0])
    want = sorted(((c, i, r, x, chat.canonical(r, x)) for c, ls in whole.items() for i, (r, x) in enumerate(chat.parse(model, "\n".join(ls)))), key=str)
    assert show(chat.parse_transcripts(chat.transcripts(df), model)) == want
    parts = []
    for c, ls in whole.items():
        at = 0
        while at < len(ls):
            to = at + rng.randint(1, 9)
            parts.append((c, at * 10, "\n".join(ls[at:to])))
            at = to
    assert show(chat.parse_transcripts(spark.createDataFrame(parts, "conv_id long, part long, transcript string").repartition(3), model)) == want


def test_chat_edges(spark):
    both = lambda i: zip(*(chat.render_raw(str(i), str(t), r, x) for t, (r, x) in enumerate([("user", "hi there?"), ("assistant", "well\nyes")])))
    model = chat.fit(sum(chat.counts(*(sum(x, []) for x in both(i))) for i in range(60)))
    assert chat.parse(model, None) == chat.parse(model, " \n") == []
    assert chat.parse(model, "User: hi there?\nAssistant: well\nyes") == [("user", "hi there?"), ("assistant", "well\nyes")]
    assert len(chat.parse(model, "x\n" * 20_000)) >= 1
    assert "<|im_end|>" not in chat.canonical("user", "a<|im_end|>b")[:-10]
    raw = spark.createDataFrame([(1, 0, "User: a"), (1, 0, "User: a"), (2, 0, None), (3, None, "Bot: b"), (3, 1, None), (None, 0, " ")], "conv_id long, part long, transcript string")
    assert {r.conv_id for r in chat.parse_transcripts(raw, model).collect()} == {1, 3}
    empty = spark.createDataFrame([], COLS)
    assert chat.parse_transcripts(chat.transcripts(empty), chat.fit_on(empty)).count() == 0


def good(text):
    n, chars, symbols, dups, repeats = slow_measures(text)
    lines = [x for x in (text or "").split("\n") if x.split()]
    return n >= 50 and 100 * repeats <= 50 * n and 10 * symbols <= 3 * n and 2 * n <= chars <= 15 * n and 2 * dups <= len(lines)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        new = stage(spark, now, SF)
        before, after = now.collect(), new.collect()
        if k == 0:
            assert {r.doc_id for r in after} == {r.doc_id for r in before if good(r.text)}
        if k == 1:
            out = {d: (gone, text) for d, _, gone, text in slow_lines([(r.doc_id, r.text) for r in before])}
            assert {r.doc_id: r.text for r in after} == {i: text for i, (gone, text) in out.items() if not gone or text.split()}
            assert all(r.n_chars == len(r.text) for r in after if out[r.doc_id][0])
        if k == 2:
            blank = {r.doc_id for r in before if not (r.text or "").split()}
            assert {r.doc_id for r in after} == kept([(r.doc_id, r.text) for r in before if r.doc_id not in blank]) | blank
        if k == 3:
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
            assert len(after) >= len(before)
        if k < 4:
            assert new.columns == docs.columns and new.dtypes == docs.dtypes
            now = spark.createDataFrame(after, docs.schema)
    assert sum(r.length for r in after) == sum({(r.doc_id, r.sequence_id, r.offset): r.length for r in after}.values())


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_registry():
    assert [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert xxhash.xxh64_intdigest(b"a", 42) and mixing.CELLS


NAMES = ["s", "cell", "g", "gone", "_t", "_doc", "h", "n", "fp", "rep", "n_words", "failures", "kept", "n_lines", "epochs", "copies", "whole", "lines", "words"]


def test_stages_on_odd_tables(spark):
    """Nulls in any column, blank and repeated rows, and columns named as the operators name theirs; then an empty table."""
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    text = lambda: "\n".join(" ".join(word() for _ in range(rng.randint(5, 30))) for _ in range(8))
    base = [(i, rng.choice([text(), text(), None, "", " \n "]), rng.choice(["en", None]), rng.choice(["a", "b", None]), rng.choice([5, None])) for i in range(60)]
    base += [(None, text(), "en", "a", 1), (None, None, None, None, None), (3, base[3][1], None, None, None), (3, text(), "en", "a", 2), base[7], base[7], (70, base[8][1], "en", "b", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    full = spark.createDataFrame([(*r, *NAMES) for r in base], schema)
    for docs in (full, full.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            got = out.collect()
            if k < 4:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
                assert all(r[n] == n for r in got for n in NAMES)
            docs = spark.createDataFrame(got, out.schema)
        assert (sum(r.length for r in got) > 0) == (full.count() > 0 and len(got) > 0)
