"""WARC, URL, quality, line, mixing and packing operators against plain versions on small tables."""

import base64
import hashlib
import io
import math
import os
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from taxoloom.llm import lines, mixing, packing, quality, urls, warc
from taxoloom.llm.queries import tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")


# --- WARC ---
def test_bundle_random_access():
    class Kept(io.BytesIO):
        def close(self):
            pass

    out = Kept()
    b = warc.Bundle(out, 300, 3)
    records = [warc.record(i, f"http://x/{i} é", b"p" * (i * 37 % 200), warc.digest(b""), None if i % 3 else 5, not i % 3) for i in range(40)]
    for r in records:
        b.add(r)
    b.close()
    r = warc.Reader(io.BytesIO(out.getvalue()))
    assert len(r.frames) > 3 and len(r.index) == 40
    for i in (39, 0, 17, 5):
        head, block = r.record(i)
        assert head["warc-record-id"] == f"<urn:page:{i}>" and records[i].endswith(block + b"\r\n\r\n")
    # Any Zstandard reader gets the records: the index and the seek table are skippable frames.
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(records)
    assert struct.unpack("<I", out.getvalue()[-4:])[0] == 0x8F92EAB1


def test_warc_round_trip(spark):
    rows = [(i, f"http://a/{i}", random.Random(i % 7).choice(["", "äb", "x" * 5000, None, "\r\n\r\nWARC/1.1"]), 1) for i in range(60)]
    rows += [(3, "http://a/3", rows[3][2], 1), (None, None, "null id", 1), (None, None, "x" * 5000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha int")
    got = warc.round_trip(spark, pages).collect()
    last = {}
    for p, _, h, _ in rows:
        if p is not None:
            last[h or ""] = max(last.get(h or "", -1), p)
    want = []
    for p, u, h, _ in rows:
        data = (h or "").encode()
        best = last.get(h or "")
        revisit = best is not None and best != p
        want.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", best if revisit else None))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    payloads = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id is not None}
    assert all(bytes(v).decode() == ({p: h or "" for p, _, h, _ in rows}[k]) for k, v in payloads.items())
    assert {r.record_type for r in warc.round_trip(spark, pages, min_bytes=10**6).collect()} == {"response"}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


# --- URLs ---
def slow_judge(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for r in urls.CONTRACT:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r
    bad = next((p.pattern for p in urls.PATTERNS if url is not None and re.search(p.pattern, url.lower())), None)
    return host, path, best and best.text, best.verdict if best else "block" if bad else "allow", bad


def test_judge(spark):
    rng = random.Random(4)
    pool = ["http://", "HTTPS://", "", "x://y://", "example.org", "EXAMPLE.ORG", "a.example.org", "notexample.org", "org", ".org", "com", "b.com", "casino.com", "my-casino.net", "casinos.net", "cheap-pills.io", "/es/", "/en/1", "/en/12", "/en/", "/fr/", "/de/", "/", "?q=/de/", "#x", "\n", "é", "?PHPSESSID=1", "://"]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 5))), "h") for i in range(400)] + [(400, None, "h"), (401, "", "h"), (3, "http://example.org/es/", "h"), (3, "http://example.org/es/", "h")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict, r.pattern or "") for r in got) == sorted((i, *(x or "" for x in slow_judge(u))) for i, u, _ in rows)
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize(
    "pattern, tokens",
    [(r"(^|[./-])casino([./-]|$)", ["casino"]), (r"(^|[./-])(cheap|buy)-pills([./-]|$)", ["pills"]), (r"[?&]phpsessid=", ["phpsessid"]), (r"/a+b/", []), (r"/abc?/", []), (r"/abc*", []), (r"-xy(z)?-", []), (r"/x|/y/", []), (r"/\wfoo/", []), (r"/foo[a-z]/", []), (r"/foo.bar/", []), (r"/foo\.bar/", ["foo", "bar"]), (r"foo/", []), (r"/foo[^/]", []), (r"^foo/", ["foo"]), (r"/foo(?:[./]|$)", ["foo"])],
)
def test_tokens_of_patterns(pattern, tokens):
    assert urls.PatternRule("block", pattern).literals() == tokens


def test_rules_by_rarest_token(spark):
    seen = spark.createDataFrame([("example",)] * 9 + [("org",)] * 5 + [("es",)], "token string")
    index = {r.no: r.token for r in urls.rule_index(seen, list(urls.CONTRACT)).collect()}
    assert index[1] == "es" and index[2] == "en" and index[0] == "org"


# --- quality ---
def slow_measures(text):
    text = text or ""
    words = WORD.findall(text)
    ls = [s for s in text.split("\n") if WORD.search(s)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(ls) - len(set(ls)), len(covered)


def texts(seed, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "çé", "#x", "|", "<>", "dd", "𝒳", "q" * 30])
    return [None, "", " ", "\n", "a", "a b", "a b c", "a b c a b c", "a\x0bb\x0cc\td\re", "a\xa0b", " a  b \n a  b \n\n a b"] + [rng.choice(["", " "]) + "".join(word() + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 120))) for _ in range(n)]


def test_measures_and_policy(spark):
    ts = texts(1)
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ts)], "doc_id long, text string, n_words int")
    rows = quality.ledger(docs)
    got = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(ts):
        r, want = got[i], slow_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert bool(r.failures & 3) == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    kept = {r.doc_id for r in quality.apply_policy(rows, quality.POLICIES[-1]).where("kept").collect()}
    out = quality.filter_quality(docs)
    assert {r.doc_id for r in out.collect()} == kept and out.columns == docs.columns and set(out.select("n_words").toPandas().n_words) <= {7}
    mask = quality.POLICIES[-1].mask()
    for a in quality.ablations(rows, quality.POLICIES[-1]).collect():
        bit = 1 << [r.name for r in quality.RULES].index(a.rule)
        assert a.failed == sum(bool(r.failures & bit) for r in got.values())
        assert a.kept_without == sum(not r.failures & mask & ~bit for r in got.values())
    assert quality.ledger(docs.limit(0)).count() == 0


# --- lines ---
def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def slow_lines(rows, low=3, long=8):
    spots = []
    for d, t in rows:
        for i, s in enumerate((t or "").split("\n")):
            spots.append(((d is None, d or 0, i), tuple(WORD.findall(s.lower()))))
    first = {}
    for at, w in sorted(spots):
        if len(w) >= low:
            first.setdefault(w, at)
    near = {w for w in first for x in first if len(w) >= long and len(x) >= long and first[x] < first[w] and abs(len(x) - len(w)) <= 1 and edits(x, w) <= 1}
    out = []
    for d, t in rows:
        keep = []
        for i, s in enumerate((t or "").split("\n")):
            w = tuple(WORD.findall(s.lower()))
            if len(w) < low or (w not in near and first[w] == (d is None, d or 0, i)):
                keep.append(s)
        out.append((d, len((t or "").split("\n")), len((t or "").split("\n")) - len(keep), t if len(keep) == len((t or "").split("\n")) else "\n".join(keep)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, seed):
    rng = random.Random(seed)
    bank = [[rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 9, 12, 13, 20]))] for _ in range(14)]

    def line():
        w = list(rng.choice(bank))
        k = rng.random()
        at = rng.randrange(len(w) + 1)
        if k < 0.2 and w:
            del w[min(at, len(w) - 1)]
        elif k < 0.4:
            w.insert(at, "new" + str(rng.randint(0, 3)))
        elif k < 0.6 and w:
            w[min(at, len(w) - 1)] = "sub" + str(rng.randint(0, 3))
        elif k < 0.7 and len(w) > 3:
            w[0], w[-1] = "two", "edits"
        s = rng.choice([" ", " ", "  ", "\t"]).join(w)
        return rng.choice(["", " "]) + rng.choice([s, s.upper()]) + rng.choice(["", " "])

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 9)))) for i in range(50)] + [(50, None), (51, ""), (None, "\n".join(line() for _ in range(4)))]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, h string")
    out = lines.dedup_lines(docs)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=key) == sorted(slow_lines(rows), key=key)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_every_place_of_an_edit(spark):
    for n in (8, 9, 12, 13):
        base = [f"w{i}" for i in range(n)]
        forms = [base] + [base[:i] + base[i + 1 :] for i in range(n) if n > 8] + [base[:i] + ["x"] + base[i:] for i in range(n + 1)] + [base[:i] + ["y"] + base[i + 1 :] for i in range(n)]
        rows = [(i, " ".join(w)) for i, w in enumerate(forms)]
        got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r.doc_id for r in got.where("n_removed = 0").collect()} == {0}


# --- mixing ---
def test_exponent(spark):
    p = np.array([0.6, 0.3, 0.08, 0.02])
    shares = spark.createDataFrame([(float(x),) for x in p], "p double")
    a = mixing.fit_exponent(shares, max_repeats=4.0)
    assert a == pytest.approx(1 - math.log(4) / math.log(30), abs=1e-6) and (p.max() / p.min()) ** (1 - a) <= 4
    b = mixing.fit_exponent(shares, entropy=1.2)
    w = p**b / (p**b).sum()
    assert -(w * np.log(w)).sum() == pytest.approx(1.2, abs=1e-6)
    assert mixing.fit_exponent(shares, max_repeats=1000.0) == 0.0 and mixing.fit_exponent(shares, entropy=0.1) == 1.0


def md5_key(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def slow_mix(rows, exponent, cells, size=None, seed=0):
    """Brute force: each source's rows in the order of blocks and rows of an epoch, as many epochs and as much of the next as its tokens allow.
    ``rows``: (source, h, copy, tokens). Returns how often each row is taken, and each source's weight and repeats."""
    tokens = Counter()
    for s, _, _, n in rows:
        tokens[s] += n
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}
    norm = sum(p**exponent for p in share.values())
    level = max(p ** (1 - exponent) for p in share.values()) if size is None else size / total / norm
    repeats = {s: round(share[s] ** (exponent - 1) * level, 9) if s in share else 1.0 for s in tokens}
    taken = Counter()
    for s in tokens:
        key = "" if s is None else f"={s}"
        whole = math.floor(repeats[s])
        room = math.floor((repeats[s] - whole) * tokens[s])
        cell = lambda h, c: md5_key(seed, "cell", h, c) % cells
        order = sorted((md5_key(seed, "block", whole, key, cell(h, c)), cell(h, c), md5_key(seed, "row", whole, h, c), h, c, n) for x, h, c, n in rows if x == s)
        used, open_ = 0, room > 0 or s in share
        for i, (_, k, _, h, c, n) in enumerate(order):
            # Past the last row that fits, whole blocks without room end the epoch.
            taken[h, c] += whole
            if open_ and used + n <= room and not (used == room and all(x[5] for x in order[i:] if x[1] == k)):
                taken[h, c] += 1
                used += n
            else:
                open_ = False
    return taken, {s: share[s] ** exponent / norm if s in share else 0.0 for s in tokens}, repeats


@pytest.mark.parametrize("rule", [{"max_repeats": 2.0}, {"max_repeats": None, "entropy": 1.2, "epochs": 1.0}, {"max_repeats": 3.0, "budget": 3000}])
def test_mix(spark, rule):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["big"] * 12 + ["mid"] * 4 + ["low", None]), i, "x", i) for i in range(900)]
    rows += [(None, "a b", "big", 0, "x", 0), (None, "a b c", "big", 0, "x", 0), rows[5], (5, "other", "mid", 1, "y", 1)] + [(None, "same", "low", 0, "x", 0)] * 1200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _epoch int, own string, h int")
    got = mixing.mix(docs, **rule).collect()
    assert all(tuple(r.own) in set(rows) for r in got)
    known = [(r.own.source, r.h, r.copy, r.n) for r in mixing.keyed(docs).collect()]
    assert len(known) == len(rows) and Counter(tuple(r.own) for r in mixing.keyed(docs).collect()) == Counter(rows)
    tokens = Counter()
    for s, _, _, n in known:
        tokens[s] += n
    p = np.array([n / sum(tokens.values()) for n in tokens.values()])
    shares = spark.createDataFrame([(float(x),) for x in p], "p double")
    exponent = mixing.fit_exponent(shares, rule["max_repeats"], rule.get("entropy"))
    size = rule.get("budget") or (sum(tokens.values()) if rule.get("epochs") else None)
    taken, weights, repeats = slow_mix(known, exponent, -(-len(rows) // mixing.CELL_ROWS), size)
    spelled = {(r.h, r.copy): tuple(r.own) for r in mixing.keyed(docs).collect()}
    want = Counter()
    for k, n in taken.items():
        want[spelled[k]] += n
    assert Counter(tuple(r.own) for r in got) == +want
    for r in got:
        assert r.weight == pytest.approx(weights[r.own.source]) and r.repeats == pytest.approx(repeats[r.own.source])
    if "max_repeats" in rule and not size:
        assert min(repeats.values()) == 1 and max(repeats.values()) <= 2 + 1e-9 and set(want) == set(rows)
    again = mixing.mix(docs.repartition(7), **rule).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_mix_without_tokens(spark):
    docs = spark.createDataFrame([(900, None, "void"), (901, "", "void"), (None, " ", None), (1, "a b", "s")], "doc_id long, text string, source string")
    assert Counter(r.own.doc_id for r in mixing.mix(docs).collect()) == Counter([900, 901, None, 1])
    assert Counter(r.own.doc_id for r in mixing.mix(docs.where("doc_id > 899")).collect()) == Counter([900, 901])
    assert mixing.mix(docs.limit(0)).count() == 0


def test_equal_rows_spread(spark):
    """Rows that recur are numbered, the same in each run, and none is lost."""
    from taxoloom.llm.common import spread

    rows = [(i % 7, None) for i in range(50)] + [(None, "x")] * 2345 + [(1, "y")] * 1000
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = [tuple(r) for r in spread(df).collect()]
    assert Counter(r[:2] for r in got) == Counter(rows)
    assert sorted(r[3] for r in got if r[:2] == (None, "x")) == list(range(2345))
    assert {r[3] for r in got if r[:2] != (None, "x")} == {0}
    assert spread(df.limit(0)).count() == 0


# --- packing ---
def test_tournament():
    rng = random.Random(1)
    tree, room = packing.Tournament(50, 100), [100] * 50
    for _ in range(80):
        n = rng.randint(1, 60)
        at = next((i for i, r in enumerate(room) if r >= n), None)
        if at is None:
            break
        assert tree.place(n) == at
        room[at] -= n


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    ts = ["Don't stop, it’s 3.5%!", "ÉTÉ été Straße İstanbul ΑΣ Σ", "a,b.c; d", "x <|endoftext|> y", "", "  \n\t ", "漢字かな ﬁ e\u0301 \u0301x", "w\x1cw w\u2003w", "k" * 500 + " " + "k" * 500, "...", "Hi, it's 3., x. Y,, z... ok .", "a.b, c ,d . , e", "«x», y. °, ª. µ, ×. 5, 'S, don't.", "A,\nB.\tC. \n", "É, È. ÿ, Ÿ, ß.", "$$$, a%. b"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(ts, add_special_tokens=False)]
    enc = packing.Encoder(path)
    assert [x.tolist() for x in enc.encode(ts)] == want == [x.tolist() for x in enc.encode(ts)]
    assert not any(len(w) > packing.CACHE_CHARS for w in enc.known)


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta,", "gamma3", "Ω"]) for _ in range(rng.choice([0, 3, 40, 200, 700])))) for i in range(150)] + [(150, None), (None, "null id"), (7, rng.choice(["same id", "x"])), (8, None), (8, None)]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, start int")
    got = packing.pack_documents(docs, tokenizer_path(), capacity=128, group_bytes=40_000).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    ids = {}
    want = Counter()
    for d, t in rows:
        x = tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])
        want[d, x] += 1
        ids.setdefault(d, []).append(x)
    pieces = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) >= 0
        assert any(x[r.start : r.start + r.length] == tuple(np.frombuffer(r.ids, "<u4").tolist()) and len(x) == r.doc_tokens for x in ids[r.doc_id])
        pieces[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) * n for (_, x), n in want.items())
    fill = []
    for p in pieces.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))]
        fill.append(sum(n for _, n in p))
    assert max(fill) <= 128 and sum(128 - f for f in fill) < 128 * -(-sum(len((t or '').encode()) + 64 for _, t in rows) // 40_000)
    for d, x in want:
        if len(ids[d]) == 1:
            own = sorted((r.start, r.length) for r in got if r.doc_id == d)
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) == len(x)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0
    many = packing.pack_documents(spark.createDataFrame([(None, "same text")] * 20_000, "doc_id long, text string"), tokenizer_path(), group_bytes=200_000)
    sizes = Counter(r.sequence_id >> 32 for r in many.collect())
    assert len(sizes) > 4 and max(sizes.values()) < 2 * 20_000 / len(sizes)


def test_shared_dir_is_needed_on_a_cluster(spark):
    from taxoloom.llm import common

    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert os.path.isabs(common.shared_dir(spark).removeprefix("file://"))
    df = common.materialize(spark.range(3).select(F.col("id")), "x")
    assert df.count() == 3
    common.forget(df)
