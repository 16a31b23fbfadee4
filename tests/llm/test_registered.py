"""The registered queries without SQL, run as the driver runs them, against plain versions over the same whole tables."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from taxoloom.llm import chat, mixing
from taxoloom.llm.queries import tokenizer_path
from test_llm_tables import slow_mix
from test_simhash_suffix import slow_components, slow_drop, slow_fingerprint
from test_vectors_chat_pipeline import slow_links

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return lambda sql: duckdb.sql(sql.replace("FROM ", f"FROM '{SF}/").replace("documents", "documents.parquet'").replace("pages", "pages.parquet'").replace("embeddings", "embeddings.parquet'").replace("conversations", "conversations.parquet'")).fetchall()


def run(spark, name):
    return entry.queries()[name](spark, SF)


def test_simhash(spark, rows):
    docs = rows("SELECT doc_id, text FROM documents")
    fps = {d: slow_fingerprint(t) for d, t in docs}
    want = slow_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in run(spark, "op1_simhash").collect()) == sorted((d, f"{fps[d]:016x}", want[d]) for d in fps)


def test_warc(spark, rows):
    pages = [(p, (h or "").encode()) for p, h in rows("SELECT page_id, html FROM pages")]
    last = {}
    for p, h in pages:
        last[h] = max(p, last.get(h, p))
    want = [(p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if last[h] == p else "revisit", None if last[h] == p else last[h]) for p, h in pages]
    got = run(spark, "op2_warc").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_chat(spark, rows):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    model, whole = chat.fit_on(df), defaultdict(list)
    for r in chat.in_order(df).collect():
        whole[r.conv_id] += chat.render_raw(chat.key_of(r.conv_id), f"{r.turn}", r.role, r.text)[0]
    want = [(c, i, role, len(text), hashlib.md5(chat.canonical(role, text).encode()).hexdigest()) for c, ls in whole.items() for i, (role, text) in enumerate(chat.parse(model, "\n".join(ls)))]
    assert sorted(map(tuple, run(spark, "op3_chat").collect())) == sorted(want)
    said = Counter((c, role) for c, role in rows("SELECT conv_id, role FROM conversations"))
    heard = Counter((c, role) for c, _, role, *_ in want)
    assert (said & heard).total() > 0.8 * said.total()


def test_embeddings(spark, rows):
    v = rows("SELECT vec_id, embedding FROM embeddings")
    count, label = slow_links(np.array([e for _, e in v], np.float64))
    ids = [i for i, _ in v]
    least = {}
    for i, k in zip(ids, label):
        least[k] = min(i, least.get(k, i))
    want = sorted((i, int(n), least[k], least[k] == i) for i, n, k in zip(ids, count, label))
    assert sorted(map(tuple, run(spark, "op5_embedding_dedup").collect())) == want


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [1] for d, t in rows("SELECT doc_id, text FROM documents")}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op6_packing").collect():
        some = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(some) == r.length and zlib.crc32(some.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, x in pieces.items():
        x.sort()
        assert [s for s, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))] and sum(n for _, n in x) == len(ids[d])
    assert set(pieces) == set(ids)
    for x in sequences.values():
        x.sort()
        assert [s for s, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))] and sum(n for _, n in x) <= 2048


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    known = [(r.own.source, r.h, r.copy, r.n) for r in mixing.keyed(docs).collect()]
    who = {(r.h, r.copy): r.own.doc_id for r in mixing.keyed(docs).collect()}
    tokens = Counter()
    for s, _, _, n in known:
        tokens[s] += n
    total = sum(tokens.values())
    shares = spark.createDataFrame([(n / total,) for n in tokens.values()], "p double")
    got = run(spark, "op9_mixing").collect()
    for variant, rule, size in (("repeats", {"max_repeats": 2.0}, None), ("entropy", {"entropy": 2.0}, total)):
        taken, weights, repeats = slow_mix(known, mixing.fit_exponent(shares, **rule), -(-len(known) // mixing.CELL_ROWS), size)
        want = Counter()
        for k, n in taken.items():
            want[who[k]] += n
        mine = [r for r in got if r.variant == variant]
        assert Counter(r.doc_id for r in mine) == +want
        assert all(r.weight == pytest.approx(weights[r.source], abs=1e-8) and r.repeats == pytest.approx(repeats[r.source], abs=1e-8) for r in mine)


def test_suffixes(spark, rows):
    got = run(spark, "op10_suffix_dedup").collect()
    assert sorted(tuple(r) for r in got) == slow_drop(rows("SELECT doc_id, text FROM documents"))
