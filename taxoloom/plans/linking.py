"""Queries over evidence, retrieval, fusion, routing and records. Documents stand for courses, their lines for lessons."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoloom import config
from taxoloom.functions import text as tx
from taxoloom.operators import evidence, extraction, ranking, records, retrieval, routing
from taxoloom.plans.registry import query
from taxoloom.plans.scalars import LINES, lines_of, sql_any
from taxoloom.sources.scratch import materialize

# Words of the tables' language, in the places of the domain's own.
ATTITUDE, KNOWLEDGE = ("idiot", "clown"), ("license", "copyright")

KINDS = f"""CASE WHEN {sql_any('line', ATTITUDE)} THEN 'TU_CHU_TRACH_NHIEM' WHEN {sql_any('line', KNOWLEDGE)} THEN 'KIEN_THUC' ELSE 'KY_NANG' END"""


@query(f"WITH {LINES} SELECT doc_id, {KINDS} AS kind, count(*) AS n FROM lines GROUP BY ALL")
def keyword_class(t):
    kind = F.when(tx.contains_any("line", ATTITUDE), "TU_CHU_TRACH_NHIEM").when(tx.contains_any("line", KNOWLEDGE), "KIEN_THUC").otherwise("KY_NANG")
    return lines_of(t).groupBy("doc_id", kind.alias("kind")).agg(F.count("*").alias("n"))


#: Sources as types of evidence: the line number gives the type, its length the subtype.
TYPES = """CASE line_no % 3 WHEN 0 THEN 'BAI_HOC' WHEN 1 THEN 'CLO' ELSE 'MO_TA' END"""
SUBTYPES = """CASE line_no % 3 WHEN 0 THEN CASE WHEN length(line) > 200 THEN 'full' ELSE 'title_only' END WHEN 1 THEN CASE WHEN length(line) > 300 THEN 'KIEN_THUC' WHEN length(line) > 100 THEN 'KY_NANG' ELSE 'TU_CHU_TRACH_NHIEM' END END"""
WEIGHT = """CASE WHEN st = 'BAI_HOC' AND sub = 'full' THEN 1.0 WHEN st = 'BAI_HOC' THEN 0.3 WHEN st = 'CLO' AND sub = 'KIEN_THUC' THEN 0.9 WHEN st = 'CLO' AND sub = 'KY_NANG' THEN 0.85 WHEN st = 'CLO' THEN 0.2 WHEN st = 'MO_TA' THEN 0.25 ELSE 0.3 END"""
UNITS = f"units AS (SELECT *, doc_id || '/' || line_no AS eid, {WEIGHT} AS w FROM (SELECT doc_id, line_no, line, {TYPES} AS st, {SUBTYPES} AS sub FROM lines WHERE trim(line) <> ''))"


def units_of(t):
    rows = lines_of(t).where(F.trim("line") != "")
    rows = rows.select(F.col("doc_id").alias("course_code"), F.concat_ws("/", "doc_id", "line_no").alias("evidence_id"), F.expr(TYPES).alias("source_type"), F.expr(SUBTYPES).alias("subtype"), F.col("line").alias("text"), "line_no")
    return evidence.graded(rows)


@query(f"""WITH {LINES}, {UNITS} SELECT doc_id, round(avg(w), 6) AS avg_weight, avg(w) < 0.35 AS low FROM units GROUP BY doc_id""")
def evidence_weight(t):
    u = units_of(t)
    out = evidence.mean_weight(u.select(F.col("course_code").alias("doc_id"), "evidence_id"), u, ["doc_id"])
    return out.select("doc_id", F.round("avg_weight", 6).alias("avg_weight"), F.col("low_evidence_quality").alias("low"))


NORM = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"


@query(f"""WITH {LINES}, d AS (SELECT doc_id, {NORM.format('text')} AS s FROM documents), n AS (SELECT doc_id, line_no, {NORM.format('line')} AS s FROM lines),
k AS (SELECT doc_id, line_no, s FROM n WHERE s <> '' AND NOT {sql_any('s', config.GRADING)}), o AS (SELECT * FROM k WHERE line_no % 2 = 0),
le AS (SELECT doc_id, line_no + 1 AS pos, CASE WHEN line_no % 3 = 1 THEN '' ELSE s END AS body, trim(s[1:40]) AS title FROM n)
SELECT doc_id || '_MOTA_MAIN' AS evidence_id, 'MO_TA' AS source_type, md5(s) AS text_md5, 0.25::DOUBLE AS weight FROM d WHERE s <> ''
UNION ALL SELECT doc_id || '_MUCTIEU_MT' || row_number() OVER (PARTITION BY doc_id ORDER BY line_no), 'MUC_TIEU', md5(s), 0.30::DOUBLE FROM o
UNION ALL SELECT doc_id || '_CLO_' || line_no, 'CLO', md5(s), CASE WHEN {sql_any('s', config.OUTCOME_ATTITUDE)} THEN 0.2::DOUBLE WHEN {sql_any('s', config.OUTCOME_KNOWLEDGE)} THEN 0.9 ELSE 0.85 END FROM k WHERE line_no % 2 = 1
UNION ALL SELECT doc_id || '_BAIHOC_L' || CASE WHEN pos < 100 THEN lpad(pos::VARCHAR, 2, '0') ELSE pos::VARCHAR END, 'BAI_HOC',
  md5(CASE WHEN body <> '' AND title <> '' THEN title || '. ' || body ELSE title || body END), CASE WHEN body <> '' THEN 1.0::DOUBLE ELSE 0.3 END FROM le WHERE title || body <> '' AND NOT {sql_any("title || '. ' || body", config.GRADING)}""")
def evidence_build(t):
    code = F.col("doc_id").cast("string").alias("code")
    none = F.lit(None).cast("string")
    lists = F.lit(None).cast("array<string>")
    courses = t.documents.select(code, F.col("text").alias("mo_ta_en"), none.alias("mo_ta_vi"))
    rows = lines_of(t)
    goals = rows.where("line_no % 2 = 0").select(code, F.col("line_no").alias("pos"), none.alias("ma_muc_tieu"), none.alias("loai_muc_tieu"), F.col("line").alias("noi_dung_en"), none.alias("noi_dung"))
    outs = rows.where("line_no % 2 = 1").select(code, F.col("line_no").cast("string").alias("ma_cdr_goc"), F.col("line").alias("noi_dung_en"), none.alias("noi_dung"), lists.alias("pi_so"))
    s = tx.normalize_whitespace("line")
    lessons = rows.select(code, (F.col("line_no") + 1).alias("pos"), F.substring(s, 1, 40).alias("ten_bai_en"), none.alias("ten_bai"), F.when(F.col("line_no") % 3 == 1, "").otherwise(s).alias("noi_dung_en"), lists.alias("ma_clo"))
    u = evidence.build(courses, goals, outs, lessons)
    return u.select("evidence_id", "source_type", F.md5("text").alias("text_md5"), F.col("evidence_weight").alias("weight"))


@query("""WITH c AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls, source, lang FROM documents)
SELECT doc_id, md5(concat_ws(chr(10), 'Course: ' || source || '.', CASE WHEN lang <> 'en' THEN 'Description: ' || lang END,
  CASE WHEN len(ls) > 0 THEN 'Objectives: ' || array_to_string(list_filter(ls, lambda x, i: i % 2 = 1), ' ') END, CASE WHEN len(ls) > 1 THEN 'CLO: ' || array_to_string(list_filter(ls, lambda x, i: i % 2 = 0), ' ') END)) AS context_md5 FROM c""")
def course_context(t):
    ls = F.filter(F.split("text", "\n"), lambda x: x != "")
    text = evidence.course_context(F.col("source"), F.when(F.col("lang") != "en", F.col("lang")).otherwise(""), F.filter(ls, lambda x, i: i % 2 == 0), F.filter(ls, lambda x, i: i % 2 == 1))
    return t.documents.select("doc_id", F.md5(text).alias("context_md5"))


@query(f"""WITH {LINES}, g AS (SELECT doc_id, bool_or(trim(line) = '') AS blank, bool_or(line_no % 5 = 4 AND length(line) > 400) AS odd, bool_and(trim(line) = '') AS empty FROM lines GROUP BY doc_id)
SELECT doc_id, (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END + blank::INT + odd::INT + blank::INT)::BIGINT AS n_warnings, ((doc_id % 7 = 0)::INT + empty::INT + contains(lower(lang), 'fr')::INT)::BIGINT AS n_errors FROM g JOIN documents USING (doc_id)""")
def validate_course(t):
    ls = F.split("text", "\n")
    kind = lambda x, i: F.when((i % 5 == 4) & (F.char_length(x) > 400), "ODD").otherwise("KY_NANG")
    c = t.documents.select(
        "doc_id", F.col("doc_id").alias("code"), F.when(F.col("doc_id") % 7 == 0, -1).otherwise(F.col("doc_id")).alias("declared"), F.col("lang").alias("ten_vi"), F.lit("").alias("mo_ta_en"),
        F.array(F.lit("a"), F.when(F.col("doc_id") % 3 == 0, "b").otherwise("a")).alias("hashes"), F.transform(ls, lambda x, i: F.struct(i.alias("id"), x.alias("text"))).alias("outcomes"),
        F.transform(ls, lambda x, i: F.struct(i.alias("id"), kind(x, i).alias("kind"), x.alias("text"))).alias("objectives"), F.transform(ls, lambda x: F.struct(x.alias("title"))).alias("lessons"),
    )
    return evidence.validate(c, ("fr",)).select("doc_id", F.size("warnings").cast("long").alias("n_warnings"), F.size("errors").cast("long").alias("n_errors"))


@query(f"SELECT doc_id, source FROM documents WHERE NOT ({sql_any('source', ('src1', 'src7'))}) AND NOT {sql_any('text', ('idiot',))}")
def course_filter(t):
    return t.documents.where(~tx.contains_any("source", ("src1", "src7")) & ~tx.contains_any("text", ("idiot",))).select("doc_id", "source")


@query(f"WITH {LINES} SELECT doc_id, line_no, md5(line) AS line_md5 FROM lines WHERE trim(line) <> '' AND NOT {sql_any('line', config.GRADING)} AND length(trim(line)) >= 2")
def grading_filter(t):
    rows = lines_of(t).where((F.trim("line") != "") & ~tx.is_grading_event("line") & (F.char_length(F.trim("line")) >= 2))
    return rows.select("doc_id", "line_no", F.md5("line").alias("line_md5"))


# Guards run with the domain's own words over synthetic labels, and evidence made of parts' types.
LABELS = "CASE p_partkey % 9 WHEN 0 THEN 'use microprocessor' WHEN 1 THEN 'handle patient data' WHEN 2 THEN 'ethical hacking' WHEN 3 THEN 'apply COBIT and ITIL' WHEN 4 THEN 'iso/iec 27001 audits' WHEN 5 THEN 'harvest crops' ELSE p_name END"
EVID = "CASE WHEN l_linenumber = 1 AND l_partkey % 2 = 0 THEN 'nursing and clinical care with crop yield' WHEN l_linenumber = 2 AND l_partkey % 3 = 0 THEN 'penetration test of isms and itil' ELSE l_returnflag END"


def guard_rows(t):
    units = t.lineitem.select(F.col("l_orderkey").alias("course_code"), F.expr("CASE WHEN l_quantity > 10 THEN 'CLO' WHEN l_quantity > 5 THEN 'BAI_HOC' ELSE 'MO_TA' END").alias("source_type"), F.lit("full").alias("subtype"), F.expr(EVID).alias("text"), (F.col("l_linestatus") == "X").alias("is_boilerplate"))
    have = routing.signals(units)
    rows = t.lineitem.select(F.col("l_orderkey").alias("course_code"), F.col("l_partkey").alias("p_partkey")).distinct().join(t.part, "p_partkey")
    return rows.select("course_code", "p_partkey", F.expr(LABELS).alias("label"), F.concat(F.lit("u"), "p_partkey").alias("uri")).join(have, "course_code", "left")


EVIDENCE_SQL = f"""ev AS (SELECT l_orderkey AS course_code, {EVID} AS tx FROM lineitem WHERE l_quantity > 5),
cand AS (SELECT DISTINCT l_orderkey AS course_code, l_partkey AS p_partkey FROM lineitem), lab AS (SELECT c.*, {LABELS} AS label FROM cand c JOIN part USING (p_partkey))"""


def signal_sql(words) -> str:
    return f"EXISTS (SELECT 1 FROM ev WHERE ev.course_code = lab.course_code AND {sql_any('tx', words)})"


DOMAIN_SQL = " OR ".join(f"({sql_any('label', g)} AND NOT {signal_sql(g)})" for g in config.BLOCKED_KEYWORDS)


@query(f"WITH {EVIDENCE_SQL} SELECT course_code, p_partkey, label FROM lab WHERE {DOMAIN_SQL}")
def domain_block(t):
    return guard_rows(t).where(routing.domain_blocked(F.col("label"), F.col("domain_signal"))).select("course_code", "p_partkey", "label")


@query(f"WITH {EVIDENCE_SQL} SELECT course_code, p_partkey, label FROM lab WHERE {sql_any('label', config.OFFENSIVE_KEYWORDS)} AND NOT {signal_sql(config.OFFENSIVE_KEYWORDS)}")
def security_drift(t):
    return guard_rows(t).where(routing.security_drift(F.col("uri"), F.col("label"), F.col("offensive_signal"))).select("course_code", "p_partkey", "label")


FRAME_SQL = "CASE " + " ".join(f"WHEN {sql_any('label', (*a, n))} THEN NOT {signal_sql((*a, n))}" for n, a in config.FRAMEWORKS) + " ELSE false END"


@query(f"WITH {EVIDENCE_SQL} SELECT course_code, p_partkey, label FROM lab WHERE {FRAME_SQL}")
def framework_guard(t):
    return guard_rows(t).where(routing.framework_guard(F.col("label"), F.col("framework_signal"))).select("course_code", "p_partkey", "label")


@query("SELECT p_partkey, p_name IN ('a') OR contains(lower(p_type), 'steel') OR contains(lower(p_name), 'part 1') AS capstone FROM part")
def capstone_flag(t):
    return t.part.select("p_partkey", routing.is_capstone(F.col("p_name"), F.concat_ws(" ", "p_type", F.lower("p_name")), ("a",), ("steel", "part 1")).alias("capstone"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'FOUNDATIONAL' WHEN 1 THEN 'CORE' WHEN 2 THEN 'SPECIALIZED' WHEN 3 THEN 'CORE' END AS course_type FROM part""")
def course_type(t):
    sections = F.expr("CASE p_partkey % 5 WHEN 0 THEN array('I.2', 'II.2') WHEN 1 THEN array('II.2') WHEN 2 THEN array('II.3') WHEN 3 THEN array('IX.1', 'II.2') ELSE array() END")
    return t.part.select("p_partkey", routing.course_type(sections).alias("course_type"))


# --- retrieval ---
TOK = r"SELECT {id} AS {name}, unnest(regexp_split_to_array(lower({text}), '\s+')) AS term FROM {table}"
POST = f"tok AS MATERIALIZED ({TOK.format(id='doc_id', name='doc', text='text', table='documents')}), post AS MATERIALIZED (SELECT doc, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY ALL)"
STAT = """dl AS (SELECT doc, sum(tf) AS dl FROM post GROUP BY doc), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
rawidf AS MATERIALIZED (SELECT term, df, ln((n - df + 0.5) / (df + 0.5)) AS raw FROM (SELECT term, count(*) AS df FROM post GROUP BY term), st),
mean AS (SELECT avg(raw) AS m FROM rawidf), idf AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END AS idf FROM rawidf, mean)"""
BM25 = f"""qt AS ({TOK.format(id='item_id', name='query', text='text', table='benchmark')}), q AS (SELECT query, term, count(*) AS qtf FROM qt WHERE term <> '' GROUP BY ALL),
sc AS (SELECT query, doc, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM q JOIN post USING (term) JOIN idf USING (term) JOIN dl USING (doc), st GROUP BY ALL),
lex AS (SELECT * FROM (SELECT query, doc, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM sc) WHERE rank <= 10 AND score > 0)"""


def index_of(t):
    return retrieval.build_index(t.documents, "doc_id", F.col("text"))


def asked(t):
    return t.benchmark.select(F.col("item_id").alias("query"), "text")


@query(f"WITH {POST} SELECT doc, term, tf FROM post")
def bm25_postings(t):
    return retrieval.postings(t.documents, "doc_id", F.col("text")).drop("dl")


@query(f"WITH {POST}, {STAT} SELECT term, df, round(idf, 6) AS idf FROM idf")
def bm25_idf(t):
    return index_of(t).idf.select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {POST}, {STAT}, {BM25} SELECT query, doc, score, rank::INT AS rank FROM lex")
def bm25_topk(t):
    return retrieval.bm25_top(asked(t), index_of(t), 10)


ALT = r"""tok AS (SELECT p_partkey AS doc, unnest(regexp_split_to_array(lower(CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_name || ' ' || p_brand || ' ' || p_type END), '\s+')) AS term FROM part), post AS (SELECT doc, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY ALL)"""


@query(f"WITH {ALT}, {STAT} SELECT term, df, round(idf, 6) AS idf, (SELECT n FROM st) AS n_docs FROM idf")
def bm25_alt_labels(t):
    text = F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    index = retrieval.build_index(t.part, "p_partkey", text)
    return index.idf.select("term", "df", F.round("idf", 6).alias("idf"), F.lit(index.n_docs).alias("n_docs"))


DENSE = """dots AS (SELECT q.vec_id AS query, d.vec_id AS doc, round(list_sum(list_transform(list_zip(q.embedding, d.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 6) AS score FROM embeddings q, embeddings d WHERE q.vec_id % 50 = 0),
den AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM dots) WHERE rank <= 10)"""


def dense_of(t, k=10):
    corpus = t.embeddings.select(F.col("vec_id").alias("doc"), F.col("embedding").alias("vector"))
    # The query set: all rows whose id is divisible by 50.
    return retrieval.dense_top(t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector")), corpus, k)


@query(f"WITH {DENSE} SELECT query, doc, score, rank::INT AS rank FROM den")
def dense_topk(t):
    return dense_of(t)


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))), 6) AS norm, 1.0::DOUBLE AS unit FROM embeddings")
def l2_normalize(t):
    u = t.embeddings.select("vec_id", F.col("embedding").alias("e"), retrieval.l2_normalize(F.col("embedding")).alias("u"))
    size = lambda c: F.round(F.sqrt(retrieval.dot(F.col(c), F.col(c))), 6)
    return u.select("vec_id", size("e").alias("norm"), size("u").alias("unit"))


BOTH = f"{POST}, {STAT}, {BM25}, {DENSE}, hits AS (SELECT query, 'bm25' AS channel, doc AS uri, score, rank FROM lex UNION ALL SELECT query, 'dense', doc, score, rank FROM den)"


def hits_of(t):
    corpus = t.embeddings.select(F.col("vec_id").alias("doc"), F.col("embedding").alias("vector"))
    vectors = t.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return retrieval.hybrid(asked(t), index_of(t), vectors, corpus, 10)


@query(f"WITH {BOTH} SELECT query, channel, uri, score, rank::INT AS rank FROM hits")
def hybrid_retrieval(t):
    return hits_of(t)


AGREE = "CASE WHEN bm25_rank IS NULL OR dense_rank IS NULL THEN 'SINGLE_RETRIEVER' WHEN bm25_rank <= 5 AND dense_rank <= 5 THEN 'STRONG' WHEN bm25_rank > 15 AND dense_rank > 15 THEN 'WEAK' ELSE 'PARTIAL' END"
FUSE = f"""fused AS (SELECT query, uri, round(sum(1 / (60 + rank)), 8) AS rrf, min(CASE WHEN channel = 'bm25' THEN rank END)::INT AS bm25_rank, min(CASE WHEN channel = 'dense' THEN rank END)::INT AS dense_rank FROM hits GROUP BY ALL),
top AS (SELECT *, {AGREE} AS agreement, row_number() OVER (PARTITION BY query ORDER BY rrf DESC, uri)::INT AS fused_rank FROM fused)"""


@query(f"WITH {BOTH}, {FUSE} SELECT * FROM top WHERE fused_rank <= 5")
def rrf_fuse(t):
    return retrieval.rrf(hits_of(t), ["query"], top=5).drop("channels")


@query(f"WITH r AS (SELECT l_orderkey, l_partkey, nullif((l_quantity::INT % 21), 0) AS bm25_rank, nullif((l_suppkey % 23)::INT, 0) AS dense_rank FROM lineitem) SELECT l_orderkey, l_partkey, {AGREE} AS agreement, least(coalesce(bm25_rank, 999), coalesce(dense_rank, 999)) AS best FROM r")
def agreement_label(t):
    r = t.lineitem.select("l_orderkey", "l_partkey", F.expr("nullif(cast(l_quantity as int) % 21, 0)").alias("a"), F.expr("nullif(cast(l_suppkey % 23 as int), 0)").alias("b"))
    return r.select("l_orderkey", "l_partkey", retrieval.agreement(F.col("a"), F.col("b")).alias("agreement"), tx.best_rank("a", "b").alias("best"))


AGGS = "SELECT l_returnflag AS course, l_partkey AS uri, round(sum(l_quantity), 2) AS a, round(sum(l_extendedprice), 2) AS b, round(avg(l_discount), 6) AS c FROM lineitem GROUP BY ALL"
RANKED = " UNION ALL ".join(f"SELECT course, '{n}' AS channel, uri, {c} AS score, row_number() OVER (PARTITION BY course ORDER BY {c} DESC, uri) AS rank FROM g" for n, c in (("bm25", "a"), ("faiss", "b"), ("xlm", "c")))


def part_scores(t):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("course"), F.col("l_partkey").alias("uri")).agg(tx.rounded(F.sum("l_quantity"), 2).alias("a"), tx.rounded(F.sum("l_extendedprice"), 2).alias("b"), tx.rounded(F.avg("l_discount"), 6).alias("c"))


@query(f"""WITH g AS ({AGGS}), r AS ({RANKED}), f AS (SELECT course, uri, round(sum(1 / (60 + rank)), 8) AS rrf, min(CASE WHEN channel = 'bm25' THEN rank END)::INT AS bm25_rank, min(CASE WHEN channel = 'faiss' THEN rank END)::INT AS faiss_rank, min(CASE WHEN channel = 'xlm' THEN rank END)::INT AS xlm_rank FROM r GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY course ORDER BY rrf DESC, uri)::INT AS fused_rank FROM f) WHERE fused_rank <= 30""")
def rrf_three_channel(t):
    g = part_scores(t)
    hits = g.select("course", "uri", F.explode(F.create_map(F.lit("bm25"), "a", F.lit("faiss"), "b", F.lit("xlm"), "c")).alias("channel", "score"))
    return retrieval.rrf(hits, ["course"], top=30, channels=("bm25", "faiss", "xlm")).drop("channels", "agreement")


@query("""SELECT l_partkey, l_extendedprice, l_orderkey FROM (SELECT l_partkey, l_extendedprice, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey) AS n FROM lineitem) WHERE n = 1""")
def max_by_dedup(t):
    return ranking.max_by_key(t.lineitem.select("l_partkey", "l_extendedprice", "l_orderkey"), ["l_partkey"], "l_extendedprice", ["l_orderkey"])


SIGNALS = f"""g AS ({AGGS}), s AS (SELECT *, CASE WHEN max(a) OVER w = min(a) OVER w THEN 1.0 ELSE (a - min(a) OVER w) / (max(a) OVER w - min(a) OVER w) END AS na,
  CASE WHEN max(b) OVER w = min(b) OVER w THEN 1.0 ELSE (b - min(b) OVER w) / (max(b) OVER w - min(b) OVER w) END AS nb FROM g WINDOW w AS (PARTITION BY course))"""


@query(f"WITH {SIGNALS} SELECT course, uri, round(na, 6) AS norm, row_number() OVER (PARTITION BY course ORDER BY round(na, 6) DESC, uri)::INT AS rank FROM s")
def minmax_rank(t):
    n = ranking.min_max(part_scores(t), ["course"], "a", "norm").withColumn("norm", F.round("norm", 6))
    return ranking.rank(n, ["course"], [F.col("norm").desc(), F.col("uri")]).select("course", "uri", "norm", "rank")


@query(f"""WITH {SIGNALS}, f AS (SELECT course, uri, 0.4 * na + 0.4 * nb + 0.2 * c AS x FROM s)
SELECT course, uri, round(x, 6) AS final_score, n::INT AS final_rank FROM (SELECT *, row_number() OVER (PARTITION BY course ORDER BY round(x, 6) DESC, uri) AS n FROM f) WHERE n <= 15""")
def multi_signal_rank(t):
    g = part_scores(t).select("course", "uri", F.col("a").alias("rrf"), F.col("b").alias("esco"), F.col("c").alias("evidence"))
    return ranking.multi_signal(g, "course", "uri", 0.4, 0.4, 0.2, 15).select("course", "uri", F.round("final_score", 6).alias("final_score"), "final_rank")


SIMS = "near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS n FROM dots) WHERE n <= 50), sims AS (SELECT query AS course, doc % 7 AS uri, label AS origin, doc AS sentence, score AS sim FROM near JOIN embeddings ON doc = vec_id)"


def sims_of(t):
    near = dense_of(t, 50).join(t.embeddings.select(F.col("vec_id").alias("doc"), "label"), "doc")
    return near.select(F.col("query").alias("course"), (F.col("doc") % 7).alias("uri"), F.col("label").alias("origin"), F.col("doc").alias("sentence"), F.col("score").alias("sim"))


@query(f"""WITH {DENSE}, {SIMS}, o AS (SELECT course, uri, origin, max(sim) AS top, arg_min(sentence, (-sim, sentence)) AS sentence FROM sims GROUP BY ALL)
SELECT course, uri, round(avg(top) + 1e-9, 6) AS evidence, arg_min(sentence, (-top, origin)) AS evidence_text FROM o GROUP BY ALL""")
def evidence_score(t):
    return ranking.evidence_scores(sims_of(t)).withColumn("evidence", F.round(F.col("evidence") + 1e-9, 6))


@query(f"""WITH {DENSE}, {SIMS}, o AS (SELECT course, uri, origin, max(sim) AS score, arg_min(sentence, (-sim, sentence)) AS sentence FROM sims GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY course, uri ORDER BY score DESC, origin)::INT AS origin_rank FROM o""")
def origin_best(t):
    return ranking.origin_sentences(sims_of(t))


@query(f"""WITH g AS ({AGGS}), r AS (SELECT course, uri, round(b / 1000000, 8) AS rrf, CASE WHEN uri % 4 <> 0 THEN c * 10 END AS x FROM g), f AS (SELECT *, row_number() OVER (PARTITION BY course ORDER BY rrf DESC, uri) AS n FROM r),
c AS (SELECT course, uri, CASE WHEN n <= 30 AND x IS NOT NULL THEN 0.7 * x + 0.3 * rrf ELSE rrf END AS combined, n::INT AS rrf_rank FROM f)
SELECT course, uri, round(combined, 6) AS combined, rrf_rank, row_number() OVER (PARTITION BY course ORDER BY round(combined, 6) DESC, uri)::INT AS combined_rank FROM c""")
def rerank_prefix(t):
    g = part_scores(t).select("course", "uri", tx.rounded(F.col("b") / 1000000, 8).alias("rrf"), F.when(F.col("uri") % 4 != 0, F.col("c") * 10).alias("cross"))
    return ranking.rerank_prefix(g, "course", "uri", 30, 0.7, 0.3).select("course", "uri", tx.rounded("combined", 6).alias("combined"), "rrf_rank", "combined_rank")


# --- routing, over (priority class of order, part) as (course, skill) ---
CAND = f"""SELECT o_orderpriority AS course_code, l_partkey AS uri, {LABELS.replace('p_partkey', 'l_partkey').replace('ELSE p_name', "ELSE CASE WHEN l_partkey % 4 = 0 THEN 'design of ' ELSE 'legal ' END || l_partkey")} AS label,
  round(avg(l_discount) * 10, 6) AS rerank, round(avg(l_tax) * 10, 6) AS combined, round(avg(l_quantity) / 50, 6) AS avg_weight, round(0.004 + avg(l_tax) / 10, 8) AS rrf,
  (min(l_suppkey) % 25 + 1)::INT AS bm25_rank, (max(l_suppkey) % 25 + 1)::INT AS dense_rank FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""


def candidates_of(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    label = F.expr(LABELS.replace("p_partkey", "l_partkey").replace("ELSE p_name", "ELSE CASE WHEN l_partkey % 4 = 0 THEN 'design of ' ELSE 'legal ' END || l_partkey"))
    g = j.groupBy(F.col("o_orderpriority").alias("course_code"), F.col("l_partkey").alias("uri"), label.alias("label")).agg(
        F.round(F.avg("l_discount") * 10, 6).alias("rerank"), F.round(F.avg("l_tax") * 10, 6).alias("combined"), F.round(F.avg("l_quantity") / 50, 6).alias("avg_weight"), F.round(0.004 + F.avg("l_tax") / 10, 8).alias("rrf"),
        (F.min("l_suppkey") % 25 + 1).cast("int").alias("bm25_rank"), (F.max("l_suppkey") % 25 + 1).cast("int").alias("dense_rank"),
    )
    kind = F.when(F.col("uri") % 2 == 0, "knowledge").otherwise("skill")
    g = g.withColumn("concept_type", kind).withColumn("course_type", F.when(F.col("course_code") == "1-URGENT", "FOUNDATIONAL").otherwise("CORE")).withColumn("capstone", F.col("course_code") == "5-LOW")
    g = g.withColumn("agreement", retrieval.agreement(F.col("bm25_rank"), F.col("dense_rank"))).withColumn("mismatch_flagged", F.col("uri") % 11 == 0).withColumn("esco_type_agrees", F.col("uri") % 22 != 0)
    units = t.orders.select(F.col("o_orderpriority").alias("course_code"), F.lit("CLO").alias("source_type"), F.lit("full").alias("subtype"), F.when(F.col("o_orderpriority") == "2-HIGH", "clinical itil exploit").otherwise("none").alias("text"), F.lit(False).alias("is_boilerplate"))
    return g.join(routing.signals(units), "course_code", "left").withColumn("uri", F.concat(F.lit("u"), F.lpad(F.col("uri").cast("string"), 9, "0")))


def words_sql(words) -> str:
    return sql_any("label", words)


HIGH = "course_code = '2-HIGH'"
GUARD_FRAME = "CASE " + " ".join(f"WHEN {words_sql((*a, n))} THEN NOT ({HIGH} AND {str(any('itil' == x for x in (*a, n)) ).lower()})" for n, a in config.FRAMEWORKS) + " ELSE false END"
GUARD_DOMAIN = " OR ".join(f"({words_sql(g)} AND NOT ({HIGH} AND {str('clinical' in g).lower()}))" for g in config.BLOCKED_KEYWORDS)
ROUTE = f"""cand AS ({CAND}), b AS (SELECT *, CASE WHEN uri % 2 = 0 THEN 'knowledge' ELSE 'skill' END AS concept_type, CASE WHEN course_code = '1-URGENT' THEN 'FOUNDATIONAL' ELSE 'CORE' END AS course_type, course_code = '5-LOW' AS cap, uri % 11 = 0 AS bad, {AGREE} AS agreement FROM cand),
g AS (SELECT *, avg_weight < 0.35 AS low, CASE WHEN {GUARD_DOMAIN} THEN 'DOMAIN_BLOCK' WHEN {words_sql(config.OFFENSIVE_KEYWORDS)} AND NOT {HIGH} THEN 'SECURITY_DRIFT' WHEN {GUARD_FRAME} THEN 'FRAMEWORK_WITHOUT_EXPLICIT_TEACHING'
  WHEN cap AND avg_weight < 0.4 THEN 'CAPSTONE_LOW_EVIDENCE_WEIGHT' WHEN bad AND uri % 22 = 0 AND avg_weight < 0.35 THEN 'TRIPLE_FAIL_MISMATCH' WHEN agreement = 'WEAK' AND bad THEN 'WEAK_RETRIEVAL_MISMATCH' WHEN agreement = 'WEAK' AND cap THEN 'WEAK_RETRIEVAL_CAPSTONE' END AS guard,
  coalesce(rerank, combined) - CASE WHEN bad THEN 0.025 ELSE 0 END AS s, CASE WHEN bad THEN greatest(0, combined - 0.025) ELSE combined END AS c2, CASE WHEN agreement = 'STRONG' THEN 0.01 ELSE 0 END AS bonus FROM b),
h AS (SELECT *, CASE WHEN cap THEN 0.74 WHEN concept_type = 'knowledge' THEN 0.8 ELSE 0.85 END - bonus AS t1, CASE WHEN cap THEN 0.74 WHEN concept_type = 'knowledge' THEN 0.65 ELSE 0.75 END - bonus AS t2, CASE WHEN cap THEN 0.74 WHEN concept_type = 'knowledge' THEN 0.35 ELSE 0.4 END - bonus AS t4 FROM g),
i AS (SELECT *, CASE WHEN s >= t1 THEN 'PRIMARY' WHEN s >= t2 THEN 'SECONDARY' WHEN s >= t4 THEN 'OPTIONAL' ELSE 'low_confidence' END AS tr FROM h),
j AS (SELECT *, tr = 'PRIMARY' AND rerank >= t1 AND rrf < 0.005 AS down, guard IS NULL AND tr IN ('PRIMARY', 'SECONDARY') AS qual, c2 + CASE least(bm25_rank, dense_rank) WHEN 1 THEN 0.015 WHEN 2 THEN 0.01 ELSE 0 END AS priority,
  CASE WHEN cap THEN 10 WHEN course_type = 'FOUNDATIONAL' AND concept_type = 'skill' THEN 7 WHEN course_type = 'FOUNDATIONAL' THEN 13 ELSE 15 END AS lim,
  CASE WHEN cap AND contains(label, 'design') THEN 'design' WHEN cap AND {words_sql(('legal', 'compliance', 'regulation'))} THEN 'law' END AS cluster FROM i),
k AS (SELECT *, qual AND coalesce(row_number() OVER (PARTITION BY course_code, concept_type, qual, cluster ORDER BY round(priority, 9) DESC, uri) > CASE cluster WHEN 'design' THEN 3 WHEN 'law' THEN 2 END, false) AS skipped FROM j),
m AS (SELECT *, CASE WHEN qual AND NOT skipped THEN row_number() OVER (PARTITION BY course_code, concept_type, qual, skipped ORDER BY round(priority, 9) DESC, uri) END AS cap_rank FROM k),
routed AS (SELECT course_code, 'u' || lpad(uri::VARCHAR, 9, '0') AS uri, uri AS part, concept_type, label, low, CASE WHEN qual THEN round(priority, 6) END AS priority, cap_rank::INT AS cap_rank, CASE WHEN NOT qual THEN 'low_confidence' WHEN down THEN 'SECONDARY' ELSE tr END AS tier,
  CASE WHEN NOT qual THEN 'LOW' WHEN down OR tr = 'SECONDARY' THEN 'MED' ELSE 'HIGH' END AS confidence,
  coalesce(guard, CASE WHEN NOT qual THEN 'below_overflow_threshold' END, CASE WHEN skipped OR cap_rank > lim THEN 'exceeds_hard_cap_' || lim END) AS reject_reason, down FROM m),
final AS (SELECT *, CASE WHEN reject_reason IS NULL AND NOT down THEN 'ACCEPT' ELSE 'REJECT' END AS decision FROM routed)"""


@query(f"WITH {ROUTE} SELECT course_code, uri, tier, confidence, decision, reject_reason, priority, cap_rank, low AS low_evidence_quality FROM final")
def route_tiers(t):
    return routing.route(candidates_of(t)).select("course_code", "uri", "tier", "confidence", "decision", "reject_reason", F.round("priority", 6).alias("priority"), "cap_rank", "low_evidence_quality")


@query(f"WITH {ROUTE} SELECT course_code, concept_type, count_if(tier = 'PRIMARY')::BIGINT AS n_primary, count_if(tier = 'SECONDARY')::BIGINT AS n_secondary, count_if(tier = 'OPTIONAL')::BIGINT AS n_optional, count_if(tier = 'low_confidence')::BIGINT AS n_low_confidence, count_if(decision = 'ACCEPT')::BIGINT AS n_accept, count(*) AS n_all FROM final GROUP BY ALL")
def tier_summary(t):
    return routing.tier_summary(routing.route(candidates_of(t)), ["course_code", "concept_type"])


# --- verdicts, records, tags ---
@query("SELECT doc_id, CASE WHEN coalesce(quality, 1) = 1 THEN 'ACCEPT' ELSE 'REJECT' END AS decision FROM documents LEFT JOIN labels USING (doc_id)")
def verdict_join_keep(t):
    return records.verdict_keep(t.documents.select("doc_id", F.lit("ACCEPT").alias("decision")), t.labels, ["doc_id"], "quality")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def verdict_join_drop(t):
    return records.verdict_drop(t.documents.select("doc_id", "source"), t.labels, ["doc_id"], "quality")


@query("SELECT doc_id, source, toxic FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0")
def verify_flow(t):
    rows = t.documents.select("doc_id", "source", F.lit("ACCEPT").alias("decision"))
    kept = records.verdict_keep(rows, t.labels, ["doc_id"], "quality").where("decision = 'ACCEPT'")
    return kept.join(t.labels.where("toxic = 0").select("doc_id", "toxic", "quality"), "doc_id").where("quality = 1").select("doc_id", "source", "toxic")


@query("""WITH taught AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'), k AS (SELECT l_partkey, l_partkey IN (SELECT l_partkey FROM taught) AS hit, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_partkey)
SELECT l_partkey, CASE WHEN hit THEN 'removed' ELSE 'kept' END AS status, n FROM k""")
def overlap_anti(t):
    rows = t.lineitem.where("l_returnflag = 'A'").groupBy("l_partkey").agg(F.count("*").alias("n"))
    kept, gone = records.overlap(rows, t.lineitem.where("l_returnflag = 'R'"), ["l_partkey"])
    return kept.withColumn("status", F.lit("kept")).unionByName(gone.withColumn("status", F.lit("removed"))).select("l_partkey", "status", "n")


@query("""WITH x AS (SELECT o_orderpriority AS course_code, l_partkey AS uri, l_returnflag AS src, l_linenumber || '' AS eid, l_linestatus AS mention, l_linenumber AS pos FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT course_code, uri, mention, min(pos) AS pos FROM x GROUP BY ALL)
SELECT course_code, uri, array_to_string(list_sort(list(DISTINCT eid)), ',') AS evidence, array_to_string(list_sort(list(DISTINCT src)), ',') AS sources, any_value(mm.s) AS matched_mention, any_value(p_name) AS label, 'skill' AS concept_type
FROM x JOIN (SELECT course_code, uri, array_to_string(list(mention ORDER BY pos, mention), '; ') AS s FROM m GROUP BY ALL) AS mm USING (course_code, uri) LEFT JOIN part ON uri = p_partkey GROUP BY course_code, uri""")
def record_provenance(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("course_code"), F.col("l_partkey").alias("uri"), F.col("l_linenumber").cast("string").alias("line"), "l_returnflag", F.col("l_linestatus").alias("mention"), F.col("l_linenumber").alias("pos"))
    j = j.withColumn("evidence_id", F.concat_ws("/", "line", "l_returnflag"))
    units = j.select("evidence_id", F.col("l_returnflag").alias("source_type"), F.lit("").alias("text")).distinct()
    meta = t.part.select(F.col("p_partkey").alias("uri"), F.col("p_name").alias("label"), F.lit(None).cast("string").alias("skill_type"))
    out = records.build(j.select("course_code", "uri").distinct(), j, units, meta)
    ids = F.array_join(F.array_sort(F.array_distinct(F.transform("evidence_ids", lambda x: F.split(x, "/")[0]))), ",")
    return out.select("course_code", "uri", ids.alias("evidence"), "sources", "matched_mention", "label", "concept_type")


LINKED = """x AS (SELECT o_orderpriority AS course_code, l_partkey AS uri, l_linenumber || '/' || l_returnflag AS eid, l_linestatus AS mention, l_linenumber AS pos, l_returnflag AS src, CASE l_returnflag WHEN 'A' THEN 'skill' WHEN 'R' THEN 'knowledge' END AS head, l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT course_code, uri, eid, mention, min(pos) AS pos FROM x GROUP BY ALL), e AS (SELECT course_code, uri, eid, min(pos) AS pos, array_to_string(list(mention ORDER BY pos, mention), '; ') AS mm FROM m GROUP BY ALL),
ev AS (SELECT course_code, uri, count(*) AS n, md5(array_to_string(list(eid || '|' || split_part(eid, '/', 2) || '|' || mm ORDER BY pos, eid), ';')) AS h FROM e WHERE NOT starts_with(eid, '7/') GROUP BY ALL),
hd AS (SELECT course_code, uri, CASE WHEN count(head) > 0 THEN CASE WHEN count_if(head = 'skill') >= count_if(head = 'knowledge') THEN 'skill' ELSE 'knowledge' END END AS signal, string_agg(DISTINCT src, ',' ORDER BY src) AS sources, round(avg(l_discount), 6) AS confidence FROM x GROUP BY ALL),
k AS (SELECT hd.*, uri % 3 <> 0 AS known, CASE WHEN uri % 3 <> 0 AND uri % 2 = 0 THEN 'knowledge' ELSE 'skill' END AS concept FROM hd)"""


@query(f"""WITH {LINKED} SELECT k.course_code, k.uri, CASE WHEN known THEN p_name ELSE 'c' || k.uri END AS preferred_label, concept AS concept_type, CASE WHEN concept = 'knowledge' THEN 'TEACHES_KNOWLEDGE' ELSE 'TEACHES_SKILL' END AS relation_type,
coalesce(n, 0) AS n_evidence, coalesce(h, md5('')) AS evidence_md5, sources, signal AS head, coalesce(signal = concept, true) AS agrees, coalesce(signal <> concept, false) OR k.uri % 11 = 0 AS flagged, confidence FROM k JOIN part ON p_partkey = k.uri LEFT JOIN ev USING (course_code, uri)""")
def teacher_records(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderpriority").alias("course_code"), F.col("l_partkey").alias("uri"), F.concat_ws("/", F.col("l_linenumber").cast("string"), "l_returnflag").alias("evidence_id"), F.col("l_linestatus").alias("mention"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("source"), F.when(F.col("l_returnflag") == "A", "skill").when(F.col("l_returnflag") == "R", "knowledge").alias("head_type"), "l_discount")
    units = j.where("pos <> 7").select("evidence_id").distinct().withColumn("p", F.split("evidence_id", "/"))
    units = units.select("evidence_id", F.col("p")[1].alias("source_type"), F.col("p")[0].alias("source_id"), F.lit("").alias("text"), F.lit(None).cast("string").alias("subtype"), F.lit(0.5).alias("evidence_weight"), F.lit(False).alias("is_boilerplate"))
    none = F.lit(None).cast("int")
    cand = j.groupBy("course_code", "uri").agg(F.round(F.avg("l_discount"), 6).alias("confidence")).select("*", F.concat(F.lit("c"), "uri").alias("label"), (F.col("uri") % 11 == 0).alias("mismatch_penalty_applied"), none.alias("bm25_rank"), none.alias("dense_rank"), none.alias("esco_rank"))
    meta = t.part.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("uri"), F.col("p_name").alias("label"), F.when(F.col("p_partkey") % 2 == 0, "Knowledge").otherwise("skill/competence").alias("skill_type"))
    shown = F.md5(F.array_join(F.transform("evidence", lambda e: F.concat_ws("|", e["evidence_id"], e["source_type"], e["matched_mention"])), ";"))
    return records.teacher_records(cand, j, units, meta).select("course_code", "uri", "preferred_label", "concept_type", "relation_type", F.size("evidence").cast("long").alias("n_evidence"), shown.alias("evidence_md5"), F.col("extraction.source").alias("sources"), F.col("extraction.matched_head_type").alias("head"), F.col("esco_type_agrees").alias("agrees"), F.col("mismatch_flagged").alias("flagged"), "confidence")


@query(f"""WITH {ROUTE} SELECT course_code, count(*) AS total_records, count_if(concept_type = 'skill')::BIGINT AS skill_count, count_if(concept_type = 'knowledge')::BIGINT AS knowledge_count, count_if(tier = 'PRIMARY')::BIGINT AS n_primary, count_if(tier = 'low_confidence')::BIGINT AS n_low,
md5(coalesce(array_to_string(list(uri ORDER BY uri) FILTER (concept_type = 'skill'), ','), '')) AS skills, md5(coalesce(array_to_string(list(uri ORDER BY uri) FILTER (concept_type = 'knowledge'), ','), '')) AS knowledges FROM final GROUP BY course_code""")
def summary_documents(t):
    rows = routing.route(candidates_of(t)).withColumn("preferred_label", F.col("label")).withColumn("confidence", F.col("final_combined"))
    uris = lambda c: F.md5(F.array_join(F.transform(c, lambda x: x["uri"]), ",")).alias(c)
    d = F.col("tier_distribution")
    return records.summary_documents(rows).select("course_code", "total_records", "skill_count", "knowledge_count", d["PRIMARY"].alias("n_primary"), d["low_confidence"].alias("n_low"), uris("skills"), uris("knowledges"))


@query("""WITH m AS (SELECT l_orderkey, l_returnflag AS eid, l_linestatus AS mention, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL), e AS (SELECT l_orderkey, eid, array_to_string(list(mention ORDER BY pos, mention), ',') AS ms FROM m GROUP BY ALL)
SELECT l_orderkey, array_to_string(list(eid || '=' || ms ORDER BY eid), ';') AS mentions FROM e GROUP BY l_orderkey""")
def mention_map(t):
    out = retrieval.mention_map(t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("evidence_id"), F.col("l_linestatus").alias("mention"), F.col("l_linenumber").alias("pos")), ["l_orderkey"])
    each = F.transform(F.map_entries("evidence_mentions"), lambda x: F.concat_ws("=", x["key"], F.array_join(x["value"], ",")))
    return out.select("l_orderkey", F.array_join(F.array_sort(each), ";").alias("mentions"))


@query(f"""WITH {LINES}, {UNITS}, b AS (SELECT doc_id, avg(({' OR '.join(f"regexp_matches(trim(lower(line)), '{p}')" for p in config.BOILERPLATE)})::INT) AS r FROM units GROUP BY doc_id) SELECT d.doc_id, round(r, 6) AS ratio, coalesce(r > 0.6, true) AS is_sparse FROM documents d LEFT JOIN b USING (doc_id)""")
def sparse_courses(t):
    out = evidence.sparse_courses(t.documents.select(F.col("doc_id").alias("code")), units_of(t))
    return out.select(F.col("code").alias("doc_id"), F.round("boilerplate_ratio", 6).alias("ratio"), "is_sparse")


@query("""SELECT *, CASE WHEN cap_rank > 7 THEN 'exceeds_hard_cap_7' END AS reject_reason FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::INT AS cap_rank FROM part)""")
def hard_cap(t):
    return ranking.hard_cap(t.part, ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 7).select("p_partkey", "p_brand", "cap_rank", "reject_reason")


@query("""SELECT doc_id, md5(trim(source || '. ' || coalesce(nullif(ws[1], ''), lang))) AS context, md5(trim(lang || '. ' || text)) AS candidate FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN [] ELSE string_split(text, ' ') END AS ws FROM documents) WHERE doc_id % 3 = 0 OR ws[1] <> ''""")
def rerank_texts(t):
    words = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.split("text", " "))
    rows = t.documents.select("doc_id", F.col("source").alias("course_title"), F.col("lang").alias("label"), F.col("text").alias("description"), words.alias("mentions"), F.array("lang").alias("source_texts"))
    rows = rows.where((F.size("mentions") == 0) | (F.get("mentions", F.lit(0)) != ""))
    return retrieval.rerank_texts(rows).select("doc_id", F.md5("context").alias("context"), F.md5("candidate").alias("candidate"))


CONTEXT = """cdots AS (SELECT q.vec_id AS query, d.vec_id AS doc, round(list_sum(list_transform(list_zip(list_reverse(q.embedding), d.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)), 6) AS score FROM embeddings q, embeddings d WHERE q.vec_id % 50 = 0),
cden AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM cdots) WHERE rank <= 10),
every AS (SELECT query, 'bm25' AS channel, doc AS uri, score, rank FROM lex UNION ALL SELECT query, 'dense', doc, max(score), min(rank) FROM (SELECT * FROM den UNION ALL SELECT * FROM cden) GROUP BY query, doc
UNION ALL SELECT vec_id, 'esco_extract', vec_id + 1, label::DOUBLE, 1 FROM embeddings WHERE vec_id % 50 = 0)"""


@query(f"WITH {POST}, {STAT}, {BM25}, {DENSE}, {CONTEXT} SELECT query, channel, uri, score, rank::INT AS rank FROM every")
def hybrid_context(t):
    corpus = t.embeddings.select(F.col("vec_id").alias("doc"), F.col("embedding").alias("vector"))
    asked_for = t.embeddings.where("vec_id % 50 = 0")
    vectors = asked_for.select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    context = asked_for.select(F.col("vec_id").alias("query"), F.reverse("embedding").alias("vector"))
    direct = asked_for.select(F.col("vec_id").alias("query"), (F.col("vec_id") + 1).alias("uri"), F.col("label").cast("double").alias("score"))
    return retrieval.hybrid(asked(t), index_of(t), vectors, corpus, 10, context, direct)


@query("""SELECT l_orderkey, CASE WHEN count_if(l_returnflag = 'A') + count_if(l_returnflag = 'R') = 0 THEN NULL WHEN count_if(l_returnflag = 'A') >= count_if(l_returnflag = 'R') THEN 'skill' ELSE 'knowledge' END AS signal FROM lineitem GROUP BY l_orderkey""")
def head_majority(t):
    heads = F.collect_list(F.when(F.col("l_returnflag") == "A", "skill").when(F.col("l_returnflag") == "R", "knowledge").otherwise("none"))
    return t.lineitem.groupBy("l_orderkey").agg(records.head_majority(heads).alias("signal"))


TAGTOK = r"tt AS (SELECT item_id AS course_code, regexp_split_to_array(text, '\s+') AS ws FROM benchmark), tm AS (SELECT course_code, ws[i] AS mention, i AS pos FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM tt) WHERE length(trim(ws[i])) >= 2)"


def mentions_of(t):
    rows = t.benchmark.select(F.col("item_id").alias("course_code"), F.posexplode(F.split("text", r"\s+")).alias("pos", "mention"))
    return rows.select("course_code", "mention", (F.col("pos") + 1).alias("pos"), F.concat_ws("/", "course_code", F.col("pos") + 1).alias("evidence_id"))


@query(f"""WITH {TAGTOK} SELECT course_code, lower(mention) AS normalized, arg_min(mention, (pos, mention)) AS text, array_to_string(list(course_code || '/' || pos ORDER BY pos), ',') AS evidence FROM tm GROUP BY ALL""")
def concept_tags(t):
    return records.concept_tags(mentions_of(t)).select("course_code", "normalized", "text", F.array_join("evidence_ids", ",").alias("evidence"))


# Candidates are the words of a course by place modulo 7; several of them name one skill.
CANDS = f"""{TAGTOK}, aw AS (SELECT course_code, ws[i] AS mention, i AS pos FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM tt)),
pairs AS (SELECT course_code, lower(trim(mention)) AS normalized, pos % 7 % 3 AS uri, pos % 7 AS place FROM aw)"""


def tag_candidates(t):
    every = t.benchmark.select(F.col("item_id").alias("course_code"), F.posexplode(F.split("text", r"\s+")).alias("at", "mention")).withColumn("place", (F.col("at") + 1) % 7)
    cand = every.groupBy("course_code", F.col("place").cast("int").alias("pos")).agg(F.collect_set("mention").alias("mentions"))
    return cand.select("course_code", "pos", (F.col("pos") % 3).alias("uri"), "mentions", (1 / (2 + F.col("pos"))).alias("confidence"))


@query(f"""WITH {CANDS} SELECT course_code, normalized, uri::INT AS uri, round(1 / (2 + min(place)), 6) AS confidence FROM pairs GROUP BY ALL""")
def concept_edges(t):
    return records.concept_edges(tag_candidates(t)).select("course_code", "normalized", "uri", "confidence")


@query(f"""WITH {CANDS}, k AS (SELECT course_code, normalized, min(place) AS place FROM pairs GROUP BY ALL), tg AS (SELECT course_code, lower(mention) AS normalized, arg_min(mention, (pos, mention)) AS text FROM tm GROUP BY ALL)
SELECT course_code, tg.normalized, text, CASE WHEN place % 4 = 0 THEN 'foundational' WHEN {sql_any('text', config.CONCEPT_INTERPERSONAL)} THEN 'interpersonal' WHEN {sql_any('text', config.CONCEPT_COGNITIVE)} THEN 'cognitive' WHEN {sql_any('text', config.CONCEPT_METHODOLOGICAL)} THEN 'methodological' ELSE 'cognitive' END AS loai FROM tg LEFT JOIN k USING (course_code, normalized)""")
def support_tags(t):
    cand = tag_candidates(t).withColumn("skill_type", F.when(F.col("pos") % 4 == 0, "knowledge").otherwise("skill/competence"))
    return records.support_tags(mentions_of(t), cand).select("course_code", "normalized", "text", "loai")


@query(f"""WITH {CANDS}, tg AS (SELECT DISTINCT course_code, lower(mention) AS normalized FROM tm), e AS (SELECT DISTINCT course_code, normalized, uri FROM pairs), a AS (SELECT course_code, count(*) AS n FROM tg GROUP BY ALL), b AS (SELECT course_code, count(*) AS n FROM e GROUP BY ALL)
SELECT coalesce(a.course_code, b.course_code) AS course_code, coalesce(a.n, 0) AS total_concept_tags, coalesce(a.n, 0) AS total_has_concept_edges, coalesce(b.n, 0) AS total_evidence_for_edges FROM a FULL JOIN b USING (course_code)""")
def tag_documents(t):
    docs = records.tag_documents(records.concept_tags(mentions_of(t)), records.concept_edges(tag_candidates(t)), "teach")
    back = F.from_json("document", "concept_tags array<string>, has_concept_edges array<string>, evidence_for_edges array<string>")
    n = lambda c: F.size(F.col("d")[c]).cast("long")
    return docs.withColumn("d", back).select("course_code", n("concept_tags").alias("total_concept_tags"), n("has_concept_edges").alias("total_has_concept_edges"), n("evidence_for_edges").alias("total_evidence_for_edges"))


@query(f"""WITH {POST}, {STAT}, {BM25}, gold AS (SELECT item_id AS query, doc_id AS doc FROM benchmark b JOIN documents d ON contains(d.text, b.text)), hit AS (SELECT l.query, l.doc, rank FROM lex l JOIN gold USING (query, doc)),
c AS (SELECT (SELECT count(*) FROM hit) AS tp, (SELECT count(*) FROM lex) AS n_pred, (SELECT count(*) FROM gold) AS n_gold), f AS (SELECT query, min(rank) AS r FROM hit GROUP BY query)
SELECT tp, n_pred, n_gold, round(tp / n_pred, 6) AS precision, round(tp / n_gold, 6) AS recall, round(2 * tp / (n_pred + n_gold), 6) AS f1, round((SELECT avg(coalesce(1 / r, 0)) FROM (SELECT DISTINCT query FROM gold) LEFT JOIN f USING (query)), 6) AS mrr FROM c""")
def eval_metrics(t):
    index = index_of(t)
    # Each is read several times.
    found = materialize(retrieval.bm25_top(asked(t), index, 10), "found")
    gold = materialize(retrieval.containing(asked(t), t.documents.select(F.col("doc_id").alias("doc"), "text"), index), "gold")
    out = records.evaluate(found, gold, "query", "doc")
    return out.select("tp", "n_pred", "n_gold", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "mrr")))


# Lines as extractions of four classes; those of five leave no place in the source, documents of three have a code of their own.
@query(f"""WITH {LINES}, e AS (SELECT *, line_no % 4 AS k, line_no % 5 <> 0 AS placed FROM lines),
c AS (SELECT doc_id, arg_max(CASE WHEN doc_id % 5 = 0 THEN 'n/a' ELSE 'M' || line_no END, line_no) AS code, max(line_no) AS last FROM e WHERE k = 1 AND placed GROUP BY doc_id),
g AS (SELECT doc_id, count_if(k = 2 AND placed)::BIGINT AS n_goals, count_if(k = 3 AND placed)::BIGINT AS n_outcomes, count_if(k = 0 AND placed)::BIGINT AS n_lessons,
md5(array_to_string(list(CASE WHEN line_no % 8 = 2 THEN 'goal ' || line_no ELSE line END ORDER BY line_no) FILTER (k = 2 AND placed), '|')) AS goals FROM e GROUP BY doc_id)
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN 'S' || doc_id END, nullif(code, 'n/a'), doc_id::VARCHAR) AS code, last / 2 AS credits, n_goals, n_outcomes, n_lessons, goals FROM g LEFT JOIN c USING (doc_id)""")
def syllabus_extract(t):
    kinds = F.element_at(F.array(*(F.lit(k) for k in ("bai_hoc", "hoc_phan", "muc_tieu", "clo"))), (F.col("line_no") % 4 + 1).cast("int"))
    n = F.col("line_no").cast("string")
    said = {
        "ma_hoc_phan": F.when(F.col("doc_id") % 5 == 0, "n/a").otherwise(F.concat(F.lit("M"), n)),
        "so_tin_chi_tong": F.replace((F.col("line_no") / 2).cast("string"), F.lit("."), F.lit(",")),
        "noi_dung": F.when(F.col("line_no") % 8 == 2, F.concat(F.lit("goal "), n)).otherwise(" None "),
    }
    attributes = F.create_map(*(x for k, v in said.items() for x in (F.lit(k), v)))
    place = F.when(F.col("line_no") % 5 != 0, F.col("line_no"))
    e = lines_of(t).select(F.col("doc_id").cast("string").alias("source_file"), F.col("line_no").alias("pos"), kinds.alias("extraction_class"), F.col("line").alias("extraction_text"), place.alias("char_start"), place.alias("char_end"), attributes.alias("attributes"))
    none = F.lit(None).cast("string")
    own = t.documents.select(F.col("doc_id").cast("string").alias("source_file"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("S"), "doc_id")).alias("ma_hoc_phan"), none.alias("ten_vi"), none.alias("ten_en"))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return extraction.syllabi(e, own).select(F.col("source_file").cast("long").alias("doc_id"), F.col("ma_hoc_phan").alias("code"), F.col("hoc_phan.so_tin_chi_tong").alias("credits"), size("muc_tieu_hoc_phan").alias("n_goals"), size("clo").alias("n_outcomes"), size("bai_hoc").alias("n_lessons"), F.md5(F.array_join("muc_tieu_hoc_phan.noi_dung", "|")).alias("goals"))


@query("""SELECT c_custkey AS course_code, c_name AS course_name, round(c_acctbal / 3, 4) AS final_score, 'Does ' || c_name || ' support ' || c_mktsegment || '?' AS review_question, CASE WHEN c_custkey % 3 = 0 THEN 'accepted' ELSE 'accept ' || (c_custkey % 3) END AS review_status, 2 AS n_origins FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 5 <> 0""")
def review_roundtrip(t):
    c = t.customer.select(F.col("c_custkey").alias("course_code"), F.col("c_name").alias("course_name"), F.col("c_mktsegment").alias("preferred_label"), (F.col("c_acctbal") / 3).alias("final_score"), F.lit("a; b").alias("support_concept_origin"))
    sheet = records.review_sheet(c)
    k = F.col("course_code")
    status = F.when(k % 4 == 0, F.lit(" Pending ")).when(k % 5 == 0, F.lit("rejected")).when(k % 3 == 0, F.lit("Accepted ")).otherwise(F.concat(F.lit("accept "), (k % 3).cast("string")))
    done = records.accepted(sheet.withColumn("review_status", status))
    return done.select("course_code", "course_name", "final_score", "review_question", "review_status", F.size("origins").alias("n_origins"))
