"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoloom import config
from taxoloom.functions import text as tx
from taxoloom.functions import unicode as un
from taxoloom.operators import ranking
from taxoloom.plans.registry import query

#: Lines of documents, numbered from 0.
LINES = "lines AS (SELECT doc_id, (i - 1)::INT AS line_no, ls[i] AS line FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))"


def lines_of(t):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def sql_any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


@query("SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_md5, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''))::BIGINT AS n_tokens FROM documents")
def ws_normalize(t):
    return t.documents.select("doc_id", F.md5(tx.normalize_whitespace("text")).alias("text_md5"), F.size(tx.tokenize("text")).cast("long").alias("n_tokens"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', ' ', 'g'))::BIGINT AS n_chars, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS text_md5 FROM pages")
def html_strip(t):
    s = tx.strip_html_tags("html")
    return t.pages.select("page_id", F.char_length(s).cast("long").alias("n_chars"), F.md5(s).alias("text_md5"))


@query("SELECT page_id, md5(trim(regexp_replace(nfc_normalize(regexp_replace(html, '<[^>]+>', ' ', 'g')), '\\s+', ' ', 'g'))) AS text_md5 FROM pages")
def clean_text_nfc(t):
    return t.pages.select("page_id", F.md5(un.clean_text("html")).alias("text_md5"))


@query("""SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(trim(p_name)), '[^\\w\\s-]', '', 'g'), '[\\s-]+', '_', 'g'), ''), 'unknown') AS slug,
  regexp_replace(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe FROM part""")
def slug_label(t):
    return t.part.select("p_partkey", tx.slugify_label("p_name").alias("slug"), tx.safe_label(F.concat_ws(" ", "p_name", "p_type")).alias("safe"))


@query("""SELECT doc_id, md5(upper(regexp_replace(regexp_replace(strip_accents(text), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'))) AS slug_md5 FROM documents""")
def slug_ascii_upper(t):
    return t.documents.select("doc_id", F.md5(un.slug_upper(F.col("text"))).alias("slug_md5"))


@query(f"""WITH {LINES}, n AS (SELECT doc_id, line_no, replace(lower(trim(regexp_replace(nfc_normalize(line), '\\s+', ' ', 'g'))), 'ß', 'ss') AS name FROM lines) SELECT doc_id, min(line_no) AS line_no, md5(name) AS name_md5 FROM n WHERE name <> '' GROUP BY doc_id, name""")
def name_casefold_dedup(t):
    keyed = lines_of(t).withColumn("name", un.name_key(F.col("line"))).where("name <> ''")
    return ranking.keep_first(keyed.select("doc_id", "name", "line_no"), ["doc_id", "name"], ["line_no"]).select("doc_id", "line_no", F.md5("name").alias("name_md5"))


@query("""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.\\n;]+'), lambda x: trim(x)), lambda x: length(x) > 10) AS ss FROM documents)
SELECT doc_id, (i - 1)::BIGINT AS pos, length(ss[i])::BIGINT AS n_chars FROM (SELECT doc_id, ss, unnest(generate_series(1, len(ss))) AS i FROM s)""")
def sentence_split(t):
    rows = t.documents.select("doc_id", F.posexplode(tx.split_sentences("text")).alias("pos", "s"))
    return rows.select("doc_id", F.col("pos").cast("long"), F.char_length("s").cast("long").alias("n_chars"))


@query("""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM w WHERE term <> '' GROUP BY term""")
def tokenize_terms(t):
    per = t.documents.select("doc_id", F.explode(tx.tokenize("text")).alias("term")).groupBy("doc_id", "term").count()
    return per.groupBy("term").agg(F.count("*").alias("df"), F.sum("count").alias("cf"))


MIXED = "CASE event_id % 7 WHEN 0 THEN ' NULL ' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '-' WHEN 4 THEN ' 3,5 ' WHEN 5 THEN event_type || ', ,' || user_id ELSE event_type END"


@query(f"""WITH e AS (SELECT event_id, {MIXED} AS s FROM events)
SELECT event_id, CASE WHEN lower(trim(s)) IN ('null', 'none', '', 'n/a') THEN NULL ELSE trim(s) END AS cleaned, try_cast(replace(trim(s), ',', '.') AS DOUBLE) AS number,
  array_to_string(list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts,
  array_to_string(list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: lower(x) NOT IN ('null', 'none', 'n/a', '-')), '|') AS items FROM e""")
def null_token_clean(t):
    e = t.events.select("event_id", F.expr(MIXED).alias("s"))
    return e.select("event_id", tx.clean_str("s").alias("cleaned"), tx.safe_float("s").alias("number"), F.array_join(tx.split_list("s"), "|").alias("parts"), F.array_join(tx.clean_list(F.split("s", ",")), "|").alias("items"))


GROUP = "CASE o_orderkey % 4 WHEN 0 THEN 'I.' || (o_orderkey % 9) || '. ' || o_orderpriority || ' — ' || (o_orderkey % 30) || '.0 tín chỉ' WHEN 1 THEN 'II.' || (o_orderkey % 9) || '. ' || o_orderpriority || ' — 12.5 tín chỉ - Nhóm a' || (o_orderkey % 3) WHEN 2 THEN o_orderpriority || ' — 3 tín chỉ' ELSE ' ' || o_orderpriority || ' ' END"
FULL = r"^([IVX]+\.\d+)\.\s+(.+?)\s+—\s+([\d.]+)\s+tín chỉ(?:\s*-\s*(.*))?$"
BASE = r"^(?:[IVX]+\.\d+\.\s+)?(.+?)\s+—\s+[\d.]+\s+tín chỉ(?:\s*-\s*.*)?$"


@query(f"""WITH g AS (SELECT o_orderkey, trim({GROUP}) AS s FROM orders), p AS (SELECT *, regexp_matches(s, '{FULL}') AS fits FROM g)
SELECT o_orderkey, CASE WHEN fits THEN regexp_extract(s, '{FULL}', 1) ELSE '?' END AS section, CASE WHEN fits THEN regexp_extract(s, '{FULL}', 2) ELSE s END AS base,
  CASE WHEN fits THEN regexp_extract(s, '{FULL}', 3)::DOUBLE ELSE 0 END AS credits,
  CASE WHEN fits THEN nullif(upper(regexp_replace(regexp_extract(s, '{FULL}', 4), '^[Nn]h[oó]m\\s+', '')), '') END AS sub,
  CASE WHEN regexp_matches(s, '{BASE}') THEN regexp_extract(s, '{BASE}', 1) ELSE s END AS base_name FROM p""")
def group_name_parse(t):
    g = t.orders.select("o_orderkey", F.expr(GROUP).alias("s"))
    return g.select("o_orderkey", tx.parse_group_name("s").alias("p"), tx.group_base_name("s").alias("base_name")).select("o_orderkey", "p.*", "base_name")


@query("SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1) AS tail FROM pages")
def uri_tail(t):
    return t.pages.select("page_id", tx.uri_tail("url").alias("tail"))


@query("""WITH c AS (SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN '_BS' ELSE '' END AS code FROM customer)
SELECT c_custkey, regexp_replace(code, '_BS$', '') AS bare, CASE WHEN ends_with(code, '_BS') THEN code ELSE code || '_BS' END AS extra FROM c""")
def suffix_strip(t):
    c = t.customer.select("c_custkey", F.expr("c_name || CASE WHEN c_custkey % 3 = 0 THEN '_BS' ELSE '' END").alias("code"))
    return c.select("c_custkey", tx.strip_bs("code").alias("bare"), tx.add_bs("code").alias("extra"))


@query("SELECT c_custkey, md5('=' || c_name || chr(31) || coalesce('=' || c_mktsegment, '~') || chr(31) || coalesce('=' || c_nationkey, '~')) AS digest FROM customer")
def content_hash(t):
    return t.customer.select("c_custkey", tx.content_hash("c_name", "c_mktsegment", "c_nationkey").alias("digest"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, '```json' || chr(10) || props || chr(10) || '```' AS fenced FROM events")
def json_payload(t):
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return t.events.select("event_id", tx.parse_json_answer(fenced, "k bigint")["k"].alias("k"), fenced.alias("fenced"))


@query(f"""WITH {LINES}, f AS (SELECT doc_id, regexp_matches(trim(lower(line)), 'is.{{0,20}}(ed|of|in)') OR regexp_matches(trim(lower(line)), '^(the|le|der) ') AS b FROM lines WHERE trim(line) <> '')
SELECT doc_id, round(avg(b::INT), 6) AS ratio, avg(b::INT) > 0.6 AS sparse FROM f GROUP BY doc_id""")
def boilerplate_flags(t):
    rows = lines_of(t).where(F.trim("line") != "").withColumn("b", tx.is_boilerplate("line", ("is.{0,20}(ed|of|in)", "^(the|le|der) ")))
    return rows.groupBy("doc_id").agg(F.round(F.avg(F.col("b").cast("int")), 6).alias("ratio"), (F.avg(F.col("b").cast("int")) > 0.6).alias("sparse"))


@query("SELECT p_partkey, CASE WHEN contains(lower(p_type), 'knowledge') THEN 'knowledge' ELSE 'skill' END AS concept_type, lower(p_type) AS kind FROM part")
def type_map(t):
    return t.part.select("p_partkey", tx.concept_kind("p_type").alias("concept_type"), F.lower("p_type").alias("kind"))


@query(r"""SELECT doc_id, md5(text[1:200]) AS head200, md5(text[1:6000]) AS head6000, md5(array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')[1:5], ' ')) AS first5,
  md5(trim(regexp_replace(regexp_replace(regexp_replace('12. ' || text, '^\s*\d+[.)]\s*', ''), '^\s*[a-zA-Z][.)]\s*', ''), '\s+', ' ', 'g'))) AS denoised FROM documents""")
def text_slices(t):
    five = F.array_join(F.slice(tx.tokenize("text", lower=False), 1, 5), " ")
    return t.documents.select("doc_id", F.md5(F.substring("text", 1, 200)).alias("head200"), F.md5(F.substring("text", 1, 6000)).alias("head6000"), F.md5(five).alias("first5"), F.md5(tx.strip_noise(F.concat(F.lit("12. "), "text"))).alias("denoised"))


@query("SELECT item_id, md5('llm_v1_' || item_id) AS cache_key FROM benchmark")
def cache_keys(t):
    return t.benchmark.select("item_id", tx.cache_key(F.col("item_id").cast("string"), "v1").alias("cache_key"))


@query("""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(trim(x), ',+$', ''))), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, len(ls)::BIGINT AS n_items, md5(array_to_string(list_transform(ls[1:3], lambda x: lower(x)), '|')) AS first3 FROM p""")
def list_parse(t):
    items = tx.lines_list("text", strip_comma=True)
    return t.documents.select("doc_id", F.size(items).cast("long").alias("n_items"), F.md5(F.array_join(tx.valid_concepts(items, 3), "|")).alias("first3"))


@query("SELECT p_partkey, round(p_retailprice / 7, 4) AS r4, round(p_retailprice / 7, 6) AS r6 FROM part")
def round_scores(t):
    return t.part.select("p_partkey", F.round(F.col("p_retailprice") / 7, 4).alias("r4"), F.round(F.col("p_retailprice") / 7, 6).alias("r6"))


@query(f"WITH {LINES} SELECT doc_id, bool_or({sql_any('line', ('idiot', 'license', 'clown'))}) AS hit FROM lines GROUP BY doc_id")
def keyword_exists(t):
    return t.documents.select("doc_id", F.exists(F.split("text", "\n"), lambda s: tx.contains_any(s, ("idiot", "license", "clown"))).alias("hit"))


@query("SELECT l_orderkey, l_partkey, count(*) AS n, round(sum(1 / (1 + exp(-(l_discount * 10 - 0.5)))), 6) AS s FROM lineitem GROUP BY ALL")
def sigmoid_score(t):
    return t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n"), F.round(F.sum(tx.sigmoid(F.col("l_discount") * 10 - 0.5)), 6).alias("s"))


@query("SELECT p_partkey, round(1 / (exp(p_size / 10.0 - p_retailprice / 1000) + 1), 6) AS last FROM part")
def softmax_score(t):
    return t.part.select("p_partkey", F.round(tx.softmax_last(F.array(F.col("p_size") / 10, F.col("p_retailprice") / 1000)), 6).alias("last"))


CONCEPT = "p_name || ' ' || CASE p_partkey % 6 WHEN 0 THEN 'Teamwork' WHEN 1 THEN 'debugging' WHEN 2 THEN 'Research' WHEN 3 THEN 'giao tiếp nhóm' ELSE '' END"


@query(f"""SELECT p_partkey, CASE WHEN contains(lower(p_type), 'steel') THEN 'foundational' WHEN {sql_any('c', config.CONCEPT_INTERPERSONAL)} THEN 'interpersonal' WHEN {sql_any('c', config.CONCEPT_COGNITIVE)} THEN 'cognitive' WHEN {sql_any('c', config.CONCEPT_METHODOLOGICAL)} THEN 'methodological' ELSE 'cognitive' END AS loai FROM (SELECT *, {CONCEPT} AS c FROM part)""")
def concept_class(t):
    kind = F.when(tx.contains_any("p_type", ("steel",)), "knowledge").otherwise("skill/competence")
    return t.part.select("p_partkey", tx.concept_class(F.expr(CONCEPT), kind).alias("loai"))


@query("SELECT item_id, replace(text, '''', '\\''') AS escaped FROM benchmark")
def cypher_escape(t):
    return t.benchmark.select("item_id", tx.cypher_escape("text").alias("escaped"))


PREFIXED = "CASE doc_id % 4 WHEN 0 THEN 'Lesson 3: ' WHEN 1 THEN 'bài 12. ' WHEN 2 THEN 'Chapter4 - ' ELSE '' END || text"


@query(rf"""SELECT doc_id, md5(trim(regexp_replace({PREFIXED}, '^(?:Bài|Chương|Phần|Lab|Lesson|Chapter|Part)\s*\d+\s*[:.\-]*\s*', '', 'i'))) AS stripped FROM documents""")
def lesson_prefix_strip(t):
    return t.documents.select("doc_id", F.md5(tx.strip_lesson_prefix(F.expr(PREFIXED))).alias("stripped"))


@query("SELECT doc_id, md5(trim(regexp_replace(text, '[\\r\\n]', ' ', 'g'))) AS flat, md5(trim(array_to_string(list_transform(string_split(text, '.'), lambda x: replace(regexp_replace(x, '[\\r\\n]', ' ', 'g'), ';', ',')), ';'))) AS joined FROM documents")
def csv_format_values(t):
    return t.documents.select("doc_id", F.md5(tx.csv_value("text")).alias("flat"), F.md5(tx.csv_value(F.split("text", "[.]"), "array")).alias("joined"))
