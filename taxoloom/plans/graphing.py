"""Queries over reshaping, graph, taxonomy, quality and incremental operators. Orders stand for programmes, lines for courses."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators import evidence, graph, incremental, ranking, records, reshape, routing, taxonomy
from taxoloom.plans import linking
from taxoloom.plans.registry import query
from taxoloom.plans.scalars import LINES, lines_of
from taxoloom.sources import readers


# --- programmes ---
def programmes_of(t):
    """Orders of a customer as groups of a programme, their lines as courses (distinct parts)."""
    l = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.min("l_suppkey").alias("supp"))
    courses = l.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    course = F.struct(
        F.col("l_partkey").cast("string").alias("ma_hoc_phan"), F.col("p_name").alias("ten_hoc_phan"), F.lit(1.0).alias("so_tin_chi_tong"), (F.col("l_partkey") % 8).cast("string").alias("hoc_ky_goi_y"),
        F.array(F.struct(F.lit("TIEN_QUYET").alias("loai"), (F.col("l_partkey") + 1).cast("string").alias("ma_hoc_phan"))).alias("quan_he"),
    )
    per = courses.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", course.alias("c")))), lambda x: x["c"]).alias("hoc_phan"))
    o = t.orders.join(per, F.col("o_orderkey") == F.col("l_orderkey"))
    name = F.concat(F.lit("I."), (F.col("o_orderkey") % 2).cast("string"), F.lit(". "), F.col("o_orderstatus"), F.lit(" — 3.0 tín chỉ"))
    declared = F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 5).cast("double"))
    g = F.struct(name.alias("ten_nhom"), F.col("o_orderpriority").alias("loai_nhom"), declared.alias("so_tin_chi_yeu_cau"), "hoc_phan")
    return o.groupBy(F.col("o_custkey").alias("ma_ctdt")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", g.alias("g")))), lambda x: x["g"]).alias("nhom_hoc_phan"))


PROG = """o AS (SELECT o_custkey AS ma_ctdt, o_orderkey, 'I_' || (o_orderkey % 2) AS raw, o_orderstatus AS base, o_orderpriority AS loai, CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 5)::DOUBLE ELSE 3.0 END AS credits FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
g AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY ma_ctdt, raw) = 1 THEN raw ELSE raw || '_' || chr((64 + row_number() OVER (PARTITION BY ma_ctdt, raw ORDER BY o_orderkey))::INT) END AS nhom_id FROM o),
c AS (SELECT DISTINCT g.ma_ctdt, g.o_orderkey, nhom_id, l_partkey FROM g JOIN lineitem ON l_orderkey = o_orderkey)"""


@query(f"""WITH {PROG}, r AS (SELECT c.*, l_partkey + 1 AS target FROM c), have AS (SELECT DISTINCT ma_ctdt, l_partkey FROM c)
SELECT 'section' AS kind, ma_ctdt, replace(raw, '_', '.') AS k, arg_min(base, o_orderkey) || '|' || arg_min(credits, o_orderkey) || '|' || array_to_string(list(nhom_id ORDER BY o_orderkey), ',') AS detail FROM g GROUP BY ma_ctdt, raw
UNION ALL SELECT 'group', ma_ctdt, nhom_id, replace(raw, '_', '.') || '|' || base || '|' || loai || '|' || credits FROM g
UNION ALL SELECT 'course', c.ma_ctdt, c.nhom_id, replace(raw, '_', '.') || '|' || l_partkey || '|' || (l_partkey % 8) || '|1' FROM c JOIN g USING (ma_ctdt, o_orderkey)
UNION ALL SELECT 'relation', r.ma_ctdt, r.nhom_id, r.l_partkey || '|' || target || '|' || CASE WHEN h.l_partkey IS NULL THEN 'not_found' ELSE 'same_ctdt|' || p_name END FROM r LEFT JOIN have h ON h.ma_ctdt = r.ma_ctdt AND h.l_partkey = r.target LEFT JOIN part ON p_partkey = h.l_partkey
UNION ALL SELECT 'header', ma_ctdt, NULL, NULL FROM (SELECT DISTINCT ma_ctdt FROM g)""")
def programme_flatten(t):
    f = reshape.flatten(programmes_of(t))
    show = lambda df, kind, k, *cols: df.select(F.lit(kind).alias("kind"), "ma_ctdt", k.alias("k"), F.concat_ws("|", *(c if not isinstance(c, str) else F.col(c).cast("string") for c in cols)).alias("detail"))
    none = F.lit(None).cast("string")
    return graph.union([
        show(f["sections"], "section", F.col("section"), "base", "credits", F.array_join("nhom_ids", ",")), show(f["groups"], "group", F.col("nhom_id"), "section", "base", "loai_nhom", "credits"),
        show(f["courses"], "course", F.col("nhom_id"), "ma_phan", "ma_hoc_phan", "hoc_ky_goi_y", "so_quan_he"), show(f["relations"], "relation", F.col("nhom_id"), "ma_hoc_phan", "target", "resolution", "target_name"),
        f["header"].select(F.lit("header").alias("kind"), "ma_ctdt", none.alias("k"), none.alias("detail")),
    ])


@query("""SELECT p_partkey, CASE WHEN count(*) OVER w = 1 THEN k ELSE k || '_' || chr((64 + row_number() OVER (PARTITION BY p_brand, k ORDER BY p_partkey))::INT) END AS id
FROM (SELECT p_partkey, p_brand, p_size || '/' || (p_partkey % 40) AS k FROM part) WINDOW w AS (PARTITION BY p_brand, k)""")
def dup_id_suffix(t):
    p = t.part.select("p_partkey", "p_brand", F.concat_ws("/", "p_size", F.col("p_partkey") % 40).alias("k"))
    return ranking.suffix_duplicates(p, ["p_brand"], "k", ["p_partkey"], "id").select("p_partkey", "id")


@query("""SELECT conv_id, turn, md5(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS last_user FROM conversations""")
def carry_forward(t):
    out = ranking.carry_forward(t.conversations, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("text")), "last")
    return out.select("conv_id", "turn", F.md5("last").alias("last_user"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR b <> event_type""")
def consecutive_dedup(t):
    return ranking.consecutive_dedup(t.events, ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


@query("""WITH n AS (SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS x FROM orders)
SELECT n.o_orderkey, coalesce(x, -1) AS target, o.o_orderpriority AS target_name, CASE WHEN o.o_orderkey IS NULL THEN 'not_found' ELSE 'same_ctdt' END AS resolution FROM n LEFT JOIN orders o ON o.o_orderkey = x AND o.o_custkey = n.o_custkey""")
def backfill_self(t):
    from pyspark.sql import Window

    nxt = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rel = t.orders.select("o_custkey", "o_orderkey", F.coalesce(nxt, F.lit(-1)).alias("target"))
    names = t.orders.select("o_custkey", F.col("o_orderkey").alias("ma_hoc_phan"), F.col("o_orderpriority").alias("ten_hoc_phan"), F.col("o_orderdate").alias("at"))
    return reshape.backfill(rel, names, ["o_custkey"]).select("o_orderkey", "target", "target_name", "resolution")


ZIP = f"WITH {LINES}, r AS (SELECT doc_id, line_no, line FROM lines WHERE line_no % 2 = 0), e AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS pos, line FROM r)"


def halves_of(t):
    ls = F.split("text", "\n")
    a = t.documents.select("doc_id", ls.alias("a"))
    return a, t.documents.select("doc_id", F.filter(ls, lambda x, i: i % 2 == 0).alias("b"))


@query(f"{ZIP} SELECT l.doc_id, l.line_no AS pos, md5(l.line) AS vi, md5(e.line) AS en FROM lines l JOIN e ON e.doc_id = l.doc_id AND e.pos = l.line_no")
def positional_zip_inner(t):
    a, b = halves_of(t)
    return reshape.zip_inner(a, b, "doc_id", "a", "b").select("doc_id", "pos", F.md5("vi").alias("vi"), F.md5("en").alias("en"))


@query(f"{ZIP} SELECT l.doc_id, l.line_no AS pos, md5(l.line) AS vi, md5(e.line) AS en FROM lines l LEFT JOIN e ON e.doc_id = l.doc_id AND e.pos = l.line_no")
def positional_zip_left(t):
    a, b = halves_of(t)
    return reshape.zip_left(a, b, "doc_id", "a", "b").select("doc_id", "pos", F.md5("vi").alias("vi"), F.md5("en").alias("en"))


STRINGS = "s AS (SELECT DISTINCT trim(x) AS vi FROM (SELECT p_name AS x FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_brand || ' ' || p_size FROM part) WHERE trim(x) <> '')"


@query(f"""WITH {STRINGS}, m AS (SELECT vi FROM s WHERE vi NOT IN (SELECT p_type FROM part)) SELECT vi, ((row_number() OVER (ORDER BY vi) - 1) // 200)::BIGINT AS chunk FROM m""")
def dict_missing_chunks(t):
    p = t.part.select("p_name", "p_type", F.array(F.concat_ws(" ", "p_brand", "p_size")).alias("more"))
    strings = reshape.unique_strings(p, ["more"], ["p_name", "p_type"])
    return reshape.missing_strings(strings, t.part.select(F.col("p_type").alias("vi")).distinct(), 200).select("vi", "chunk")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' END AS status_en, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN lower(o_orderpriority) END AS priority_en FROM orders""")
def dict_apply(t):
    d = t.orders.select("o_orderpriority").distinct().where("o_orderpriority in ('1-URGENT', '2-HIGH')").select(F.col("o_orderpriority").alias("vi"), F.lower("o_orderpriority").alias("en"))
    out = reshape.apply_dictionary(t.orders.select("o_orderkey", "o_orderstatus", F.concat(F.lit(" "), "o_orderpriority").alias("priority")), d, ["priority"])
    return out.select("o_orderkey", tx.map_values("o_orderstatus", {"F": "Finished", "O": "Open"}).alias("status_en"), "priority_en")


@query("""SELECT conv_id, md5(array_to_string(list(text ORDER BY turn) FILTER (role = 'user'), '|')) AS users, md5(array_to_string(list(text ORDER BY turn) FILTER (role = 'assistant'), '|')) AS assistants, count(*) FILTER (role = 'system') AS n_system FROM conversations GROUP BY conv_id""")
def assemble_entities(t):
    a = reshape.assemble(t.conversations, "conv_id", "role", "text", "turn", ["user", "assistant", "system"])
    empty = lambda c: F.when(F.size(c) > 0, F.md5(F.array_join(c, "|")))
    return a.select("conv_id", empty("user").alias("users"), empty("assistant").alias("assistants"), F.size("system").cast("long").alias("n_system"))


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN 'translated' ELSE 'normalized' END AS stream, source FROM documents WHERE lang <> 'xx'""")
def overlay_sources(t):
    base = t.documents.select("doc_id", F.lit("normalized").alias("stream"), "source")
    over = t.documents.where("lang = 'en'").select("doc_id", F.lit("translated").alias("stream"), "source")
    return reshape.overlay(base, over, ["doc_id"])


RESOLVE = """r AS (SELECT o_orderkey, o_custkey AS k, coalesce(c.c_name, s.s_name) AS name, CASE WHEN c.c_name IS NOT NULL THEN 'resolved' WHEN s.s_name IS NOT NULL THEN 'fallback' ELSE 'unresolved' END AS status
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON c_custkey = o_custkey LEFT JOIN supplier s ON s_suppkey = o_custkey)"""


def resolved_of(t):
    first = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    second = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return reshape.resolve(t.orders.select("o_orderkey", F.col("o_custkey").alias("k")), first, second, "k", "name")


@query(f"WITH {RESOLVE} SELECT k % 10 AS bucket, count_if(status = 'resolved')::BIGINT AS n_resolved, count_if(status = 'fallback')::BIGINT AS n_fallback, count_if(status = 'unresolved')::BIGINT AS n_unresolved, count(*) AS n_all FROM r GROUP BY ALL")
def resolve_fallback(t):
    return reshape.resolution_summary(resolved_of(t).withColumn("bucket", F.col("k") % 10), ["bucket"])


@query(f"""WITH {RESOLVE}, e AS (SELECT o_orderkey, status, CASE WHEN status = 'fallback' THEN k || '_BS' ELSE k::VARCHAR END AS export_code, name FROM r),
x AS (SELECT export_code, count(DISTINCT name) > 1 AS conflict FROM e WHERE status <> 'unresolved' GROUP BY ALL)
SELECT o_orderkey, e.export_code, status, coalesce(conflict, false) AS conflict FROM e LEFT JOIN x USING (export_code)""")
def contract_codes(t):
    r = resolved_of(t).select("o_orderkey", F.col("k").cast("string").alias("ma_hoc_phan"), "status", F.col("name").alias("payload"))
    return reshape.export_codes(r).select("o_orderkey", "export_code", "status", "conflict")


@query("""SELECT o_custkey AS ma_ctdt, l_partkey::VARCHAR AS ma_hoc_phan, 'g' || o_orderkey AS nhom_id, CASE WHEN o_custkey % 2 = 0 THEN 'flat' ELSE 'nested' END AS loai_nhom FROM (SELECT DISTINCT o_custkey, o_orderkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""")
def membership_flatten(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "o_orderkey", F.col("l_partkey").cast("string").alias("ma_hoc_phan")).distinct()
    g = j.groupBy("o_custkey", "o_orderkey").agg(F.collect_list(F.struct("ma_hoc_phan")).alias("hoc_phan"))
    p = g.groupBy(F.col("o_custkey").alias("ma_ctdt")).agg(F.collect_list(F.struct(F.concat(F.lit("g"), "o_orderkey").alias("nhom_id"), F.lit("nested").alias("loai_nhom"), "hoc_phan")).alias("nhom_hoc_phan"))
    flat = F.flatten(F.transform("nhom_hoc_phan", lambda x: F.transform(x["hoc_phan"], lambda c: F.struct(c["ma_hoc_phan"].alias("ma_hoc_phan"), x["nhom_id"].alias("nhom_id"), F.lit("flat").alias("loai_nhom")))))
    return reshape.memberships(p.withColumn("hoc_phan_flat", F.when(F.col("ma_ctdt") % 2 == 0, flat))).select("ma_ctdt", "ma_hoc_phan", "nhom_id", "loai_nhom")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'file_code_mismatch' WHEN o_orderkey % 11 = 0 THEN 'source_code_mismatch' WHEN o_orderkey % 10000 < 1000 THEN 'bad_code_format' END AS reason FROM orders""")
def id_reject(t):
    code = F.concat(F.lit("IT"), (F.col("o_orderkey") % 10000).cast("string"))
    o = t.orders.withColumn("code", code)
    return o.select("o_orderkey", reshape.id_reject(F.when(F.col("o_orderkey") % 13 == 0, "XX0000").otherwise(F.col("code")), F.col("code"), F.when(F.col("o_orderkey") % 11 == 0, "YY1111")).alias("reason"))


@query(f"""WITH {LINES}, d AS (SELECT doc_id, count(DISTINCT lower(trim(line))) AS n_titles, count(*) AS n_all FROM lines GROUP BY doc_id)
SELECT doc_id || ':' || k AS entity_id, k AS entity_type, CASE k WHEN 'hoc_phan' THEN 1 WHEN 'bai_hoc' THEN n_titles ELSE n_all END AS n FROM d, (VALUES ('hoc_phan'), ('bai_hoc'), ('clo')) AS x(k)""")
def normalize_entities(t):
    ls = F.split("text", "\n")
    r = t.documents.select(F.col("doc_id").cast("string").alias("code"), F.col("source").alias("source_file"), F.lit(None).cast("string").alias("content_hash"), F.struct("lang", "source").alias("course"), F.transform(ls, lambda x: F.struct(x.alias("title"))).alias("lessons"), F.transform(ls, lambda x: F.struct(x.alias("text"))).alias("outcomes"), F.array().cast("array<struct<text:string>>").alias("objectives"))
    return reshape.entities(r).select("entity_id", "entity_type", F.col("n").cast("long").alias("n"))


@query("""SELECT doc_id, source, 'old' AS version FROM documents WHERE source NOT IN ('src1', 'src2') UNION ALL SELECT doc_id, source, 'new' FROM documents WHERE source IN ('src1', 'src2') AND lang = 'en'""")
def replace_by_source(t):
    old = t.documents.select("doc_id", "source", F.lit("old").alias("version"))
    new = t.documents.where("source in ('src1', 'src2') and lang = 'en'").select("doc_id", "source", F.lit("new").alias("version"))
    return reshape.replace_source(old, new, "source").select("doc_id", "source", "version")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) ELSE p_name END AS filled, n_name AS nation, CASE WHEN p_partkey % 3 = 0 THEN 'generated' ELSE 'kept' END AS how FROM part LEFT JOIN nation ON n_nationkey = p_size""")
def translate_entities(t):
    p = t.part.withColumn("name", F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.col("p_name")))
    d = t.nation.select(F.col("n_nationkey").cast("string").alias("vi"), F.col("n_name").alias("en"))
    out = reshape.apply_dictionary(p.withColumn("size", F.col("p_size").cast("string")), d, ["size"])
    how = F.when(F.trim("name") == "", "generated").otherwise("kept")
    return out.select("p_partkey", reshape.fill_if_empty(F.col("name"), F.lower("p_type")).alias("filled"), F.col("size_en").alias("nation"), how.alias("how"))


@query("""SELECT a.p_partkey, CASE WHEN b.p_type IS NULL THEN 'generate' ELSE 'history' END AS branch, b.k AS source_key FROM part a LEFT JOIN (SELECT p_type, p_brand, max(p_partkey) AS k FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL) b ON a.p_type = b.p_type AND a.p_brand = b.p_brand""")
def history_match(t):
    past = t.part.where("p_partkey % 2 = 0").groupBy("p_type", "p_brand").agg(F.max("p_partkey").alias("source_key"))
    out = t.part.select("p_partkey", "p_type", "p_brand").join(past, ["p_type", "p_brand"], "left")
    return out.select("p_partkey", F.when(F.col("source_key").isNull(), "generate").otherwise("history").alias("branch"), "source_key")


MARKDOWN = "## I.1. Orders — 3.0 tín chỉ\n### {kind}\n| STT | Code | Name | Credits | Term | A | B |\n|---|---|---|---|---|---|---|\n"


@query("""SELECT o_custkey::VARCHAR AS ma_ctdt, o_orderkey::VARCHAR AS ma_hoc_phan, o_orderpriority AS ten_hoc_phan, CASE WHEN o_custkey % 2 = 0 THEN 'BAT_BUOC' ELSE 'TU_CHON' END AS loai_nhom, 3.0::DOUBLE AS credits_required,
CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 5)::DOUBLE END AS so_tin_chi, (o_orderkey % 8)::INT AS hoc_ky, o_custkey || ',' || o_orderkey AS tien_quyet FROM orders""")
def markdown_table_parse(t):
    k = F.col("o_orderkey")
    row = F.concat(F.lit("| 1 | "), k, F.lit(" | "), "o_orderpriority", F.lit(" | "), F.when(k % 4 != 0, (k % 5).cast("string")).otherwise("n/a"), F.lit(" | "), k % 8, F.lit(" | "), "o_custkey", F.lit(", "), k, F.lit(" |  |"))
    rows = t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    head = F.when(F.col("o_custkey") % 2 == 0, MARKDOWN.format(kind="Phần bắt buộc")).otherwise(MARKDOWN.format(kind="Phần tự chọn"))
    files = rows.select(F.concat(F.lit("x/CTDT_"), "o_custkey", F.lit(".md")).alias("path"), F.concat(F.lit("# Title\n"), head, "rows", F.lit("\n\n| stray | row |")).alias("content"))
    out = readers.programme_rows(files)
    return out.select("ma_ctdt", "ma_hoc_phan", "ten_hoc_phan", "loai_nhom", "credits_required", "so_tin_chi", "hoc_ky", F.array_join("tien_quyet", ",").alias("tien_quyet"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS title, upper(nullif(regexp_extract(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\b([A-Za-z]{2}\d{4})\b', 1), '')) AS code FROM pages""")
def html_label_table(t):
    return t.pages.select("page_id", readers.course_metadata(F.col("html"), F.lit("page")).alias("m")).select("page_id", "m.title", "m.code")


@query("SELECT page_id, lower(regexp_extract(url, '([^/]+)/[^/]*$', 1)) AS stream FROM pages")
def source_stream(t):
    return t.pages.select("page_id", readers.stream_label(F.col("url")).alias("stream"))


@query("SELECT p_brand, count(*) AS n_rows, count(DISTINCT p_type) AS n_keys, count(*) = count(DISTINCT p_type) AS is_unique FROM part GROUP BY p_brand")
def id_summary(t):
    return reshape.id_summary(t.part, ["p_brand"], "p_type")


# --- graph ---
@query("""SELECT 'region' AS label, r_regionkey::VARCHAR AS node_key, r_name AS name FROM region UNION ALL SELECT 'nation', n_nationkey::VARCHAR, n_name FROM nation UNION ALL SELECT 'customer', c_custkey::VARCHAR, c_name FROM customer UNION ALL SELECT 'part', p_brand, min(p_brand) FROM part GROUP BY p_brand""")
def graph_nodes(t):
    parts = [
        graph.nodes("region", t.region.select("r_regionkey", F.col("r_name").alias("name")), "r_regionkey"), graph.nodes("nation", t.nation.select("n_nationkey", F.col("n_name").alias("name")), "n_nationkey"),
        graph.nodes("customer", t.customer.select("c_custkey", F.col("c_name").alias("name")), "c_custkey"), graph.nodes("part", t.part.select("p_brand", F.col("p_brand").alias("name")), "p_brand"),
    ]
    return graph.union(parts).select("label", "node_key", F.col("properties")["name"].alias("name"))


EDGES = """e AS (SELECT DISTINCT n_nationkey::VARCHAR AS source_id, n_regionkey::VARCHAR AS target_id, 'IN_REGION' AS type, NULL AS status FROM nation UNION ALL SELECT c_custkey::VARCHAR, c_nationkey::VARCHAR, 'IN_NATION', NULL FROM customer
UNION ALL SELECT o_custkey::VARCHAR, l_partkey::VARCHAR, 'BOUGHT', min(o_orderstatus) FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"""


def edges_of(t):
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    return graph.union([
        graph.edges("IN_REGION", t.nation, F.col("n_nationkey"), F.col("n_regionkey")), graph.edges("IN_NATION", t.customer, F.col("c_custkey"), F.col("c_nationkey")),
        graph.edges("BOUGHT", j, F.col("o_custkey"), F.col("l_partkey"), {"status": F.col("o_orderstatus")}),
    ])


@query(f"WITH {EDGES} SELECT * FROM e")
def graph_edges(t):
    return edges_of(t).select("source_id", "target_id", "type", F.col("properties")["status"].alias("status"))


@query("SELECT name, kind FROM (VALUES ('k', 'props'), ('event_type', 'props'), ('value', 'props')) AS x(name, kind)")
def edge_props_columns(t):
    props = F.map_concat(F.from_json("props", "map<string,string>"), F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("event_type"), F.col("event_type"))).otherwise(F.create_map(F.lit("value"), F.col("value").cast("string"))))
    names = graph.edge_columns(t.events.select(props.alias("properties")))
    return t.spark.createDataFrame([(n, "props") for n in names], "name string, kind string")


@query(r"""SELECT c_custkey, 'MATCH (c:Course {course_id: ''' || c_custkey || '''})' || chr(10) || 'MATCH (s:Skill {uri: ''' || c_nationkey || '''})' || chr(10) || 'MERGE (c)-[r:SUPPORTS_SKILL]->(s)' || chr(10) || 'SET r.support_concept = ''it\''s ' || c_mktsegment || ''',' || chr(10) || '    r.evidence_text = ''' || c_name || ''',' || chr(10) || '    r.final_score = ' || printf('%.4f', c_custkey / 8) || ',' || chr(10) || '    r.review_status = ''accepted'',' || chr(10) || '    r.method = ''m'',' || chr(10) || '    r.created_at = timestamp();' AS statement FROM customer""")
def cypher_lines(t):
    c = t.customer.select("c_custkey", F.col("c_custkey").alias("course_code"), F.col("c_nationkey").alias("uri"), F.concat(F.lit("it's "), "c_mktsegment").alias("concept"), F.col("c_name").alias("evidence_text"), (F.col("c_custkey") / 8).alias("score"), F.lit("accepted").alias("status"), F.lit("m").alias("method"))
    return c.select("c_custkey", graph.cypher(c).alias("statement"))


LINKS = "have AS (SELECT DISTINCT o_custkey AS code FROM orders WHERE o_orderstatus <> 'P'), gone AS (SELECT DISTINCT c_nationkey::VARCHAR AS ma_ctdt, c_custkey::VARCHAR AS code FROM customer WHERE c_custkey NOT IN (SELECT code FROM have))"


def links_of(t):
    members = t.customer.select(F.col("c_nationkey").cast("string").alias("ma_ctdt"), F.concat(F.col("c_custkey"), F.lit("_BS")).alias("code"))
    return graph.missing_links(members, t.orders.where("o_orderstatus <> 'P'").select(F.col("o_custkey").cast("string").alias("code")))


@query(f"WITH {LINKS} SELECT ma_ctdt, code FROM gone")
def missing_links(t):
    return links_of(t)[1]


@query(f"WITH {LINKS} SELECT DISTINCT code, 'fallback' AS origin FROM gone")
def fallback_nodes(t):
    return links_of(t)[0].withColumn("origin", F.lit("fallback"))


@query(f"""WITH {LINKS}, m AS (SELECT n_nationkey::VARCHAR AS ma_ctdt, code FROM nation LEFT JOIN gone ON ma_ctdt = n_nationkey::VARCHAR)
SELECT ma_ctdt, '# ' || ma_ctdt || chr(10) || 'Missing: ' || count(code) || chr(10) || chr(10) || CASE WHEN count(code) = 0 THEN 'No missing courses.' ELSE '| Code | Name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || code || ' | x' || code || ' |', chr(10) ORDER BY '| ' || code || ' | x' || code || ' |') FILTER (code IS NOT NULL) END AS report FROM m GROUP BY ma_ctdt""")
def missing_report(t):
    gone = links_of(t)[1].withColumn("name", F.concat(F.lit("x"), "code"))
    rows = t.nation.select(F.col("n_nationkey").cast("string").alias("ma_ctdt")).join(gone, "ma_ctdt", "left")
    return reshape.missing_report(rows, "ma_ctdt", "code", "name")


# --- extraction of graphs ---
CONTRACT = """cu AS (SELECT c_custkey AS k, 'C' || c_custkey AS code, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'en ' || c_custkey END AS en, (c_custkey % 4)::DOUBLE AS credits FROM customer),
mem AS (SELECT 'P' || c_nationkey AS p, 'C' || (c_custkey + CASE WHEN c_custkey % 50 = 0 THEN 1000000 ELSE 0 END) AS code, 'P' || c_nationkey || '_G' || (c_custkey % 4) AS g, (c_custkey % 9)::DOUBLE AS credits FROM customer),
od AS (SELECT 'C' || o_custkey AS code, 'C' || o_custkey || '_G' || (o_orderkey % 3) AS goal, 'C' || o_custkey || '_O' || (o_orderkey % 2) AS clo, 'C' || o_custkey || '_L' || (o_orderkey % 3 + 1) AS lesson, o_orderkey % 10 = 0 AS nogoal FROM orders)"""


def contract_of(t):
    code = F.concat(F.lit("C"), "c_custkey", F.when(F.col("c_custkey") % 7 == 0, "_BS").otherwise(""))
    ask = F.when(F.col("c_custkey") % 5 == 0, F.array(F.concat(F.lit("C"), F.col("c_custkey") + 1, F.lit("_BS")))).otherwise(F.array().cast("array<string>"))
    en = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("en "), "c_custkey"))
    courses = t.customer.select(code.alias("code"), F.col("c_name").alias("ten_vi"), en.alias("ten_en"), F.col("c_mktsegment").alias("ten_vi_en"), (F.col("c_custkey") % 4).alias("so_tin_chi_tong"), ask.alias("prerequisites"), F.array().cast("array<string>").alias("previous"))
    own, n = F.concat(F.lit("C"), "o_custkey"), F.col("o_orderkey")
    text = F.col("o_orderstatus").alias("noi_dung")
    goals = t.orders.select(own.alias("code"), F.when(n % 10 == 0, "").otherwise(F.concat(F.lit("G"), n % 3)).alias("ma_muc_tieu"), text)
    outs = t.orders.select(own.alias("code"), F.concat(F.lit("O"), n % 2).alias("ma_clo"), text)
    lessons = t.orders.select(own.alias("code"), (n % 3 + 1).alias("pos"), F.col("o_orderstatus").alias("ten_bai"), F.lit(None).cast("array<string>").alias("dap_ung_cdr"), F.array(F.concat(F.lit("O"), n % 2)).alias("ma_clo"))
    far = F.col("c_custkey") + F.when(F.col("c_custkey") % 50 == 0, 1000000).otherwise(0)
    members = t.customer.select(F.concat(F.lit("P"), "c_nationkey").alias("ma_ctdt"), F.concat(F.lit("C"), far).alias("code"), F.concat(F.lit("G"), F.col("c_custkey") % 4).alias("nhom_id"), F.col("c_mktsegment").alias("loai_nhom"), (F.col("c_custkey") % 9).cast("double").alias("so_tin_chi"))
    return graph.contract(courses, goals, outs, lessons, members)


@query(f"""WITH {CONTRACT} SELECT 'HocPhan' AS type, cu.code AS a, NULL AS b, en || '|' || CASE WHEN cu.credits = 0 THEN coalesce(mem.credits, 0) ELSE cu.credits END AS detail FROM cu LEFT JOIN mem USING (code)
UNION ALL SELECT 'HocPhan', code, NULL, '|' || credits FROM mem WHERE code NOT IN (SELECT code FROM cu) UNION ALL SELECT DISTINCT 'ChuongTrinhDaoTao', p, NULL, NULL FROM mem UNION ALL SELECT DISTINCT 'NhomHocPhan', g, NULL, NULL FROM mem
UNION ALL SELECT DISTINCT 'MucTieuHocPhan', goal, NULL, NULL FROM od WHERE NOT nogoal UNION ALL SELECT DISTINCT 'CLO', clo, NULL, NULL FROM od UNION ALL SELECT DISTINCT 'Bai', lesson, NULL, NULL FROM od
UNION ALL SELECT DISTINCT 'HAS_COURSE', p, code, NULL FROM mem UNION ALL SELECT DISTINCT 'BELONGS_TO', code, g, NULL FROM mem UNION ALL SELECT DISTINCT 'HAS_OBJECTIVE', code, goal, NULL FROM od WHERE NOT nogoal
UNION ALL SELECT DISTINCT 'HAS_CLO', code, clo, NULL FROM od UNION ALL SELECT DISTINCT 'HAS_LESSON', code, lesson, NULL FROM od UNION ALL SELECT DISTINCT 'SUPPORTS_CLO', lesson, clo, NULL FROM od UNION ALL SELECT 'PREREQUISITE', code, 'C' || (k + 1), NULL FROM cu WHERE k % 5 = 0""")
def graph_contract(t):
    nodes, edges = contract_of(t)
    none = F.lit(None).cast("string")
    shown = F.when(F.col("label") == "HocPhan", F.concat_ws("|", F.coalesce(F.col("properties")["ten_en"], F.lit("")), F.col("properties")["so_tin_chi_tong"]))
    return nodes.select(F.col("label").alias("type"), F.col("node_key").alias("a"), none.alias("b"), shown.alias("detail")).unionByName(edges.select("type", F.col("source_id").alias("a"), F.col("target_id").alias("b"), none.alias("detail")))


@query("""SELECT 'KyNangESCO' AS type, p_partkey::VARCHAR AS a, NULL AS b, p_type || ';' || p_brand AS detail FROM part UNION ALL SELECT 'NgheNghiepESCO', c_custkey::VARCHAR, NULL, NULL FROM customer
UNION ALL SELECT 'REQUIRES_SKILL', o_custkey::VARCHAR, l_partkey::VARCHAR, min(CASE WHEN l_returnflag = 'R' THEN 'essential' ELSE 'optional' END) FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""")
def graph_taxonomy(t):
    occ, rel, _ = taxonomy_of(t)
    skills = t.part.select(F.col("p_partkey").cast("string").alias("conceptUri"), "p_name", F.concat_ws("\n", F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("altLabels"))
    nodes, edges = graph.taxonomy(skills, occ, rel)
    return nodes.select(F.col("label").alias("type"), F.col("node_key").alias("a"), F.lit(None).cast("string").alias("b"), F.col("properties")["altLabels"].alias("detail")).unionByName(
        edges.select("type", F.col("source_id").alias("a"), F.col("target_id").alias("b"), F.col("properties")["importance_type"].alias("detail"))
    )


@query(f"""WITH {linking.ROUTE}, {linking.CANDS}, tg AS (SELECT DISTINCT course_code, lower(mention) AS normalized FROM tm), e AS (SELECT course_code, normalized, uri, round(1 / (2 + min(place)), 6) AS confidence FROM pairs GROUP BY ALL)
SELECT 'TEACHES_' || upper(concept_type) AS type, course_code AS a, uri AS b, NULL AS detail FROM final WHERE decision = 'ACCEPT' UNION ALL SELECT 'HAS_CONCEPT', course_code::VARCHAR, normalized, 'teach' FROM tg
UNION ALL SELECT 'EVIDENCE_FOR', normalized, uri::VARCHAR, min(confidence::VARCHAR) FROM e GROUP BY normalized, uri UNION ALL SELECT DISTINCT 'ConceptTag', normalized, NULL, 'direct_extraction' FROM tg""")
def graph_mapping(t):
    found = routing.route(linking.candidates_of(t)).withColumn("confidence", F.col("final_combined"))
    nodes, edges = graph.mapping(found, records.concept_tags(linking.mentions_of(t)), records.concept_edges(linking.tag_candidates(t)), "teach")
    detail = F.coalesce(F.col("properties")["role"], F.when(F.col("type") == "EVIDENCE_FOR", F.col("properties")["confidence"]))
    return edges.select("type", F.col("source_id").alias("a"), F.col("target_id").alias("b"), detail.alias("detail")).unionByName(
        nodes.select(F.col("label").alias("type"), F.col("node_key").alias("a"), F.lit(None).cast("string").alias("b"), F.col("properties")["loai"].alias("detail"))
    )


@query("""SELECT l_partkey::VARCHAR AS ma_hoc_phan, count(*) AS n, md5(string_agg(p || '|' || g || '|' || k, ';' ORDER BY p, g, k)) AS members FROM (SELECT DISTINCT l_partkey, o_custkey::VARCHAR AS p, o_orderpriority AS g, l_returnflag AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY l_partkey""")
def membership_lists(t):
    j = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").cast("string").alias("ma_hoc_phan"), F.col("o_custkey").cast("string").alias("ma_ctdt"), F.col("o_orderpriority").alias("nhom_id"), F.col("l_returnflag").alias("loai_nhom"))
    shown = F.array_join(F.transform("ctdt_memberships", lambda m: F.concat_ws("|", m["ma_ctdt"], m["nhom_id"], m["loai_nhom"])), ";")
    return reshape.membership_lists(j).select("ma_hoc_phan", F.size("ctdt_memberships").cast("long").alias("n"), F.md5(shown).alias("members"))


# --- taxonomy: nations give codes, customers occupations, orders relations, parts skills ---
def taxonomy_of(t):
    occ = t.customer.select(F.col("c_custkey").cast("string").alias("conceptUri"), F.col("c_nationkey").cast("string").alias("code"), F.col("c_name").alias("label"))
    rel = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").cast("string").alias("occupationUri"), F.col("l_partkey").cast("string").alias("skillUri"), F.when(F.col("l_returnflag") == "R", "essential").otherwise("optional").alias("relationType"), F.col("l_linestatus").alias("skillType"))
    return occ, rel, t.part.select(F.col("p_partkey").cast("string").alias("conceptUri"), "p_name")


TAX = """occ AS (SELECT c_custkey::VARCHAR AS uri, c_nationkey::VARCHAR AS code, c_name FROM customer), rel AS (SELECT o_custkey::VARCHAR AS occ, l_partkey::VARCHAR AS skill, CASE WHEN l_returnflag = 'R' THEN 'essential' ELSE 'optional' END AS kind, l_linestatus AS st FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""


@query(f"""WITH {TAX}, o AS (SELECT * FROM occ WHERE code IN ('3', '13', '24')), r AS (SELECT * FROM rel WHERE occ IN (SELECT uri FROM o))
SELECT 'occupations' AS name, count(*) AS n FROM o UNION ALL SELECT 'relations', count(*) FROM r UNION ALL SELECT 'skills', count(DISTINCT skill) FROM r""")
def taxonomy_semi_chain(t):
    codes = t.nation.where("n_nationkey in (3, 13, 24)").select(F.col("n_nationkey").cast("string").alias("code"))
    named = zip(("occupations", "relations", "skills"), taxonomy.subset(codes, *taxonomy_of(t)), strict=True)
    return graph.union([df.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), "n") for k, df in named])


@query(f"""WITH {TAX}, r AS (SELECT code, min(c_name) AS role FROM occ WHERE uri::INT % 2 = 0 GROUP BY code) SELECT occ.uri AS "conceptUri", occ.code, r.role, occ.code IN (SELECT n_nationkey::VARCHAR FROM nation WHERE n_regionkey = 1) AS matched FROM occ LEFT JOIN r USING (code)""")
def taxonomy_roles(t):
    occ, _, _ = taxonomy_of(t)
    roles = occ.where("cast(conceptUri as int) % 2 = 0").select("code", F.col("label").alias("role"))
    have = t.nation.where("n_regionkey = 1").select(F.col("n_nationkey").cast("string").alias("code"))
    out = taxonomy.matched(taxonomy.with_roles(occ, roles), have)
    return out.select("conceptUri", "code", "role", F.col("matched_in_esco").alias("matched"))


@query(f"WITH {TAX} SELECT occ AS occupation, count_if(kind = 'essential')::BIGINT AS essential, count_if(kind = 'optional')::BIGINT AS optional, count(*) AS total FROM rel GROUP BY occ")
def relation_pivot(t):
    return taxonomy.relation_pivot(taxonomy_of(t)[1].withColumnRenamed("occupationUri", "occupation"), ["occupation"])


@query(f"""WITH {TAX} SELECT occ AS occupation, skill, CASE WHEN bool_or(kind = 'essential') THEN 'essential' ELSE 'optional' END AS relation, min(st) AS skill_type FROM rel GROUP BY ALL""")
def relation_priority(t):
    out = taxonomy.relation_priority(taxonomy_of(t)[1], ["occupationUri", "skillUri"])
    return out.select(F.col("occupationUri").alias("occupation"), F.col("skillUri").alias("skill"), F.col("relationType").alias("relation"), F.col("skillType").alias("skill_type"))


@query("""WITH g AS (SELECT r_regionkey AS k, string_agg(n_nationkey::VARCHAR, ',' ORDER BY n_nationkey) AS code_list, any_value(r_name) AS label FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT code_list, label, 'http://data.europa.eu/esco/occupation/custom-' || md5(code_list) AS uri, (SELECT string_agg(n_name, ' | ' ORDER BY n_nationkey::VARCHAR) FROM nation WHERE n_regionkey = k) AS names,
(SELECT min_by(n_name, n_nationkey::VARCHAR) FROM nation WHERE n_regionkey = k) AS first_name, CASE WHEN (SELECT bool_and(regexp_matches(n_nationkey::VARCHAR, '^(13|25|35)')) FROM nation WHERE n_regionkey = k) THEN 'in_domain' ELSE 'out_of_domain' END AS domain FROM g""")
def merged_occupations(t):
    g = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey", F.col("r_name").alias("label")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda x: x.cast("string")), ",").alias("code_list"))
    occ = t.nation.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("names"), F.col("n_name").alias("first_name"))
    out = taxonomy.merge_occupations(g.select("code_list", "label"), occ, ["first_name"], ["names"])
    return out.select("code_list", "label", F.col("conceptUri").alias("uri"), "names", "first_name", "domain")


@query(f"""WITH {TAX} SELECT skill, CASE WHEN bool_and(regexp_matches(code, '^(13|25|35)')) THEN 'in_domain' ELSE 'out_of_domain' END AS domain, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM rel JOIN occ ON occ = uri GROUP BY skill""")
def skill_domains(t):
    occ, rel, _ = taxonomy_of(t)
    return taxonomy.label_domains(rel, occ).select(F.col("skillUri").alias("skill"), "domain", F.array_join("codes", ",").alias("codes"))


@query(f"""WITH {TAX}, r AS (SELECT skill, kind FROM rel WHERE occ IN (SELECT uri FROM occ WHERE code IN ('1', '2'))) SELECT skill, count_if(kind = 'essential')::BIGINT AS essential, count_if(kind = 'optional')::BIGINT AS optional, count(*) AS total, any_value(p_name) AS label FROM r JOIN part ON p_partkey::VARCHAR = skill GROUP BY skill""")
def taxonomy_subset(t):
    codes = t.nation.where("n_nationkey in (1, 2)").select(F.col("n_nationkey").cast("string").alias("code"))
    _, rel, skills = taxonomy.subset(codes, *taxonomy_of(t))
    p = taxonomy.relation_pivot(rel, ["skillUri"]).join(skills, F.col("skillUri") == F.col("conceptUri"))
    return p.select(F.col("skillUri").alias("skill"), "essential", "optional", "total", F.col("p_name").alias("label"))


@query("""SELECT 'pk:orders' AS "check", (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS violations UNION ALL SELECT 'pk:lineitem', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'fk:lineitem.l_partkey', (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) UNION ALL SELECT 'fk:customer.c_custkey', (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))""")
def fk_pk_checks(t):
    return taxonomy.check_keys({k: getattr(t, k) for k in ("orders", "lineitem", "part", "customer")}, {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]}, [("lineitem", "l_partkey", "part", "p_partkey"), ("customer", "c_custkey", "orders", "o_custkey")])


@query(f"""WITH {LINES}, n AS (SELECT doc_id, count(*) AS n_lessons, avg((trim(line) <> '')::INT) AS r FROM lines GROUP BY doc_id), o AS (SELECT conv_id, count(*) AS n, avg((trim(text) <> '')::INT) AS r FROM conversations GROUP BY conv_id)
SELECT d.doc_id AS code, trim(source) = '' AS no_description, coalesce(o.n, 0) AS n_outcomes, n_lessons, round(coalesce(o.r, 0), 6) AS outcome_ratio, round(n.r, 6) AS lesson_ratio FROM documents d JOIN n USING (doc_id) LEFT JOIN o ON conv_id = d.doc_id""")
def health_report(t):
    h = evidence.health(t.documents.select(F.col("doc_id").alias("code"), F.col("source").alias("description")), t.conversations.select(F.col("conv_id").alias("code"), "text"), lines_of(t).select(F.col("doc_id").alias("code"), F.col("line").alias("text")))
    return h.select("code", "no_description", "n_outcomes", "n_lessons", F.round("outcome_ratio", 6).alias("outcome_ratio"), F.round("lesson_ratio", 6).alias("lesson_ratio"))


# --- incremental ---
@query("""WITH a AS (SELECT doc_id, md5('=' || text) AS h FROM documents WHERE doc_id % 5 <> 0), b AS (SELECT doc_id, md5('=' || CASE WHEN doc_id % 3 = 0 THEN text || 'x' ELSE text END) AS h FROM documents WHERE doc_id % 7 <> 0)
SELECT doc_id, CASE WHEN b.h IS NULL THEN 'new' WHEN a.h IS NULL THEN 'gone' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS status FROM a FULL JOIN b USING (doc_id)""")
def incremental_skip(t):
    now = t.documents.where("doc_id % 5 <> 0").select("doc_id", incremental.stored_hash(F.lit(""), "text").alias("h"))
    old = t.documents.where("doc_id % 7 <> 0").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("text")).select("doc_id", tx.content_hash("text").alias("h"))
    return incremental.changes(now, old, "doc_id", "h")


@query("SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN 'new' ELSE 'old' END AS version FROM documents")
def rebuild_changed(t):
    now = t.documents.select("doc_id", "source", F.md5("text").alias("digest"))
    before = now.where("doc_id % 5 <> 0").withColumn("digest", F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.col("digest")))
    gone = now.where("doc_id % 11 = 0").withColumn("doc_id", F.col("doc_id") + 1_000_000_000)
    before = before.unionByName(gone)
    return incremental.rebuild(now, before, before.select("doc_id", "source", F.lit("old").alias("version")), "doc_id", "digest", lambda rows: rows.withColumn("version", F.lit("new")))


@query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 4 <> 0 THEN p_type WHEN p_partkey % 8 = 0 THEN lower(p_brand) ELSE '' END AS p_type FROM part")
def impute_missing(t):
    from taxoloom import providers

    rows = t.part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_type")).alias("p_type"))
    fenced = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.lower("p_brand").alias("p_type"), F.lit("never used").alias("p_name"))), F.lit("\n```"))
    answers = providers.TableAnswers(t.part.where("p_partkey % 8 = 0").select(F.md5(F.col("p_partkey").cast("string")).alias("cache_key"), fenced.alias("answer")))
    return reshape.impute(rows, ["p_name", "p_type"], F.col("p_name"), lambda df: answers.ask(df.withColumn("cache_key", F.md5(F.col("p_partkey").cast("string")))))


@query("SELECT item_id, md5('llm_v2_' || item_id) AS cache_key FROM benchmark WHERE item_id % 3 <> 0")
def cache_misses(t):
    cache = t.benchmark.where("item_id % 3 = 0").select(tx.cache_key(F.col("item_id").cast("string"), "v2").alias("cache_key"))
    return incremental.cache_misses(t.benchmark.select("item_id", F.col("item_id").cast("string").alias("evidence_id")), cache, version="v2").select("item_id", "cache_key")


# --- counts, order, sample ---
@query("SELECT o_orderpriority AS course_code, count_if(l_returnflag = 'R')::BIGINT AS n_teaches, count_if(l_returnflag = 'A')::BIGINT AS n_supports, count(*) AS n_all FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def relation_counts(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("o_orderpriority").alias("course_code")).agg(F.count_if(F.col("l_returnflag") == "R").alias("n_teaches"), F.count_if(F.col("l_returnflag") == "A").alias("n_supports"), F.count("*").alias("n_all"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def global_sort_limit(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("SELECT p_partkey, p_name FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 5")
def seeded_sample(t):
    return ranking.sample_rows(t.part.select("p_partkey", "p_name"), 5, "p_partkey")


@query("""SELECT o_orderpriority AS course_code, count(*) AS n_records, count(*) FILTER (NOT contains(lower(p_type), 'standard')) AS n_skill, count(*) FILTER (contains(lower(p_type), 'standard')) AS n_knowledge FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def record_summary(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return records.summary(j.select(F.col("o_orderpriority").alias("course_code"), F.when(tx.contains_any("p_type", ("standard",)), "knowledge").otherwise("skill").alias("concept_type")), ["course_code"])


@query("""SELECT conv_id, (turn // 3)::BIGINT AS batch, count(*) AS n, md5(to_json(list(text ORDER BY turn))) AS items FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, text FROM conversations) GROUP BY ALL""")
def prompt_batches(t):
    from taxoloom import providers

    rows = providers.prompt_batches(t.conversations, "conv_id", "turn", "text", 3)
    return rows.select("conv_id", "batch", F.json_array_length("items").cast("long").alias("n"), F.md5("items").alias("items"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{'NODE'}', {len(p)}::BIGINT)" for n, p in graph.NODES.items()) + ", " + ", ".join(f"('{n}', 'RELATIONSHIP', {len(p)}::BIGINT)" for n, (_, _, p) in graph.EDGES.items()) + ") AS x(name, kind, n_properties)")
def graph_schema(t):
    s = graph.schema_table(t.spark)
    return s.select("name", "kind", F.size(tx.split_list("properties")).cast("long").alias("n_properties"))


@query("SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'Required' ELSE 'Elective' END AS kind_en, CASE p_partkey % 3 WHEN 0 THEN 'Prerequisite' WHEN 1 THEN 'Prior Study' END AS relation_en FROM part")
def enum_translate(t):
    k = F.col("p_partkey")
    p = t.part.select("p_partkey", F.when(k % 2 == 0, "BAT_BUOC").otherwise("TU_CHON").alias("kind"), F.when(k % 3 == 0, "TIEN_QUYET").when(k % 3 == 1, "HOC_TRUOC").otherwise("X").alias("relation"))
    return reshape.translate_enums(p, "kind", "relation").select("p_partkey", "kind_en", "relation_en")


