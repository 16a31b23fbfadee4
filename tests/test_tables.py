"""Reshaping, graph, taxonomy, incremental operators, files and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from taxoloom.operators import evidence, graph, incremental, reshape, taxonomy
from taxoloom.sources import readers, sinks
from taxoloom.streaming import incremental as stream


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


# --- reshaping ---
def test_flatten_and_backfill(spark):
    js = json.dumps({"ma_ctdt": "P", "nhom_hoc_phan": [
        {"ten_nhom": "I.1. A — 3 tín chỉ", "loai_nhom": "BAT_BUOC", "hoc_phan": [{"ma_hoc_phan": "X", "ten_hoc_phan": "old", "so_tin_chi_tong": 1, "quan_he": [{"loai": "TIEN_QUYET", "ma_hoc_phan": "Y"}, {"loai": "HOC_TRUOC", "ma_hoc_phan": "Z"}]}]},
        {"ten_nhom": "I.1. B — 4.5 tín chỉ", "loai_nhom": "TU_CHON", "hoc_phan": [{"ma_hoc_phan": "Y", "ten_hoc_phan": "first", "quan_he": []}, {"ma_hoc_phan": "Y", "ten_hoc_phan": "last", "quan_he": []}]},
        {"ten_nhom": "II.2. C — 1 tín chỉ - Nhóm a", "loai_nhom": "TU_CHON", "hoc_phan": []},
    ]})
    from taxoloom import schemas

    p = spark.createDataFrame([(js,)], "j string").select(F.from_json("j", schemas.PROGRAMME).alias("p")).select("p.*")
    f = reshape.flatten(p)
    assert rows(f["groups"], "nhom_id") == [("II_2_A",), ("I_1_A",), ("I_1_B",)]
    assert rows(f["sections"], "section", "base", "credits", "n_groups") == [("I.1", "A", 3.0, 2), ("II.2", "C", 1.0, 1)]
    assert rows(f["relations"], "target", "resolution") == [("Y", "same_ctdt"), ("Z", "not_found")]
    assert f["relations"].where("target = 'Y'").first().target_name == "last"


def test_entities_keep_first_titles(spark):
    r = spark.createDataFrame([("c", "f", None, ("x",), [("A", 1), ("a ", 2), ("B", 3)], [], [("m",)])], "code string, source_file string, content_hash string, course struct<n:string>, lessons array<struct<title:string,k:int>>, outcomes array<struct<t:string>>, objectives array<struct<t:string>>")
    got = {x.entity_type: x for x in reshape.entities(r).collect()}
    assert set(got) == {"hoc_phan", "bai_hoc", "muc_tieu"} and [y["k"] for y in json.loads(got["bai_hoc"].data)] == [1, 3]
    assert got["hoc_phan"].entity_id == "c:hoc_phan" and got["hoc_phan"].source_hash


@pytest.mark.parametrize("f, d, s, want", [("IT1", "IT2", None, "file_code_mismatch"), ("IT1234", "IT1234", "IT9999", "source_code_mismatch"), ("I1", "I1", None, "bad_code_format"), ("IT1234", "IT1234", "IT1234", None), (None, None, None, "bad_code_format")])
def test_id_reject(spark, f, d, s, want):
    assert spark.createDataFrame([(f, d, s)], "f string, d string, s string").select(reshape.id_reject(F.col("f"), F.col("d"), F.col("s"))).first()[0] == want


def test_zips_overlay_resolve(spark):
    a = spark.createDataFrame([(1, ["x", "y"]), (2, ["z"])], "k int, a array<string>")
    b = spark.createDataFrame([(1, ["X"])], "k int, b array<string>")
    assert rows(reshape.zip_inner(a, b, "k", "a", "b"), "k", "vi", "en") == [(1, "x", "X")]
    assert reshape.zip_left(a, b, "k", "a", "b").count() == 3
    base, over = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "b")], [(2, "B"), (3, "C")]))
    assert rows(reshape.overlay(base, over, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    w = spark.createDataFrame([(1,), (3,), (9,)], "k int")
    got = reshape.resolve(w, base, over, "k", "v")
    assert rows(got, "k", "status") == [(1, "resolved"), (3, "fallback"), (9, "unresolved")]
    codes = reshape.export_codes(got.select(F.col("k").cast("string").alias("ma_hoc_phan"), "status", F.col("v").alias("payload")))
    assert rows(codes, "export_code", "conflict") == [("1", False), ("3_BS", False), ("9", False)]
    assert rows(reshape.replace_source(base, spark.createDataFrame([(2, "n1"), (2, "n2")], "k int, v string"), "k"), "k", "v") == [(1, "a"), (2, "n1"), (2, "n2")]


def test_translation(spark):
    df = spark.createDataFrame([(" a ", ["b", ""], None), ("c", None, "a")], "x string, ys array<string>, z string")
    strings = reshape.unique_strings(df, ["ys"], ["x", "z"])
    assert rows(strings, "vi") == [("a",), ("b",), ("c",)]
    d = spark.createDataFrame([("a", "A"), ("a", "A")], "vi string, en string")
    assert rows(reshape.missing_strings(strings, d, 1), "vi", "chunk") == [("b", 0), ("c", 1)]
    assert [r.x_en for r in reshape.apply_dictionary(df, d, ["x"]).orderBy("x").collect()] == ["A", None]
    assert spark.createDataFrame([(" ", "n")], "a string, b string").select(reshape.fill_if_empty(F.col("a"), F.col("b"))).first()[0] == "n"
    m = spark.createDataFrame([("P", "c", "n")], "p string, c string, n string").unionByName(spark.createDataFrame([("Q", None, None)], "p string, c string, n string"))
    assert {r.p: r.report.split("\n")[-1] for r in reshape.missing_report(m, "p", "c", "n").collect()} == {"P": "| c | n |", "Q": "No missing courses."}


def test_validation(spark):
    schema = "code string, declared string, ten_vi string, mo_ta_en string, hashes array<string>, outcomes array<struct<id:string,text:string>>, objectives array<struct<id:string,kind:string,text:string>>, lessons array<struct<title:string>>"
    data = [
        ("a", "a", "Mạng", "x", ["h", "h", None], [("1", "t")], [], [("l",)]),
        ("b", "x", "Triết học", "", ["h", "g"], [("1", " ")], [("1", "ODD", "")], [(None,)]),
        ("c", "c", None, None, None, None, None, None),
    ]
    got = {r.code: r for r in evidence.validate(spark.createDataFrame(data, schema)).collect()}
    assert got["a"].is_valid and got["a"].warnings == []
    assert got["b"].errors == ["code_mismatch", "no_english_text", "ignored_course"] and len(got["b"].warnings) == 4
    assert got["c"].errors == ["no_english_text"]


# --- graph ---
def test_contract_graph(spark):
    e = lambda d, s: spark.createDataFrame(d, s)
    nodes, edges = graph.contract(
        e([("A_BS", "bs", "", "en2", ["B_BS"], []), ("A", "plain", "en", None, [], [])], "code string, ten_vi string, ten_en string, ten_vi_en string, prerequisites array<string>, previous array<string>"),
        e([("A", "G1", "t"), ("A", "", "t")], "code string, ma_muc_tieu string, noi_dung string"),
        e([("A", "L1", "t")], "code string, ma_clo string, noi_dung string"),
        e([("A", 1, "t", None, ["L1"])], "code string, pos int, ten_bai string, dap_ung_cdr array<string>, ma_clo array<string>"),
        e([("P", "A_BS", "n", "k"), ("P", "C", "n", "k")], "ma_ctdt string, code string, nhom_id string, loai_nhom string"),
    )
    assert rows(nodes.where("label = 'HocPhan'"), "node_key") == [("A",), ("C",)]
    a = nodes.where("node_key = 'A'").first().properties
    assert a == {"ten_vi": "plain", "ten_en": "en"} or a["ten_en"] == "en"
    assert ("A_L1", "A_L1", "SUPPORTS_CLO") in rows(edges, "source_id", "target_id", "type") and ("A", "B", "PREREQUISITE") in rows(edges, "source_id", "target_id", "type")
    assert graph.edge_columns(edges) == ["is_explicitly_empty", "source"]
    assert edges.where("type = 'BELONGS_TO'").count() == 2


def test_mapping_graph_filters_accepted(spark):
    rec = spark.createDataFrame([("c", "u1", "ACCEPT", "skill", 0.5), ("c", "u2", "REJECT", "skill", 0.5)], "course_code string, uri string, decision string, concept_type string, priority double")
    tags = spark.createDataFrame([("c", "sql", "SQL")], "course_code string, normalized string, text string")
    ev = spark.createDataFrame([("sql", "u2", 0.5)], "normalized string, uri string, confidence double")
    _, edges = graph.mapping(rec, tags, ev, "teach")
    assert rows(edges, "target_id", "type") == [("sql", "HAS_CONCEPT"), ("u1", "TEACHES_SKILL"), ("u2", "EVIDENCE_FOR")]
    assert graph.schema_table(spark).count() == 24


def test_taxonomy(spark):
    occ = spark.createDataFrame([("o1", "1310"), ("o2", "25"), ("o3", "9")], "conceptUri string, code string")
    rel = spark.createDataFrame([("o1", "s1", "optional", "k"), ("o2", "s1", "essential", "a"), ("o3", "s2", "optional", "k")], "occupationUri string, skillUri string, relationType string, skillType string")
    skills = spark.createDataFrame([("s1",), ("s2",)], "conceptUri string")
    parts = taxonomy.subset(spark.createDataFrame([("1310",), ("25",), ("25",)], "code string"), occ, rel, skills)
    assert [p.count() for p in parts] == [2, 2, 1]
    assert rows(taxonomy.relation_pivot(rel, ["skillUri"]), "skillUri", "essential", "optional", "total") == [("s1", 1, 1, 2), ("s2", 0, 1, 1)]
    assert rows(taxonomy.relation_priority(rel, ["skillUri"]), "skillUri", "relationType", "skillType") == [("s1", "essential", "a"), ("s2", "optional", "k")]
    assert rows(taxonomy.label_domains(rel, occ), "skillUri", "domain") == [("s1", "in_domain"), ("s2", "out_of_domain")]
    g = spark.createDataFrame([("25, 9", "x")], "code_list string, label string")
    wide = occ.withColumn("t", F.concat(F.lit("t"), "code"))
    assert taxonomy.merge_occupations(g, wide, [], ["t"]).first().domain == "out_of_domain"
    assert taxonomy.merge_occupations(g, wide, [], ["t"], legacy=True).first().domain == "in_domain"
    assert taxonomy.merge_occupations(g, wide, [], ["t"]).first().t == "t25 | t9"
    got = taxonomy.check_keys({"occ": occ, "rel": rel}, {"occ": ["code"]}, [("rel", "occupationUri", "occ", "conceptUri")])
    assert {r.violations for r in got.collect()} == {0}
    assert [r.k for r in taxonomy.orphans(rel, "skillUri", skills.limit(0), "conceptUri").orderBy("k").collect()] == ["s1", "s2"]


def test_conflicts_can_be_errors(spark):
    df = spark.createDataFrame([("A", "resolved", "x"), ("A", "resolved", "y"), ("B", "fallback", "x")], "ma_hoc_phan string, status string, payload string")
    assert sorted((r.export_code, r.conflict) for r in reshape.export_codes(df).collect()) == [("A", True), ("A", True), ("B_BS", False)]
    assert reshape.export_codes(df.where("ma_hoc_phan = 'B'"), strict=True).count() == 1
    with pytest.raises(Exception, match="contract code A"):
        reshape.export_codes(df, strict=True).collect()


def test_yaml_profile(tmp_path):
    pytest.importorskip("yaml")
    from taxoloom import config

    path = tmp_path / "p.yaml"
    path.write_text("skill: [0.9, 0.8, 0.7, 0.6]\ndefault_cap: 3\n")
    p = config.load_profile(str(path))
    assert (p.skill, p.default_cap, p.knowledge) == ((0.9, 0.8, 0.7, 0.6), 3, config.CODE_DEFAULTS.knowledge)


def test_scratch_tables_go(spark):
    from taxoloom.sources import scratch

    df = scratch.materialize(spark.range(5), "gone")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 5 and any(p.endswith(path.rsplit("/", 1)[-1]) for p in scratch.WRITTEN)
    scratch.clean(spark)
    assert not scratch.WRITTEN
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_unreadable_files_are_named(spark, tmp_path):
    (tmp_path / "A").mkdir()
    (tmp_path / "A" / "A__clo.json").write_text("{broken")
    (tmp_path / "A" / "A__bai_hoc.json").write_text("[]")
    got = readers.unreadable(spark, str(tmp_path)).collect()
    assert [(r.code, r.kind) for r in got] == [("A", "clo")]


def test_changes(spark):
    a, b = (spark.createDataFrame(x, "k int, h string") for x in ([(1, "a"), (2, "x"), (3, "c")], [(1, "a"), (2, "b"), (4, "d")]))
    assert rows(incremental.changes(a, b, "k", "h"), "k", "status") == [(1, "unchanged"), (2, "changed"), (3, "new"), (4, "gone")]
    assert rows(incremental.to_process(a, b, "k", "h"), "k") == [(2,), (3,)]


# --- files ---
def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_contract_files(spark, tmp_path):
    root = str(tmp_path)
    for code in ("IT1", "IT2", "_X"):
        put(f"{root}/{code}/{code}__hoc_phan.json", json.dumps({"ma_hoc_phan": code, "so_tin_chi_tong": 3}))
        put(f"{root}/{code}/{code}__clo.json", json.dumps([{"ma_cdr_goc": "L1", "pi_so": ["1"]}, {"ma_cdr_goc": "L2"}]))
        put(f"{root}/{code}/{code}__bai_hoc.json", json.dumps({"records": [{"ten_bai": "b"}], "source_hash": "h"}))
        if code != "IT2":
            put(f"{root}/{code}/{code}__muc_tieu.json", "[]")
    put(f"{root}/IT1/IT1__muc_tieu.json", "not json")
    got = readers.contracts(spark, root)
    assert rows(got["clo"], "code", "pos", "ma_cdr_goc") == [("IT1", 1, "L1"), ("IT1", 2, "L2")]
    assert rows(got["bai_hoc"], "code", "source_hash") == [("IT1", "h")]
    assert rows(got["hoc_phan"], "so_tin_chi_tong") == [(3,)] and got["muc_tieu"].count() == 0
    assert rows(got["incomplete"], "code", "missing") == [("IT2", ["muc_tieu"])]
    assert rows(readers.course_codes(spark, root), "code") == [("IT1",), ("IT2",)]
    put(f"{root}/m/hoc_phan/A/A__clo.json", "1")
    put(f"{root}/m/A/A__clo.json", "2")
    put(f"{root}/m/B.json", "3")
    assert rows(readers.merged_courses(spark, f"{root}/m"), "code", "kind", "payload") == [("A", "clo", "1"), ("B", "course", "3")]


def test_csv_files(spark, tmp_path):
    put(f"{tmp_path}/a.csv", 'code, name ,note\n 13 ,"x, ""y""",\nNA,,"two\nlines"\n')
    df = readers.string_csv(spark, f"{tmp_path}/a.csv", ("code", "name", "note"), ("code",))
    assert rows(df, "code", "name", "note") == [("13", 'x, "y"', ""), ("NA", "", "two\nlines")]
    with pytest.raises(ValueError):
        readers.string_csv(spark, f"{tmp_path}/a.csv", ("code",), ("lost",))
    sinks.csv(df.unionByName(df), f"{tmp_path}/out", ["code"], single=True)
    assert rows(readers.string_csv(spark, f"{tmp_path}/out", ("code", "name")), "code", "name") == [("13", 'x, "y"'), ("NA", "")]
    m = sinks.manifest(spark, {"t": f"{tmp_path}/out"}, f"{tmp_path}/manifest")
    assert m["t"]["files"] == 1 and len(m["t"]["sha256"]) == 64


def test_markdown(spark):
    text = "- **Mã ngành:** 748\n## I.1. A — 3 tín chỉ\n### Tự chọn\n| STT | c |\n|---|---|\n| 1 | X | nx | 2.5 | 1 | P, Q | R |\n| 2 | short |\n\n| 3 | Y | ny | 1 | 1 | | |\n## II.1. B\n| STT |\n|--|\n| 1 | Z | nz | ? | ? | | |\n"
    files = spark.createDataFrame([("x/CTDT_9.md", text), ("y/other.md", "| STT |\n|-|\n| 1 | A | a | 1 | 1 | | |")], "path string, content string")
    got = readers.programme_rows(files).orderBy("line_no").collect()
    assert [(r.ma_ctdt, r.ma_hoc_phan, r.ten_nhom, r.loai_nhom, r.so_tin_chi, r.hoc_ky, r.credits_required) for r in got] == [
        ("748", "X", "I.1. A — 3 tín chỉ - Tự chọn", "TU_CHON", 2.5, 1, 3.0),
        ("748", "Z", "II.1. B", "BAT_BUOC", None, None, None),
    ]
    assert got[0].tien_quyet == ["P", "Q"] and got[0].hoc_truoc == ["R"]


HTML = '<table><tr class="k-table-view"><td>Tên</td><td>Mạng</td></tr><tr class="k-table-view"><td>Tên</td><td>Mạng 2</td></tr><tr class="kTableRow"><td>1</td><td>A</td><td>x</td></tr><tr class="kTableRow"><td>2</td><td>A</td><td>x</td></tr><tr class="kTableRow"><td colspan="2">3</td><td>B</td><td>y</td></tr><tr class="kTableRow"><td>4</td><td>B</td><td>y</td></tr></table>'


def test_html_files(spark, tmp_path):
    put(f"{tmp_path}/p.mhtml", "From: x\nMIME-Version: 1.0\nContent-Type: multipart/related; boundary=B\n\n--B\nContent-Type: text/plain\n\nno\n--B\nContent-Type: text/html; charset=utf-8\n\n" + HTML + "\n--B--\n")
    put(f"{tmp_path}/q.mhtml", "Content-Type: text/plain\n\nno page")
    pages = readers.saved_pages(spark, str(tmp_path))
    assert pages.where("html is null").count() == 1
    got = {r.path.rsplit("/", 1)[1]: r for r in readers.label_tables(pages).collect()}
    assert got["p.mhtml"].info == {"Tên": "Mạng 2"} and got["p.mhtml"]["items"] == ["A: x", "B: y"] and got["q.mhtml"].info == {}
    m = spark.createDataFrame([("<title>T\n x</title><td>it6205</td>", "a/b.html"), ("<p>none</p>", "a/CNTT601_x.html")], "h string, p string").select(readers.course_metadata(F.col("h"), F.col("p")).alias("m")).select("m.*")
    assert rows(m, "title", "code") == [("", "CNTT601"), ("T x", "IT6205")]


def test_json_lookups(spark, tmp_path):
    put(f"{tmp_path}/a/l.json", '[{"uri": "u1", "label": "x", "skill_type": "knowledge"}]')
    put(f"{tmp_path}/a/k.json", '{"u2": {"label": "y"}}')
    assert rows(readers.metadata(spark, f"{tmp_path}/a"), "uri", "label") == [("u1", "x"), ("u2", "y")]
    put(f"{tmp_path}/c/k1.json", '{"mentions": [{"text": "sql", "evidence_id": "e"}], "n": 1}')
    put(f"{tmp_path}/c/k2.json", '[{"text": "java"}]')
    assert rows(readers.mentions(spark, f"{tmp_path}/c"), "cache_key", "text") == [("k1", "sql"), ("k2", "java")]
    put(f"{tmp_path}/h/1.json", '{"ten_vi": "n", "v": 1}')
    put(f"{tmp_path}/h/2.json", '{"ten_vi": "n", "v": 2}')
    assert json.loads(readers.history(spark, f"{tmp_path}/h").first().payload)["v"] == 2


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("a", "b", "T", {"x": "1\n2"}), ("a", "c", "T", {"y": "z"})], "source_id string, target_id string, type string, properties map<string,string>")
    sinks.edge_csv(e, f"{tmp_path}/e")
    assert rows(readers.string_csv(spark, f"{tmp_path}/e", ("source_id", "target_id", "x", "y")), "target_id", "x", "y") == [("b", "1 2", ""), ("c", "", "z")]
    n = spark.createDataFrame([("k", ["a;b", "c"], None, True)], "id string, l array<string>, z string, b boolean")
    sinks.node_csv(n, f"{tmp_path}/n")
    assert rows(readers.string_csv(spark, f"{tmp_path}/n", ("id", "l", "z", "b")), "id", "l", "z", "b") == [("k", "a,b;c", "", "true")]
    r = spark.createDataFrame([("c", "u1", "My Skill", "skill"), ("c", "u2", "my-skill", "skill"), ("d", "u3", "x", "knowledge")], "course_code string, uri string, label string, kind string")
    files = sinks.keyed_records(r, "label", "kind")
    assert rows(files, "course_code", "file") == [("c", "skill__my_skill.json"), ("d", "knowledge__x.json")] and '"u2"' in files.where("course_code = 'c'").first().payload
    sinks.nested_json(r, f"{tmp_path}/j", "course_code")
    sinks.per_key(r, "kind", f"{tmp_path}/k")
    sinks.tables({"a": r, "b": r}, f"{tmp_path}/t")
    sinks.append_log(r, f"{tmp_path}/log")
    sinks.append_log(r, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 6 and spark.read.json(f"{tmp_path}/j").where("course_code = 'c'").count() == 2
    assert sorted(x for x in os.listdir(tmp_path / "k") if "=" in x) == ["kind=knowledge", "kind=skill"]
    sinks.text_lines(r, F.concat("course_code", "uri"), f"{tmp_path}/x", ["uri"], by="course_code")
    assert [x.value for x in spark.read.text(f"{tmp_path}/x/course_code=c").collect()] == ["cu1", "cu2"]
    lessons = spark.createDataFrame([("c", 1, "Bài 1: Mạng", "Lesson 1: Nets")], "code string, pos int, ten_bai string, ten_bai_en string")
    other = lessons.select("code", "pos", F.col("ten_bai").alias("noi_dung"))
    sinks.contract_files(lessons.select("code", "ten_bai"), lessons, other, other, f"{tmp_path}/con")
    back = spark.read.json(f"{tmp_path}/con/bai_hoc").first()
    assert back.records[0].ten_bai == "Mạng" and back.records[0].ten_bai_en == "Nets" and back.source_hash


# --- streams ---
def test_stream_of_changes(spark, tmp_path):
    schema = "k int, h string"
    put = lambda n, d: spark.createDataFrame(d, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    seen = []

    def run():
        df = stream.watch(spark, f"{tmp_path}/in", schema)
        stream.process_changes(df, "k", "h", f"{tmp_path}/store", lambda b, i: seen.append(rows(b, "k", "h")), f"{tmp_path}/cp").awaitTermination()

    put(0, [(1, "a"), (2, "b")])
    run()
    put(1, [(1, "a"), (2, "c"), (3, "d")])
    run()
    assert [x for x in seen if x] == [[(1, "a"), (2, "b")], [(2, "c"), (3, "d")]]


def test_window_counts(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.write.parquet(f"{tmp_path}/ev")
    df = stream.window_counts(spark.readStream.schema(ev.schema).parquet(f"{tmp_path}/ev"))
    q = df.writeStream.format("memory").queryName("win").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("win").agg(F.sum("n")).first()[0] == ev.count()


def test_workbooks(spark, tmp_path):
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="one" r:id="r1"/><sheet name="two" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Name</t></si><si><r><t>a</t></r><r><t>|b</t></r></si></sst>")
        z.writestr("xl/worksheets/s1.xml", f"<worksheet {main}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/s2.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>N</t></is></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3"><v>4.5</v></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    a, b = sorted(readers.workbooks(spark, str(tmp_path)).collect(), key=lambda r: r.path)
    assert (a.sheet, a.markdown) == ("two", "|  | Name |  | N |\n|---|---|---|---|\n| 0 |  |  |  |\n| 1 | a\\|b |  | 4.5 |")
    assert (b.sheet, b.markdown) == (None, None)
    assert readers.column_number("AB12") == 27
