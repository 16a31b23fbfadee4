"""Retrieval, fusion, ranking, evidence, routing and records on literal rows."""

import json
import math

import pytest
from pyspark.sql import functions as F

from taxoloom import config, providers
from taxoloom.operators import evidence, ranking, records, retrieval, routing


def test_bm25_formula(spark):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat cat fish fish"), (3, "bird sky sea"), (4, ""), (5, "sun moon")], "d long, t string")
    index = retrieval.build_index(docs, "d", F.col("t"))
    assert (index.n_docs, index.avgdl) == (4, 11 / 4)
    got = {(r.query, r.doc): r.score for r in retrieval.bm25(spark.createDataFrame([(9, "Cat cat fish")], "query long, text string"), index).collect()}
    n, avg = 4, (2 + 4 + 3 + 2) / 4
    idf = lambda df: math.log((n - df + 0.5) / (df + 0.5))
    w = lambda i, tf, dl: i * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg))
    cat = idf(2) if idf(2) >= 0 else None
    assert cat == 0 and got[9, 2] == pytest.approx(2 * w(cat, 2, 4) + w(idf(1), 2, 4))
    assert got[9, 1] == pytest.approx(0)
    top = retrieval.bm25_top(spark.createDataFrame([(9, "cat fish")], "query long, text string"), index, 5).collect()
    assert [(r.doc, r["rank"]) for r in top] == [(2, 1)]


def test_negative_idf_floor(spark):
    docs = spark.createDataFrame([(i, "the x" + str(i)) for i in range(4)], "d long, t string")
    got = {r.term: r.idf for r in retrieval.build_index(docs, "d", F.col("t")).idf.collect()}
    raw = [math.log(0.5 / 4.5)] + [math.log(3.5 / 1.5)] * 4
    assert got["the"] == pytest.approx(0.25 * sum(raw) / 5)


def test_two_channel_fusion(spark):
    rows = [("c", "retrieval", "s1", 0.9), ("c", "retrieval", "s2", 0.8), ("c", "llm", "s2", 0.95), ("c", "llm", "s3", 0.7), ("c", "llm", "s3", 0.1)]
    got = retrieval.rrf(spark.createDataFrame(rows, "course string, channel string, uri string, score double"), ["course"], channels=("retrieval", "llm")).orderBy("fused_rank").collect()
    assert [r.uri for r in got] == ["s2", "s1", "s3"]
    assert got[0].rrf == pytest.approx(1 / 62 + 1 / 61) and got[1].rrf == pytest.approx(1 / 61) and got[2].rrf == pytest.approx(1 / 62)
    assert [r.agreement for r in got] == ["STRONG", "SINGLE_RETRIEVER", "SINGLE_RETRIEVER"]


def test_ranks_within_evidence_and_reported_ranks(spark):
    rows = [("c", "e1", "bm25", "a", 2.0, 3), ("c", "e1", "bm25", "a", 1.0, 1), ("c", "e1", "bm25", "b", 1.5, 2), ("c", "e2", "bm25", "b", 9.0, 7)]
    got = {r.uri: r for r in retrieval.rrf(spark.createDataFrame(rows, "course string, evidence_id string, channel string, uri string, score double, rank int"), ["course"]).collect()}
    assert got["a"].rrf == pytest.approx(1 / 61) and got["b"].rrf == pytest.approx(1 / 62 + 1 / 61)
    assert (got["a"].bm25_rank, got["b"].bm25_rank) == (1, 2)


@pytest.mark.parametrize("a, b, want", [(1, 5, "STRONG"), (16, 20, "WEAK"), (5, 6, "PARTIAL"), (None, 1, "SINGLE_RETRIEVER"), (15, 16, "PARTIAL")])
def test_agreement(spark, a, b, want):
    assert spark.createDataFrame([(a, b)], "a int, b int").select(retrieval.agreement(F.col("a"), F.col("b"))).first()[0] == want


def test_dense_blocks_agree(spark, monkeypatch):
    rows = [(i, [float((i * 7 + k * 3) % 11) - 5 for k in range(4)]) for i in range(30)]
    v = spark.createDataFrame(rows, "id long, vector array<double>")
    q, d = v.where("id < 9").withColumnRenamed("id", "query"), v.withColumnRenamed("id", "doc").repartition(5)
    one = sorted(map(tuple, retrieval.dense_top(q, d, 4, exclude_self=True).collect()))
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 8 * 4 * 2)
    monkeypatch.setattr(retrieval, "SCORES", 7)
    assert sorted(map(tuple, retrieval.dense_top(q, d, 4, exclude_self=True).collect())) == one
    vec = dict(rows)
    for qid in range(9):
        want = sorted(((-sum(x * y for x, y in zip(vec[qid], vec[i])), i) for i in vec if i != qid))[:4]
        assert [(r[1]) for r in sorted(one, key=lambda r: r[3]) if r[0] == qid] == [i for _, i in want]


def test_rank_operators(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 1.0), ("b", 4, 2.0)], "g string, k int, s double")
    assert sorted(map(tuple, ranking.max_by_key(df, ["g"], "s", ["k"]).collect())) == [("a", 1, 5.0), ("b", 4, 2.0)]
    n = {r.k: r.n for r in ranking.min_max(df, ["g"], "s", "n").collect()}
    assert n == {1: 1.0, 2: 1.0, 3: 0.0, 4: 1.0}
    capped = ranking.hard_cap(spark.createDataFrame([(i, 0.03 - 0.001 * i) for i in range(20)], "i int, score double"), [], [F.col("score").desc()], 7).collect()
    assert sum(r.reject_reason is None for r in capped) == 7 and {r.reject_reason for r in capped} == {None, "exceeds_hard_cap_7"}
    runs = spark.createDataFrame([(0, "x"), (1, "x"), (2, None), (3, None), (4, "x")], "o int, v string")
    assert sorted(r.o for r in ranking.consecutive_dedup(runs, [], ["o"], "v").collect()) == [0, 2, 4]
    ids = ranking.suffix_duplicates(spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "o int, k string"), [], "k", ["o"], "id").collect()
    assert {r.o: r.id for r in ids} == {0: "a_A", 1: "b", 2: "a_B"}
    got = {r.o: r.chunk for r in ranking.global_batches(spark.range(450).withColumnRenamed("id", "o").repartition(3), ["o"], 200, "chunk").collect()}
    assert got == {i: i // 200 for i in range(450)}


def test_rerank_and_evidence(spark):
    rows = [("c", f"u{i}", 0.1 - i / 100, 0.9 if i == 2 else 0.0) for i in range(4)]
    got = {r.uri: r for r in ranking.rerank_prefix(spark.createDataFrame(rows, "course string, uri string, rrf double, cross double"), "course", "uri", 3, 0.7, 0.3).collect()}
    assert got["u2"].combined_rank == 1 and got["u3"].combined == pytest.approx(0.07)
    sims = [("c", "u", "o1", "a", 0.2), ("c", "u", "o1", "b", 0.8), ("c", "u", "o2", "z", 0.4)]
    e = ranking.evidence_scores(spark.createDataFrame(sims, "course string, uri string, origin string, sentence string, sim double")).first()
    assert e.evidence == pytest.approx(0.6) and e.evidence_text == "b"


def units(spark, rows):
    return spark.createDataFrame(rows, "course_code string, source_type string, subtype string, text string, is_boilerplate boolean")


BASE = {
    "course_code": "c", "course_type": "CORE", "concept_type": "skill", "uri": "u", "label": "plain", "rrf": 0.03, "rerank": 0.9, "combined": 0.5, "avg_weight": 0.9,
    "agreement": "PARTIAL", "bm25_rank": 9, "dense_rank": 9, "mismatch_flagged": False, "esco_type_agrees": True, "sparse": False, "capstone": False,
}
KINDS = "course_code string, course_type string, concept_type string, uri string, label string, rrf double, rerank double, combined double, avg_weight double, agreement string, bm25_rank int, dense_rank int, mismatch_flagged boolean, esco_type_agrees boolean, sparse boolean, capstone boolean"


def routed(spark, rows, evidence_rows=(), p=config.CODE_DEFAULTS):
    df = spark.createDataFrame([tuple((BASE | r).values()) for r in rows], KINDS)
    return routing.route(df.join(routing.signals(units(spark, list(evidence_rows))), "course_code", "left"), p).collect()


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"avg_weight": 0.34}, None),
        ({"avg_weight": None, "rerank": 0.95}, None),
        ({"avg_weight": 0.34, "mismatch_flagged": True, "esco_type_agrees": False}, "TRIPLE_FAIL_MISMATCH"),
        ({"avg_weight": 0.35, "mismatch_flagged": True, "esco_type_agrees": False}, None),
        ({"avg_weight": 0.34, "mismatch_flagged": True}, None),
        ({"avg_weight": 0.34, "capstone": True}, "CAPSTONE_LOW_EVIDENCE_WEIGHT"),
        ({"avg_weight": 0.34, "mismatch_flagged": True, "esco_type_agrees": False, "agreement": "WEAK"}, "TRIPLE_FAIL_MISMATCH"),
        ({"label": "malware", "uri": config.BLOCKED_URIS[0]}, "DOMAIN_BLOCK"),
        ({"label": "malware with ITIL"}, "SECURITY_DRIFT"),
        ({"label": "use ITIL", "capstone": True, "avg_weight": 0.1}, "FRAMEWORK_WITHOUT_EXPLICIT_TEACHING"),
        ({"uri": config.BLOCKED_URIS[0]}, "DOMAIN_BLOCK"),
        ({"uri": config.BLOCKED_URIS[1]}, None),
        ({"label": "a Microprocessor"}, "DOMAIN_BLOCK"),
        ({"label": "Patient care"}, "DOMAIN_BLOCK"),
        ({"label": "malware"}, "SECURITY_DRIFT"),
        ({"uri": config.OFFENSIVE_URIS[0]}, "SECURITY_DRIFT"),
        ({"label": "use ITIL"}, "FRAMEWORK_WITHOUT_EXPLICIT_TEACHING"),
        ({"capstone": True, "avg_weight": 0.39}, "CAPSTONE_LOW_EVIDENCE_WEIGHT"),
        ({"capstone": True, "sparse": True, "mismatch_flagged": True}, "CAPSTONE_SPARSE_MISMATCH"),
        ({"agreement": "WEAK", "mismatch_flagged": True}, "WEAK_RETRIEVAL_MISMATCH"),
        ({"agreement": "WEAK", "capstone": True}, "WEAK_RETRIEVAL_CAPSTONE"),
        ({"rerank": 0.7}, "below_overflow_threshold"),
        ({"rerank": 0.1}, "below_overflow_threshold"),
    ],
)
def test_guards(spark, change, reason):
    r = routed(spark, [change])[0]
    assert r.reject_reason == reason and r.decision == ("ACCEPT" if reason is None else "REJECT")
    assert r.low_evidence_quality == ((BASE | change)["avg_weight"] is None or (BASE | change)["avg_weight"] < 0.35)
    # All that is rejected before the cap is of low confidence, and has neither priority nor place.
    assert (r.tier, r.confidence) == (("PRIMARY", "HIGH") if reason is None else ("low_confidence", "LOW"))
    assert (r.priority is None) == (r.cap_rank is None) == (reason is not None)


def test_penalties(spark):
    """A mismatch lowers the combined score, at zero at the least, but not before the first five guards."""
    rows = [{"uri": "1", "mismatch_flagged": True}, {"uri": "2", "mismatch_flagged": True, "combined": 0.01}, {"uri": "3", "mismatch_flagged": True, "label": "malware"}, {"uri": "4", "mismatch_flagged": True, "agreement": "WEAK"}, {"uri": "5"}]
    got = {r.uri: (r.mismatch_penalty_applied, round(r.final_combined, 6)) for r in routed(spark, rows)}
    assert got == {"1": (True, 0.475), "2": (True, 0.0), "3": (False, 0.5), "4": (True, 0.475), "5": (False, 0.5)}


def test_signals_lift_guards(spark):
    rows = [{"uri": "1", "label": "Patient care"}, {"uri": "2", "label": "malware"}, {"uri": "3", "label": "use ITIL"}, {"uri": "4", "label": "cobit and itil"}]
    some = [("c", "CLO", "KY_NANG", "Clinical work with ITIL", False), ("c", "BAI_HOC", "title_only", "exploit", False)]
    got = {r.uri: r.reject_reason for r in routed(spark, rows, some)}
    # COBIT comes before ITIL and decides; a title alone doesn't show offensive security.
    assert got == {"1": None, "2": "SECURITY_DRIFT", "3": None, "4": "FRAMEWORK_WITHOUT_EXPLICIT_TEACHING"}
    assert {r.reject_reason for r in routed(spark, rows[:1], [("c", "MO_TA", None, "clinical", False), ("c", "CLO", None, "clinical", True)])} == {"DOMAIN_BLOCK"}
    assert {r.reject_reason for r in routed(spark, rows[1:2], [("c", "BAI_HOC", "full", "exploit", False)])} == {None}


def test_thresholds(spark):
    rows = [{"uri": "1", "rerank": 0.84, "agreement": "STRONG"}, {"uri": "2", "rerank": 0.84}, {"uri": "3", "rerank": None, "combined": 0.86}, {"uri": "4", "rerank": 0.86, "mismatch_flagged": True}, {"uri": "5", "concept_type": "knowledge", "rerank": 0.81}]
    got = {r.uri: r for r in routed(spark, rows)}
    assert [got[str(i)].tier for i in range(1, 6)] == ["PRIMARY", "SECONDARY", "PRIMARY", "SECONDARY", "PRIMARY"]
    assert got["4"].priority == pytest.approx(0.475)
    assert {r.decision for r in routed(spark, [{"rerank": 0.86}], p=config.YAML_DEFAULTS)} == {"ACCEPT"}
    assert routed(spark, [{"rerank": 0.86}], p=config.YAML_DEFAULTS)[0].tier == "SECONDARY"


def test_step_down_takes_a_place(spark):
    rows = [{"uri": f"u{i:02}", "combined": 0.9 - i / 100, "rrf": 0.001 if i == 0 else 0.03, "course_type": "FOUNDATIONAL"} for i in range(9)]
    got = {r.uri: r for r in routed(spark, rows)}
    assert (got["u00"].tier, got["u00"].decision, got["u00"].reject_reason, got["u00"].cap_rank) == ("SECONDARY", "REJECT", None, 1)
    assert [u for u, r in sorted(got.items()) if r.decision == "ACCEPT"] == [f"u{i:02}" for i in range(1, 7)]
    assert got["u07"].reject_reason == "exceeds_hard_cap_7"


def test_rank_bonus(spark):
    got = {r.uri: r.priority for r in routed(spark, [{"uri": "1", "bm25_rank": 1}, {"uri": "2", "dense_rank": 2}, {"uri": "3", "bm25_rank": None, "dense_rank": None}])}
    assert got == {"1": pytest.approx(0.515), "2": pytest.approx(0.51), "3": pytest.approx(0.5)}


def test_clusters_do_not_use_the_cap(spark):
    rows = [{"uri": f"d{i}", "label": "design legal", "combined": 0.9 - i / 100, "capstone": True} for i in range(5)]
    rows += [{"uri": f"l{i}", "label": "legal", "combined": 0.8 - i / 100, "capstone": True} for i in range(4)]
    rows += [{"uri": f"p{i:02}", "combined": 0.6 - i / 100, "capstone": True} for i in range(9)]
    got = routed(spark, rows)
    good = sorted(r.uri for r in got if r.decision == "ACCEPT")
    assert good == ["d0", "d1", "d2", "l0", "l1", "p00", "p01", "p02", "p03", "p04"]
    assert {r.reject_reason for r in got if r.decision == "REJECT"} == {"exceeds_hard_cap_10"}


def test_course_types_and_capstone(spark):
    df = spark.createDataFrame([(["I.2"], "IT6205", ""), (["II.2"], "X", "Graduation Thesis"), (["II.3"], "X", "y"), (["Z", "II.2"], "X", None), ([], "X", "")], "s array<string>, c string, t string")
    got = df.select(routing.course_type(F.col("s")).alias("k"), routing.is_capstone(F.col("c"), F.col("t")).alias("p")).collect()
    assert [r.k for r in got] == ["FOUNDATIONAL", "CORE", "SPECIALIZED", "CORE", None] and [r.p for r in got] == [True, True, False, False, False]


def test_evidence_numbering(spark):
    lessons = spark.createDataFrame([("c", 1, "", "", ""), ("c", 2, "T", "t", "body"), ("c", 3, "Only", "", ""), ("c", 4, "Final grade", "", "")], "code string, pos int, ten_bai_en string, ten_bai string, noi_dung_en string").withColumn("ma_clo", F.array(F.lit("L1")))
    got = {r.evidence_id: r for r in evidence.graded(evidence.lesson_units(lessons)).collect()}
    assert set(got) == {"c_BAIHOC_L02", "c_BAIHOC_L03"} and got["c_BAIHOC_L02"].text == "T. body"
    assert (got["c_BAIHOC_L02"].evidence_weight, got["c_BAIHOC_L03"].evidence_weight) == (1.0, 0.3)
    goals = spark.createDataFrame([("c", 1, "G9", "KY_NANG", "a", ""), ("c", 2, None, None, "b", ""), ("c", 3, "", None, " ", "")], "code string, pos int, ma_muc_tieu string, loai_muc_tieu string, noi_dung_en string, noi_dung string")
    assert sorted(r.evidence_id for r in evidence.objective_units(goals).collect()) == ["c_MUCTIEU_G9", "c_MUCTIEU_MT2"]
    both = spark.createDataFrame([("c",)], "code string").crossJoin(spark.createDataFrame([(None, None)], "boilerplate_ratio double, z int"))
    assert evidence.sparse_courses(both.select("code"), evidence.graded(evidence.lesson_units(lessons.limit(0)))).first().is_sparse
    w = evidence.mean_weight(spark.createDataFrame([("u", "none")], "uri string, evidence_id string"), evidence.graded(evidence.lesson_units(lessons)), ["uri"]).first()
    assert w.avg_weight == 0.30 and w.low_evidence_quality


def test_verdicts_and_overlap(spark):
    rows = spark.createDataFrame([("a", "ACCEPT"), ("b", "ACCEPT"), ("c", "ACCEPT")], "uri string, decision string")
    v = spark.createDataFrame([("a", False), ("b", True)], "uri string, ok boolean")
    assert {r.uri: r.decision for r in records.verdict_keep(rows, v, ["uri"], "ok").collect()} == {"a": "REJECT", "b": "ACCEPT", "c": "ACCEPT"}
    assert {r.uri for r in records.verdict_drop(rows, v, ["uri"], "ok").collect()} == {"b", "c"}
    kept, gone = records.overlap(spark.createDataFrame([("s1",), ("s3",)], "u string"), spark.createDataFrame([("s1",), ("s2",), ("s1",)], "u string"), ["u"])
    assert [r.u for r in kept.collect()] == ["s3"] and [r.u for r in gone.collect()] == ["s1"]


def test_records_and_tags(spark):
    links = spark.createDataFrame([("c", "http://x/s1", "e1", "B", 2), ("c", "http://x/s1", "e2", "A", 1), ("c", "http://x/s1", "lost", "Z", 0)], "course_code string, uri string, evidence_id string, mention string, pos int")
    us = spark.createDataFrame([("e1", "CLO", "t"), ("e2", "BAI_HOC", "t")], "evidence_id string, source_type string, text string")
    meta = spark.createDataFrame([("http://x/s1", "l", "knowledge")], "uri string, label string, skill_type string")
    r = records.build(spark.createDataFrame([("c", "http://x/s1"), ("c", "http://x/s2")], "course_code string, uri string"), links, us, meta).orderBy("uri").collect()
    assert (r[0].evidence_ids, r[0].sources, r[0].matched_mention, r[0].concept_type, r[0].skill_id) == (["e1", "e2"], "BAI_HOC,CLO", "A; B", "knowledge", "s1")
    assert (r[1].skill_type, r[1].concept_type) == ("skill/competence", "skill")
    tags = records.concept_tags(spark.createDataFrame([("c", " SQL", "e1", 1), ("c", "sql ", "e2", 0), ("c", "x", "e", 2)], "course_code string, mention string, evidence_id string, pos int")).collect()
    assert [(t.normalized, t.text, t.evidence_ids) for t in tags] == [("sql", "sql", ["e2", "e1"])]


def test_nested_records(spark):
    links = spark.createDataFrame([("c", "http://x/s1", "e1", "B", 2, "llm", "knowledge"), ("c", "http://x/s1", "e2", "A", 1, "rule", "skill"), ("c", "http://x/s1", "e1", "C", 3, "llm", "knowledge"), ("c", "http://x/s1", "lost", "Z", 0, "llm", None)], "course_code string, uri string, evidence_id string, mention string, pos int, source string, head_type string")
    us = spark.createDataFrame([("e1", "CLO", "1", "t1", "KY_NANG", 0.85, False), ("e2", "BAI_HOC", "2", "t2", "full", 1.0, True)], "evidence_id string, source_type string, source_id string, text string, subtype string, evidence_weight double, is_boilerplate boolean")
    meta = spark.createDataFrame([("http://x/s1", "known", "skill/competence")], "uri string, label string, skill_type string")
    cand = spark.createDataFrame([("c", "http://x/s1", "l1", 0.5, False, 1, None, None), ("c", "s2", "l2", 0.4, True, None, 3, 4)], "course_code string, uri string, label string, confidence double, mismatch_penalty_applied boolean, bm25_rank int, dense_rank int, esco_rank int")
    a, b = records.teacher_records(cand, links, us, meta).orderBy("uri").collect()
    assert (a.preferred_label, a.concept_type, a.relation_type, a.skill_id) == ("known", "skill", "TEACHES_SKILL", "s1")
    assert [(e.source_type, e.source_id, e.matched_mention, e.evidence_weight, e.is_boilerplate) for e in a.evidence] == [("BAI_HOC", "2", "A", 1.0, True), ("CLO", "1", "B; C", 0.85, False)]
    assert tuple(a.extraction) == ("llm,rule", "knowledge", False) and a.mismatch_flagged and tuple(a.retrieval) == (1, None, None)
    assert (b.preferred_label, b.evidence, tuple(b.extraction), b.mismatch_flagged, b.esco_type_agrees) == ("l2", [], ("unknown", None, True), True, True)
    s = records.summary_documents(records.teacher_records(cand, links, us, meta).withColumn("tier", F.lit("PRIMARY")).withColumn("decision", F.lit("ACCEPT"))).first()
    assert (s.total_records, s.skill_count, s.knowledge_count, s.tier_distribution) == (2, 2, 0, {"PRIMARY": 2, "SECONDARY": 0, "OPTIONAL": 0, "low_confidence": 0})


def test_edges_stay_in_their_course(spark):
    cand = spark.createDataFrame([("a", 1, "u", ["SQL "], 0.2), ("a", 0, "u", ["sql", "x"], 0.1), ("b", 0, "u", ["sql"], 0.9)], "course_code string, pos int, uri string, mentions array<string>, confidence double")
    got = sorted(map(tuple, records.concept_edges(cand).collect()))
    assert got == [("a", "sql", "u", 0.1), ("a", "x", "u", 0.1), ("b", "sql", "u", 0.9)]
    said = spark.createDataFrame([("a", "SQL", "e1", 1), ("a", "Teamwork", "e1", 2), ("a", "else", "e2", 3)], "course_code string, mention string, evidence_id string, pos int")
    kinds = cand.withColumn("skill_type", F.when(F.col("pos") == 0, "knowledge").otherwise("skill"))
    tags = records.support_tags(said, kinds)
    assert {r.normalized: r.loai for r in tags.collect()} == {"sql": "foundational", "teamwork": "interpersonal", "else": "cognitive"}
    docs = {r.course_code: json.loads(r.document) for r in records.tag_documents(tags, records.concept_edges(cand), "support").collect()}
    assert docs["a"]["statistics"] == {"total_concept_tags": 3, "total_has_concept_edges": 3, "total_evidence_for_edges": 2} and docs["b"]["concept_tags"] == []


def test_context_pass_and_direct_candidates(spark):
    q = spark.createDataFrame([(1, "alpha")], "query long, text string")
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(["alpha beta", "beta", "gamma"])], "id long, text string")
    corpus = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "doc long, vector array<double>")
    v = lambda x: spark.createDataFrame([(1, x)], "query long, vector array<double>")
    index = retrieval.build_index(docs, "id", F.col("text"))
    got = retrieval.hybrid(q, index, v([1.0, 0.0]), corpus, 1, v([0.0, 1.0]), spark.createDataFrame([(1, 7, 0.5), (1, 8, 0.6)], "query long, uri long, score double"))
    assert sorted((r.channel, r.uri, r.rank) for r in got.collect()) == [("bm25", 0, 1), ("dense", 0, 1), ("dense", 1, 1), ("esco_extract", 7, 2), ("esco_extract", 8, 1)]
    assert spark.range(1).select(retrieval.with_context(F.lit("a"), F.lit("b")).alias("x"), retrieval.with_context(F.lit("a"), F.lit("")).alias("y")).first() == ("a. Context: b", None)
    empty = retrieval.build_index(docs.limit(0), "id", F.col("text"))
    assert retrieval.bm25_top(q, empty, 3).count() == 0
    rows = spark.createDataFrame([("T", "l", "d", ["m"], ["s"]), ("T", "l", None, [], ["s"]), ("T", "l", "d", None, None)], "course_title string, label string, description string, mentions array<string>, source_texts array<string>")
    assert [(r.context, r.candidate) for r in retrieval.rerank_texts(rows).collect()] == [("T. m", "l. d"), ("T. s", "l."), ("T.", "l. d")]


def test_evaluation_and_review(spark):
    pred = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("p", "z", 1)], "q string, i string, rank int")
    gold = spark.createDataFrame([("q", "b"), ("p", "y"), ("q", "b")], "q string, i string")
    m = records.evaluate(pred, gold, "q", "i").first()
    assert (m.tp, m.precision, m.recall, m.mrr) == (1, pytest.approx(1 / 3), 0.5, 0.25)
    assert records.evaluate(pred.limit(0), gold.limit(0), "q", "i").first().f1 == 0
    sheet = spark.createDataFrame([(" Accepted", "a; b"), ("pending", ""), ("rejected", "c"), (None, "")], "review_status string, support_concept_origin string")
    assert [r.origins for r in records.accepted(sheet).collect()] == [["a", "b"]] and records.reviewed(sheet).count() == 2


def test_providers(spark):
    df = spark.createDataFrame([("q", "a", "t1"), ("q", "b", "t2")], "query string, item string, text string")
    vec = providers.TableEncoder(spark.createDataFrame([("t1", [1.0])], "text string, vector array<double>")).encode(df, "text", "v")
    assert {r.item: r.v for r in vec.collect()} == {"a": [1.0], "b": None}
    model = providers.ModelEncoder(lambda: (lambda ts: [[float(len(t))] for t in ts])).encode(df, "text", "v")
    assert [r.v for r in model.collect()] == [[2.0], [2.0]]

    def clients():
        def broken(x):
            raise OSError(x)

        return [broken, lambda x: x.upper()]

    assert [r.answer for r in providers.ModelAnswers(clients).ask(df, "text").collect()] == ["T1", "T2"]
    cached = providers.TableAnswers(spark.createDataFrame([("k", "yes")], "cache_key string, answer string"))
    assert cached.ask(spark.createDataFrame([("k",), ("l",)], "cache_key string")).where("answer is null").count() == 1
    g = spark.createDataFrame([(1, 2, "X", None), (None, 2, "X", "S"), (0, 1, "X", "S")], "char_start int, char_end int, code string, source_code string")
    assert sorted(r.code for r in providers.grounded(g).collect()) == ["S", "X"]


def test_containing(spark):
    docs = spark.createDataFrame([(1, "The cat sat on the mat"), (2, "a cat sat, on"), (3, None), (4, ""), (5, "scat sat on thee")], "doc long, text string")
    index = retrieval.build_index(docs, "doc", F.col("text"))
    asked = spark.createDataFrame([(1, "cat sat on the"), (2, "at s"), (3, None), (4, ""), (5, "on zebra on"), (6, "Cat sat on"), (7, "sat"), (1, "cat sat on the")], "query long, text string")
    got = sorted((r.query, r.doc) for r in retrieval.containing(asked, docs, index).collect())
    assert got == [(1, 1), (1, 5), (2, 1), (2, 2), (2, 5), (7, 1), (7, 2), (7, 5)]


def test_syllabi(spark):
    from taxoloom.operators import extraction

    schema = "source_file string, pos int, extraction_class string, extraction_text string, char_start int, char_end int, attributes map<string,string>"
    e = spark.createDataFrame([
        ("IT1_x", 2, "muc_tieu", "second", 0, 1, {"loai_muc_tieu": "OTHER", "so_ctdt": "1, ,2"}), ("IT1_x", 1, "muc_tieu", "first", 0, 1, {"loai_muc_tieu": "KY_NANG", "noi_dung": "said"}),
        ("IT1_x", 3, "hoc_phan", "", 0, 1, {"ma_hoc_phan": "LLM", "ten_vi": "old"}), ("IT1_x", 4, "hoc_phan", "", 0, 1, {"ma_hoc_phan": "null", "ten_vi": "new", "so_tin_chi_tong": "2,5"}),
        ("IT1_x", 5, "hoc_phan", "", None, None, {"ten_vi": "unplaced"}), ("IT2_y", 1, "clo", "c", None, 3, None), ("IT3", 1, "bai_hoc", "lesson", 0, 1, None),
    ], schema)
    own = spark.createDataFrame([("IT1_x", None, "src", "en"), ("IT3", "REAL", None, None), ("IT9", "X", None, None)], "source_file string, ma_hoc_phan string, ten_vi string, ten_en string")
    a, b, c = sorted(extraction.syllabi(e, own).collect(), key=lambda r: r.source_file)
    assert [tuple(x) for x in a.muc_tieu_hoc_phan] == [(None, "KY_NANG", "said", []), (None, None, "second", ["1", "2"])]
    assert tuple(a.hoc_phan) == ("IT1", "new", "en", 2.5, None) and a.clo is None
    assert (b.ma_hoc_phan, b.clo, b.source_course_code) == ("IT2", None, None)
    assert (c.ma_hoc_phan, c.source_course_code, c.bai_hoc[0].ten_bai) == ("REAL", "REAL", "lesson")
