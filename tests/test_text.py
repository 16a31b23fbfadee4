"""Scalar functions on literal rows."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from taxoloom import config
from taxoloom.functions import text as tx
from taxoloom.functions import unicode as un


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "f, value, want",
    [
        (tx.normalize_whitespace, " a \tb\n c ", "a b c"),
        (tx.normalize_whitespace, None, ""),
        (tx.strip_html_tags, "<p>a</p><script>x</script>&amp;", " a  x &amp;"),
        (tx.slugify_label, " Kỹ năng - Lập trình! ", "kỹ_năng_lập_trình"),
        (tx.slugify_label, "!!", "unknown"),
        (tx.safe_label, "_C++ & Đồ án_", "c_n"),
        (tx.strip_noise, "12. Giới\u0007 thiệu", "Giới thiệu"),
        (tx.strip_noise, "a) x", "x"),
        (tx.strip_noise, "• y", "y"),
        (tx.is_grading_event, "The Final Grade counts", True),
        (tx.is_boilerplate, " Writing report ", True),
        (tx.is_boilerplate, "writing reports", False),
        (tx.clean_str, " N/A ", None),
        (tx.clean_str, " x ", "x"),
        (tx.safe_float, "3,5", 3.5),
        (tx.safe_float, "x", None),
        (tx.split_list, " a, ,b,", ["a", "b"]),
        (tx.split_list, None, []),
        (tx.lines_list, " a,\n\nb ", ["a,", "b"]),
        (tx.split_sentences, "short. this one is long; and so is this\nno", ["this one is long", "and so is this"]),
        (tx.tokenize, "", []),
        (tx.tokenize, " A a B ", ["a", "a", "b"]),
        (tx.group_base_name, "I.1. Lý luận - Pháp luật — 13.0 tín chỉ", "Lý luận - Pháp luật"),
        (tx.group_base_name, " other ", "other"),
        (tx.strip_bs, "BS1_BS_BS", "BS1_BS"),
        (tx.add_bs, "IT1_BS", "IT1_BS"),
        (tx.uri_tail, "http://a/b/c//", "c"),
        (tx.strip_fence, '```json\n{"a": 1}\n```', '{"a": 1}'),
        (tx.cypher_escape, "it's", "it\\'s"),
        (tx.outcome_class, "Có thái độ học tập và kiến thức", "TU_CHU_TRACH_NHIEM"),
        (tx.outcome_class, "Understand graphs", "KIEN_THUC"),
        (tx.outcome_class, "Build things", "KY_NANG"),
        (tx.strip_lesson_prefix, "BÀI 3: Mạng", "Mạng"),
        (tx.strip_lesson_prefix, "Lesson 12 - Nets", "Nets"),
        (tx.strip_lesson_prefix, "Lessons", "Lessons"),
        (tx.csv_value, " a\nb ", "a b"),
        (tx.csv_value, None, ""),
        (un.nfc, "ế", "ế"),
        (un.slug_upper, "Đồ án Tốt nghiệp", "O_AN_TOT_NGHIEP"),
        (un.name_key, " Straße Ａ ", "strasse a"),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_other_scalars(spark):
    assert one(spark, ["a ", "", "NULL", "-"], tx.clean_list, "array<string>") == ["a", ""]
    assert one(spark, ["a;b", None, "c"], lambda c: tx.csv_value(c, "array"), "array<string>") == "a,b;c"
    assert one(spark, [" A ", "", "b", "B"], lambda c: tx.valid_concepts(c, 2), "array<string>") == ["a", "b"]
    assert one(spark, ["1310", "25"], tx.in_domain, "array<string>") and not one(spark, [], tx.in_domain, "array<string>")
    assert not one(spark, ["13", "9"], tx.in_domain, "array<string>")
    assert one(spark, "a b  c", lambda c: tx.truncate_tokens(c, 2)) == "a b" and one(spark, "a  b", lambda c: tx.truncate_tokens(c, 2)) == "a  b"
    assert one(spark, "microprocessor", lambda c: tx.contains_any(c, ("crop",)))
    assert one(spark, 0.0, tx.sigmoid, "double") == 0.5
    assert one(spark, None, lambda c: tx.best_rank(c, F.lit(3)), "int") == 3
    assert one(spark, "x", lambda c: tx.cache_key(c, "v1")) == one(spark, "x", lambda c: F.md5(F.lit("llm_v1_x")))
    assert one(spark, '```\n[{"a": 2}]\n```', lambda c: tx.parse_json_answer(c, "array<struct<a:int>>"))[0].a == 2
    a = one(spark, "x", lambda c: tx.content_hash(c, F.lit(None).cast("string")))
    assert a != one(spark, "x", lambda c: tx.content_hash(c, F.lit("")))


@pytest.mark.parametrize(
    "name, want",
    [
        ("I.2. Cơ sở — 13.0 tín chỉ - Nhóm a1", ("I.2", "Cơ sở", 13.0, "A1")),
        ("II.1. Tự chọn — 3 tín chỉ", ("II.1", "Tự chọn", 3.0, None)),
        ("Khác", ("?", "Khác", 0.0, None)),
    ],
)
def test_group_names(spark, name, want):
    assert tuple(one(spark, name, tx.parse_group_name)) == want


def test_classes(spark):
    rows = [("teamwork and logic", None), ("debugging", None), ("research", "x"), ("zzz", "x"), ("teamwork", "Knowledge")]
    df = spark.createDataFrame(rows, "t string, k string")
    assert [r[0] for r in df.select(tx.concept_class("t", "k")).collect()] == ["interpersonal", "cognitive", "methodological", "cognitive", "foundational"]
    weights = [("BAI_HOC", "full"), ("CLO", None), ("MO_TA", "odd"), ("MUC_TIEU", "KY_NANG"), ("X", None)]
    df = spark.createDataFrame(weights, "s string, t string")
    assert [r[0] for r in df.select(tx.evidence_weight("s", "t")).collect()] == [1.0, 0.85, 0.30, 0.65, 0.30]


def test_rounded_as_sql(spark):
    rng = random.Random(3)
    halves = [float(f"{rng.choice(('', '-'))}{rng.randrange(9)}.{rng.randrange(10**n):0{n}d}5") for n in (2, 6, 8) for _ in range(1000)]
    odd = [0.5167025, -0.5167025, 1.005, 0.49999949999999994, 0.0, 2.5e-7, 1e300, -1e305, 4503599627370497.5, 9007199254740993.0, float("nan"), float("inf"), float("-inf"), None]
    rows = list(enumerate(halves + odd))
    got = spark.createDataFrame(rows, "i long, x double").select("i", tx.rounded("x", 2).alias("a"), tx.rounded("x", 6).alias("b"), tx.rounded("x", 8).alias("c")).orderBy("i").collect()
    con = duckdb.connect()
    con.execute("create table t (i bigint, x double)")
    con.executemany("insert into t values (?, ?)", rows)
    want = con.execute("select i, round(x, 2), round(x, 6), round(x, 8) from t order by i").fetchall()
    same = lambda a, b: a == b or (a is not None and b is not None and a != a and b != b)
    assert [(w, tuple(g)) for w, g in zip(want, got, strict=True) if not all(map(same, w, g))] == []


def test_profiles(tmp_path):
    p = tmp_path / "p.json"
    p.write_text('{"rrf_k": 10, "skill": [0.9, 0.8, 0.7, 0.6]}')
    got = config.load_profile(str(p), "yaml_defaults")
    assert got.rrf_k == 10 and got.skill == (0.9, 0.8, 0.7, 0.6) and got.rerank_top_k == 100
    assert config.load_profile().skill == (0.85, 0.75, 0.60, 0.40)
