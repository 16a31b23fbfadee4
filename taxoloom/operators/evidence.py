"""Evidence units of courses, course contexts, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxoloom import config
from taxoloom.functions import text as tx

UNIT = ["course_code", "evidence_id", "source_type", "source_id", "text", "text_vi", "subtype", "linked"]


def description_units(courses: DataFrame) -> DataFrame:
    """``courses(code, mo_ta_en, mo_ta_vi)``."""
    text = tx.normalize_whitespace("mo_ta_en")
    return courses.select(
        F.col("code").alias("course_code"), F.concat("code", F.lit("_MOTA_MAIN")).alias("evidence_id"), F.lit("MO_TA").alias("source_type"), F.lit("M").alias("source_id"),
        text.alias("text"), tx.normalize_whitespace("mo_ta_vi").alias("text_vi"), F.lit(None).cast("string").alias("subtype"), F.lit(None).cast("array<string>").alias("linked"),
    ).where("text <> ''")


def objective_units(objectives: DataFrame) -> DataFrame:
    """``objectives(code, pos, ma_muc_tieu, loai_muc_tieu, noi_dung_en, noi_dung)``; a missing id is ``MT`` and the place among those kept."""
    rows = objectives.withColumn("text", tx.normalize_whitespace("noi_dung_en")).where((F.col("text") != "") & ~tx.is_grading_event("text"))
    place = F.row_number().over(Window.partitionBy("code").orderBy("pos"))
    rows = rows.withColumn("source_id", F.coalesce(F.nullif(F.col("ma_muc_tieu"), F.lit("")), F.concat(F.lit("MT"), place.cast("string"))))
    return rows.select(
        F.col("code").alias("course_code"), F.concat("code", F.lit("_MUCTIEU_"), "source_id").alias("evidence_id"), F.lit("MUC_TIEU").alias("source_type"), "source_id",
        "text", tx.normalize_whitespace("noi_dung").alias("text_vi"), F.nullif(F.col("loai_muc_tieu"), F.lit("")).alias("subtype"), F.lit(None).cast("array<string>").alias("linked"),
    )


def outcome_units(outcomes: DataFrame) -> DataFrame:
    """``outcomes(code, ma_cdr_goc, noi_dung_en, noi_dung, pi_so)``."""
    rows = outcomes.withColumn("text", tx.normalize_whitespace("noi_dung_en")).where((F.col("text") != "") & ~tx.is_grading_event("text"))
    return rows.select(
        F.col("code").alias("course_code"), F.concat("code", F.lit("_CLO_"), "ma_cdr_goc").alias("evidence_id"), F.lit("CLO").alias("source_type"), F.col("ma_cdr_goc").alias("source_id"),
        "text", tx.normalize_whitespace("noi_dung").alias("text_vi"), tx.outcome_class("text").alias("subtype"), F.col("pi_so").alias("linked"),
    )


def lesson_units(lessons: DataFrame) -> DataFrame:
    """``lessons(code, pos, ten_bai_en, ten_bai, noi_dung_en, ma_clo)``; ``pos`` counts all lessons from 1, kept or not."""
    title, body = tx.normalize_whitespace("ten_bai_en"), tx.normalize_whitespace("noi_dung_en")
    text = F.when((title != "") & (body != ""), F.concat(title, F.lit(". "), body)).otherwise(F.concat(title, body))
    number = F.concat(F.lit("L"), F.when(F.col("pos") < 100, F.lpad(F.col("pos").cast("string"), 2, "0")).otherwise(F.col("pos").cast("string")))
    rows = lessons.withColumn("text", text).withColumn("source_id", number).where((F.col("text") != "") & ~tx.is_grading_event("text"))
    return rows.select(
        F.col("code").alias("course_code"), F.concat("code", F.lit("_BAIHOC_"), "source_id").alias("evidence_id"), F.lit("BAI_HOC").alias("source_type"), "source_id",
        "text", tx.normalize_whitespace("ten_bai").alias("text_vi"), F.when(body != "", "full").otherwise("title_only").alias("subtype"), F.col("ma_clo").alias("linked"),
    )


def graded(units: DataFrame) -> DataFrame:
    """Adds ``evidence_weight`` and ``is_boilerplate``."""
    return units.withColumn("evidence_weight", tx.evidence_weight("source_type", "subtype")).withColumn("is_boilerplate", tx.is_boilerplate("text"))


def build(courses: DataFrame, objectives: DataFrame, outcomes: DataFrame, lessons: DataFrame) -> DataFrame:
    units = description_units(courses).unionByName(objective_units(objectives)).unionByName(outcome_units(outcomes)).unionByName(lesson_units(lessons))
    return graded(units)


def sparse_courses(courses: DataFrame, units: DataFrame, ratio: float = 0.60) -> DataFrame:
    """``(code, boilerplate_ratio, is_sparse)``; a course without evidence is sparse."""
    share = units.groupBy(F.col("course_code").alias("code")).agg(F.avg(F.col("is_boilerplate").cast("double")).alias("boilerplate_ratio"))
    return courses.select("code").join(share, "code", "left").withColumn("is_sparse", F.coalesce(F.col("boilerplate_ratio") > ratio, F.lit(True)))


def mean_weight(links: DataFrame, units: DataFrame, by: list[str], low: float = config.CODE_DEFAULTS.low_quality) -> DataFrame:
    """``links(*by, evidence_id)`` -> mean weight of the units that exist (0.30 if none) and whether it is low."""
    joined = links.join(units.select("evidence_id", "evidence_weight"), "evidence_id", "left")
    out = joined.groupBy(*by).agg(F.coalesce(F.avg("evidence_weight"), F.lit(config.DEFAULT_WEIGHT)).alias("avg_weight"))
    return out.withColumn("low_evidence_quality", F.col("avg_weight") < low)


def course_context(name: Column, description: Column, objectives: Column, outcomes: Column) -> Column:
    """Lines ``Course:``, ``Description:``, ``Objectives:``, ``CLO:`` of the parts that aren't empty (the last two are arrays)."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    joined = lambda c: F.array_join(F.filter(c, lambda x: F.coalesce(x, F.lit("")) != ""), " ")
    return F.concat_ws(
        "\n",
        F.when(some(name), F.concat(F.lit("Course: "), name, F.lit("."))),
        F.when(some(description), F.concat(F.lit("Description: "), description)),
        F.when(some(joined(objectives)), F.concat(F.lit("Objectives: "), joined(objectives))),
        F.when(some(joined(outcomes)), F.concat(F.lit("CLO: "), joined(outcomes))),
    )


def validate(courses: DataFrame, ignored: tuple[str, ...] = config.IGNORED_COURSES) -> DataFrame:
    """Adds ``warnings``, ``errors`` and ``is_valid``.

    Columns: ``code, declared, ten_vi, mo_ta_en, hashes array, outcomes array<struct<id,text>>,
    objectives array<struct<id,kind,text>>, lessons array<struct<title>>``. Null arrays count as empty.
    """
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    arr = lambda c: F.coalesce(F.col(c), F.array())
    kinds = F.filter(F.array_distinct(F.filter(F.col("hashes"), lambda h: ~blank(h))), lambda h: h.isNotNull())
    no_text = F.filter(F.col("outcomes"), lambda o: blank(o["text"]))
    odd = F.filter(F.col("objectives"), lambda o: ~blank(o["kind"]) & ~o["kind"].isin("KIEN_THUC", "KY_NANG", "TU_CHU_TRACH_NHIEM"))
    untitled = F.filter(F.col("lessons"), lambda x: blank(x["title"]))
    some = lambda c, f: F.coalesce(F.exists(F.col(c), lambda x: ~blank(x[f])), F.lit(False))
    any_text = ~(F.coalesce(F.col("mo_ta_en"), F.lit("")) == "") | some("outcomes", "text") | some("objectives", "text") | some("lessons", "title")
    has = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    warnings = F.array_compact(F.array(
        F.when(F.coalesce(F.size(kinds) > 1, F.lit(False)), "source_hash_mismatch"),
        F.when(has(no_text), "outcome_without_text"),
        F.when(has(odd), "objective_of_unknown_kind"),
        F.when(has(untitled), "lesson_without_title"),
    ))
    errors = F.array_compact(F.array(
        F.when(~F.col("code").eqNullSafe(F.col("declared")), "code_mismatch"),
        F.when(~any_text, "no_english_text"),
        F.when(tx.contains_any("ten_vi", ignored), "ignored_course"),
    ))
    return courses.withColumn("warnings", warnings).withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def health(courses: DataFrame, outcomes: DataFrame, lessons: DataFrame) -> DataFrame:
    """Per course: missing description, number of outcomes and lessons, shares with content (0 if none)."""
    o = outcomes.groupBy("code").agg(F.count("*").alias("n_outcomes"), F.avg((F.trim(F.coalesce("text", F.lit(""))) != "").cast("double")).alias("outcome_ratio"))
    x = lessons.groupBy("code").agg(F.count("*").alias("n_lessons"), F.avg((F.trim(F.coalesce("text", F.lit(""))) != "").cast("double")).alias("lesson_ratio"))
    return courses.join(o, "code", "left").join(x, "code", "left").select(
        "code", (F.trim(F.coalesce("description", F.lit(""))) == "").alias("no_description"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_outcomes", "n_lessons")), *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("outcome_ratio", "lesson_ratio")),
    )
