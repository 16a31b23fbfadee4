"""Verdicts, output records with provenance, concept tags, overlap, evaluation, review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators.retrieval import ordered_distinct


def verdict_keep(rows: DataFrame, verdicts: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Rows stay; a false verdict turns ``decision`` into REJECT. No verdict keeps it."""
    return rows.join(verdicts.select(*on, flag), on, "left").withColumn("decision", F.when(F.coalesce(F.col(flag).cast("boolean"), F.lit(True)), F.col("decision")).otherwise("REJECT")).drop(flag)


def verdict_drop(rows: DataFrame, verdicts: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Rows with a false verdict go. No verdict keeps a row."""
    return rows.join(verdicts.where(~F.col(flag).cast("boolean")).select(*on), on, "left_anti")


def overlap(rows: DataFrame, taught: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that aren't taught already, and those that are."""
    keys = taught.select(*on).distinct()
    return rows.join(keys, on, "left_anti"), rows.join(keys, on, "left_semi")


def head_majority(heads: Column) -> Column:
    """``skill`` where skill heads are as many as knowledge heads or more; null without any."""
    n = lambda k: F.size(F.filter(heads, lambda h: h == k))
    return F.when(n("skill") + n("knowledge") == 0, None).when(n("skill") >= n("knowledge"), "skill").otherwise("knowledge")


def build(candidates: DataFrame, links: DataFrame, units: DataFrame, meta: DataFrame) -> DataFrame:
    """Records with provenance: ``candidates(course_code, uri, ...)``, ``links(course_code, uri, evidence_id, mention, pos)``,
    ``units(evidence_id, source_type, text)``, ``meta(uri, label, skill_type)``.

    Links to missing units go; sources are sorted; mentions keep their order and are joined by ``; ``.
    Metadata is joined on its key; Spark broadcasts it while it is below its threshold.
    """
    joined = links.join(units.select("evidence_id", "source_type", F.col("text").alias("evidence_text")), "evidence_id")
    found = joined.groupBy("course_code", "uri").agg(
        F.array_sort(F.collect_set("evidence_id")).alias("evidence_ids"),
        F.array_join(F.array_sort(F.collect_set("source_type")), ",").alias("sources"),
        F.array_join(ordered_distinct("mention", "pos"), "; ").alias("matched_mention"),
    )
    out = candidates.join(found, ["course_code", "uri"], "left").join(meta, "uri", "left")
    skill_type = F.coalesce("skill_type", F.lit("skill/competence"))
    return out.withColumn("skill_type", skill_type).withColumn("concept_type", tx.concept_kind(skill_type)).withColumn("skill_id", tx.uri_tail("uri"))


def concept_tags(mentions: DataFrame) -> DataFrame:
    """``mentions(course_code, mention, evidence_id, pos)`` -> a tag for each distinct trimmed lower-cased mention of two
    characters or more: its first form and its evidence in order."""
    rows = mentions.withColumn("normalized", F.lower(F.trim("mention"))).where(F.char_length("normalized") >= 2)
    return rows.groupBy("course_code", "normalized").agg(F.min_by(F.trim("mention"), F.struct("pos", "mention")).alias("text"), ordered_distinct("evidence_id", "pos").alias("evidence_ids"))


def concept_edges(candidates: DataFrame) -> DataFrame:
    """``candidates(course_code, uri, pos, mentions array, confidence, ...)`` -> ``(course_code, normalized, uri, confidence)``: tag to skill,
    one an edge and course, that of the candidate that comes first. Candidates in any number may name one skill."""
    pairs = candidates.select("course_code", "uri", "confidence", "pos", F.explode("mentions").alias("m")).withColumn("normalized", F.lower(F.trim("m")))
    first = F.min_by(F.col("confidence"), F.struct("pos", "confidence"))
    return pairs.groupBy("course_code", "normalized", "uri").agg(F.round(first, 6).alias("confidence"))


def support_tags(concepts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Tags of support concepts, ``(course_code, normalized, text, evidence_ids, loai)``: classed by the skill type of the first candidate
    (``candidates(course_code, pos, skill_type, mentions)``) that has the concept, and by the concept's words."""
    said = candidates.select("course_code", "pos", "skill_type", F.explode("mentions").alias("m")).withColumn("normalized", F.lower(F.trim("m"))).where("normalized <> ''")
    kinds = said.groupBy("course_code", "normalized").agg(F.min_by("skill_type", F.struct("pos", "skill_type")).alias("skill_type"))
    tags = concept_tags(concepts).join(kinds, ["course_code", "normalized"], "left")
    return tags.withColumn("loai", tx.concept_class("text", "skill_type")).drop("skill_type")


def tag_documents(tags: DataFrame, edges: DataFrame, role: str) -> DataFrame:
    """``(course_code, document)``: a course's tags, its edges to them, those from tags to skills, and their numbers, as one JSON text."""
    a = tags.groupBy("course_code").agg(
        F.sort_array(F.collect_list(F.struct("normalized", "text", *(["loai"] if "loai" in tags.columns else [])))).alias("concept_tags"),
        F.sort_array(F.collect_list(F.struct(F.col("normalized").alias("concept_tag"), F.lit(role).alias("role"), F.col("evidence_ids").alias("source_evidence_ids")))).alias("has_concept_edges"),
    )
    source = "teaches_B" if role == "teach" else "supports_M5"
    b = edges.groupBy("course_code").agg(F.sort_array(F.collect_list(F.struct(F.col("normalized").alias("concept_tag"), F.col("uri").alias("esco_uri"), "confidence", F.lit(source).alias("pipeline_source")))).alias("evidence_for_edges"))
    out = a.join(b, "course_code", "full")
    lists = ("concept_tags", "has_concept_edges", "evidence_for_edges")
    for c in lists:
        out = out.withColumn(c, F.coalesce(c, F.array().cast(out.schema[c].dataType)))
    statistics = F.struct(*(F.size(c).alias(f"total_{c}") for c in lists)).alias("statistics")
    return out.select("course_code", F.to_json(F.struct("course_code", *lists, statistics)).alias("document"))


def teacher_records(candidates: DataFrame, links: DataFrame, units: DataFrame, meta: DataFrame) -> DataFrame:
    """Records of linked skills with nested provenance.

    ``candidates(course_code, uri, label, confidence, mismatch_penalty_applied, bm25_rank, dense_rank, esco_rank, ...)`` keep their columns.
    ``links(course_code, uri, evidence_id, mention, pos, source, head_type)``; ``units(evidence_id, source_type, source_id, text, subtype,
    evidence_weight, is_boilerplate)``; ``meta(uri, label, skill_type)``. Evidence keeps the order of first mention; links to missing
    units have none, but count for the head types and sources. The head signal is the majority of heads; a record is flagged where it isn't
    the concept's type, or a penalty was applied.
    """
    each = links.groupBy("course_code", "uri", "evidence_id").agg(F.min("pos").alias("pos"), F.array_join(ordered_distinct("mention", "pos"), "; ").alias("matched_mention"))
    some = each.join(units, "evidence_id")
    evidence = F.struct("pos", "evidence_id", "source_type", "source_id", "text", "subtype", F.nullif("matched_mention", F.lit("")).alias("matched_mention"), "evidence_weight", "is_boilerplate")
    nested = some.groupBy("course_code", "uri").agg(F.array_sort(F.collect_list(evidence)).alias("evidence"))
    heads = links.groupBy("course_code", "uri").agg(F.count_if(F.col("head_type") == "skill").alias("_s"), F.count_if(F.col("head_type") == "knowledge").alias("_k"), F.count("head_type").alias("_h"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("_sources"))
    known = meta.select("uri", F.col("label").alias("_label"), F.col("skill_type").alias("_type"))
    out = candidates.join(nested, ["course_code", "uri"], "left").join(heads, ["course_code", "uri"], "left").join(known, "uri", "left")
    skill_type = F.coalesce("_type", F.lit("skill/competence"))
    concept = tx.concept_kind(skill_type)
    signal = F.when(F.col("_h") > 0, F.when(F.col("_s") >= F.col("_k"), "skill").otherwise("knowledge"))
    agrees = F.coalesce(signal == concept, F.lit(True))
    own = [c for c in candidates.columns if c not in ("label", "mismatch_flagged", "esco_type_agrees", "concept_type", "skill_type")]
    return out.select(
        *own, F.coalesce("_label", "label").alias("preferred_label"), skill_type.alias("skill_type"), concept.alias("concept_type"),
        F.when(concept == "knowledge", "TEACHES_KNOWLEDGE").otherwise("TEACHES_SKILL").alias("relation_type"), tx.uri_tail(F.col("uri").cast("string")).alias("skill_id"),
        F.coalesce("evidence", F.array().cast(out.schema["evidence"].dataType)).alias("evidence"),
        F.struct(F.coalesce(F.nullif("_sources", F.lit("")), F.lit("unknown")).alias("source"), signal.alias("matched_head_type"), agrees.alias("esco_type_agrees")).alias("extraction"),
        F.struct("bm25_rank", "dense_rank", F.col("esco_rank").alias("esco_extract_skill_rank")).alias("retrieval"),
        (~agrees | F.coalesce("mismatch_penalty_applied", F.lit(False))).alias("mismatch_flagged"), agrees.alias("esco_type_agrees"),
    )


TIERS = ("PRIMARY", "SECONDARY", "OPTIONAL", "low_confidence")


def summary_documents(rows: DataFrame) -> DataFrame:
    """``rows(course_code, uri, preferred_label, concept_type, tier, decision, confidence)`` -> a course's summary ``(course_code, total_records,
    skill_count, knowledge_count, tier_distribution, skills, knowledges)``: counts by tier, zero where there is none, and entries by uri."""
    entry = F.struct("uri", "preferred_label", "confidence", "tier", "decision")
    listed = lambda kind: F.sort_array(F.collect_list(F.when(F.col("concept_type") == kind, entry)))
    tiers = F.create_map(*(x for k in TIERS for x in (F.lit(k), F.count_if(F.col("tier") == k))))
    out = rows.groupBy("course_code").agg(F.count("*").alias("total_records"), listed("skill").alias("skills"), listed("knowledge").alias("knowledges"), tiers.alias("tier_distribution"))
    return out.select("course_code", "total_records", F.size("skills").cast("long").alias("skill_count"), F.size("knowledges").cast("long").alias("knowledge_count"), "tier_distribution", "skills", "knowledges")


def summary(records: DataFrame, by: list[str]) -> DataFrame:
    return records.groupBy(*by).agg(
        F.count("*").alias("n_records"),
        F.count_if(F.col("concept_type") == "skill").alias("n_skill"),
        F.count_if(F.col("concept_type") == "knowledge").alias("n_knowledge"),
    )


def evaluate(predicted: DataFrame, gold: DataFrame, query: str, item: str) -> DataFrame:
    """``predicted(query, item, rank)``, ``gold(query, item)`` -> one row: precision, recall, f1, mrr (0 where undefined)."""
    hits = predicted.join(gold.select(query, item).distinct(), [query, item])
    tp, n_pred, n_gold = hits.agg(F.count("*").alias("tp"), F.lit(0).alias("k")), predicted.agg(F.count("*").alias("n_pred"), F.lit(0).alias("k")), gold.select(query, item).distinct().agg(F.count("*").alias("n_gold"), F.lit(0).alias("k"))
    first = hits.groupBy(query).agg(F.min("rank").alias("r"))
    mrr = gold.select(query).distinct().join(first, query, "left").agg(F.avg(F.coalesce(1 / F.col("r"), F.lit(0.0))).alias("mrr"), F.lit(0).alias("k"))
    out = tp.join(n_pred, "k").join(n_gold, "k").join(mrr, "k")
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    r = F.when(F.col("n_gold") > 0, F.col("tp") / F.col("n_gold")).otherwise(0.0)
    out = out.withColumn("precision", p).withColumn("recall", r)
    return out.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)).drop("k")


REVIEW = ["course_code", "course_name", "candidate_rank", "skill_uri", "preferred_label", "skill_type", "support_concept_origin", "rrf_score", "escoxlmr_score", "evidence_score", "final_score", "evidence_text", "review_question", "review_status", "reviewer_note"]


def review_sheet(candidates: DataFrame) -> DataFrame:
    """The sheet that a reviewer fills in: four-digit scores, status ``pending``."""
    have = set(candidates.columns)
    score = {"rrf_score", "escoxlmr_score", "evidence_score", "final_score"}
    fixed = {
        "review_question": F.concat(F.lit("Does "), F.col("course_name"), F.lit(" support "), F.col("preferred_label"), F.lit("?")),
        "review_status": F.lit("pending"),
        "reviewer_note": F.lit(""),
    }
    return candidates.select(*(fixed[c].alias(c) if c in fixed else F.round(F.col(c), 4).alias(c) if c in score and c in have else F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in REVIEW))


def reviewed(sheet: DataFrame) -> DataFrame:
    """Rows that a reviewer has dealt with: status trimmed in lower case, ``pending`` left out, origins split at ``;``."""
    status = F.lower(F.trim(F.coalesce("review_status", F.lit("pending"))))
    return sheet.withColumn("review_status", status).where(status != "pending").withColumn("origins", tx.split_list("support_concept_origin", ";"))


def accepted(sheet: DataFrame) -> DataFrame:
    return reviewed(sheet).where(F.col("review_status").contains("accept"))
