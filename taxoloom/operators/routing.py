"""The decision router: guards, thresholds, penalties and caps, as columns and two ranking windows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from taxoloom import config
from taxoloom.functions import text as tx

SOLID = ("CLO", "BAI_HOC")


def blocked_uri(uri: Column, uris: Iterable[str] = config.BLOCKED_URIS) -> Column:
    return uri.isin(*uris)


def signals(units: DataFrame) -> DataFrame:
    """Per course, which guards' words its evidence has: one row a course, by partial aggregates.

    Only units of outcomes and lessons that aren't boilerplate count; for offensive words, title-only lessons don't.
    """
    solid = units.where(F.col("source_type").isin(*SOLID) & ~F.col("is_boilerplate"))
    some = lambda words, extra=F.lit(True): F.bool_or(tx.contains_any("text", words) & extra)
    return solid.groupBy("course_code").agg(
        F.array(*(some(g) for g in config.BLOCKED_KEYWORDS)).alias("domain_signal"),
        some(config.OFFENSIVE_KEYWORDS, ~F.col("subtype").eqNullSafe("title_only")).alias("offensive_signal"),
        F.array(*(some((*aliases, label)) for label, aliases in config.FRAMEWORKS)).alias("framework_signal"),
    )


def domain_blocked(label: Column, signal: Column) -> Column:
    """A label with a word of a group of which the course's evidence has none."""
    out = F.lit(False)
    for i, group in enumerate(config.BLOCKED_KEYWORDS):
        out = out | (tx.contains_any(label, group) & ~F.coalesce(F.get(signal, F.lit(i)), F.lit(False)))
    return out


def security_drift(uri: Column, label: Column, signal: Column) -> Column:
    offensive = uri.isin(*config.OFFENSIVE_URIS) | tx.contains_any(label, config.OFFENSIVE_KEYWORDS)
    return offensive & ~F.coalesce(signal, F.lit(False))


def framework_guard(label: Column, signal: Column) -> Column:
    """The first framework that a label names decides; it must be in the course's evidence."""
    out = None
    for i, (name, aliases) in enumerate(config.FRAMEWORKS):
        hit, verdict = tx.contains_any(label, (*aliases, name)), ~F.coalesce(F.get(signal, F.lit(i)), F.lit(False))
        out = F.when(hit, verdict) if out is None else out.when(hit, verdict)
    return out.otherwise(F.lit(False))


def is_capstone(code: Column, title: Column, codes: Iterable[str] = config.CAPSTONE_CODES, words: Iterable[str] = config.CAPSTONE_KEYWORDS) -> Column:
    return code.isin(*codes) | tx.contains_any(title, words)


def course_type(sections: Column) -> Column:
    """The type of the first section (``array<string>``) that gives one; null if none does."""
    types = F.filter(F.transform(sections, lambda s: tx.map_values(s, config.SECTION_TYPE)), lambda x: x.isNotNull())
    return F.get(types, F.lit(0))


DEFAULTS = {"mismatch_flagged": False, "esco_type_agrees": True, "sparse": False, "capstone": False, "low_evidence_quality": False}


def route(candidates: DataFrame, p: config.Profile = config.CODE_DEFAULTS) -> DataFrame:
    """Adds ``tier, confidence, decision, reject_reason, priority, cap_rank, low_evidence_quality, mismatch_penalty_applied, final_combined``.

    Columns: ``course_code, course_type, concept_type, uri, label, rrf, rerank (nullable), combined, avg_weight, agreement,
    bm25_rank, dense_rank, domain_signal, offensive_signal, framework_signal`` and, with defaults, ``mismatch_flagged,
    esco_type_agrees, sparse, capstone, low_evidence_quality``. A low mean weight (0.30 where there is no evidence) only sets a flag. The
    first guard that hits rejects; it and a score below ``SECONDARY`` give ``low_confidence`` and ``LOW``, no priority and no place.
    Ties in priority: the least uri.
    """
    df = candidates
    for c, v in DEFAULTS.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    weight = F.coalesce("avg_weight", F.lit(config.DEFAULT_WEIGHT))
    low, cap, bad = F.col("low_evidence_quality") | (weight < p.low_quality), F.col("capstone"), F.col("mismatch_flagged")
    weak, strong = F.col("agreement") == "WEAK", F.col("agreement") == "STRONG"
    penalty = F.when(bad, p.mismatch_penalty).otherwise(0.0)
    df = df.withColumn("_score", F.coalesce("rerank", "combined") - penalty)
    df = df.withColumn("_combined", F.when(bad, F.greatest(F.lit(0.0), F.col("combined") - penalty)).otherwise(F.col("combined")))
    guard = (
        F.when(blocked_uri(F.col("uri"), p.blocked_uris) | domain_blocked(F.col("label"), F.col("domain_signal")), "DOMAIN_BLOCK")
        .when(security_drift(F.col("uri"), F.col("label"), F.col("offensive_signal")), "SECURITY_DRIFT")
        .when(framework_guard(F.col("label"), F.col("framework_signal")), "FRAMEWORK_WITHOUT_EXPLICIT_TEACHING")
        .when(cap & (weight < p.capstone_min_weight), "CAPSTONE_LOW_EVIDENCE_WEIGHT")
        .when(cap & F.col("sparse") & bad, "CAPSTONE_SPARSE_MISMATCH")
        .when(bad & ~F.col("esco_type_agrees") & low, "TRIPLE_FAIL_MISMATCH")
        .when(weak & bad, "WEAK_RETRIEVAL_MISMATCH")
        .when(weak & cap, "WEAK_RETRIEVAL_CAPSTONE")
    )
    knowledge = F.col("concept_type") == "knowledge"
    step = lambda i: F.when(cap, p.capstone_threshold).when(knowledge, p.knowledge[i]).otherwise(p.skill[i]) - F.when(strong, p.strong_bonus).otherwise(0.0)
    s = F.col("_score")
    tier = F.when(s >= step(0), "PRIMARY").when(s >= step(1), "SECONDARY").when((s >= step(2)) | (s >= step(3)), "OPTIONAL").otherwise("low_confidence")
    before_penalty = ("DOMAIN_BLOCK", "SECURITY_DRIFT", "FRAMEWORK_WITHOUT_EXPLICIT_TEACHING", "CAPSTONE_LOW_EVIDENCE_WEIGHT", "CAPSTONE_SPARSE_MISMATCH")
    df = df.withColumn("_guard", guard).withColumn("_tier", tier).withColumn("_low", low)
    df = df.withColumn("_fined", bad & ~F.coalesce(F.col("_guard").isin(*before_penalty), F.lit(False)))
    # A high cross score with a tiny fused score steps down to SECONDARY and REJECT, but still takes a place under the cap.
    step_down = (F.col("_tier") == "PRIMARY") & F.coalesce(F.col("rerank") >= step(0), F.lit(False)) & (F.col("rrf") < 0.005)
    df = df.withColumn("_down", step_down)
    best = tx.best_rank("bm25_rank", "dense_rank")
    df = df.withColumn("priority", F.col("_combined") + F.when(best == 1, 0.015).when(best == 2, 0.010).otherwise(0.0))
    df = df.withColumn("_in", F.col("_guard").isNull() & F.col("_tier").isin("PRIMARY", "SECONDARY"))
    limit = F.when(cap, p.capstone_cap)
    for kind, concept, n in p.caps:
        limit = limit.when((F.col("course_type") == kind) & (F.col("concept_type") == concept), n)
    df = df.withColumn("_cap", limit.otherwise(p.default_cap))
    # Of a capstone's clusters only the first few labels stay; those left out don't use up the cap.
    design = tx.contains_any("label", ("design",))
    law = tx.contains_any("label", ("legal", "compliance", "regulation"))
    df = df.withColumn("_cluster", F.when(cap & design, "design").when(cap & law, "law"))
    order = [F.round("priority", 9).desc(), F.col("uri")]
    group = ["course_code", "concept_type", "_in"]
    place = F.row_number().over(Window.partitionBy(*group, "_cluster").orderBy(*order))
    over = F.col("_in") & F.coalesce(place > F.when(F.col("_cluster") == "design", 3).when(F.col("_cluster") == "law", 2), F.lit(False))
    df = df.withColumn("_over", over)
    df = df.withColumn("cap_rank", F.when(F.col("_in") & ~F.col("_over"), F.row_number().over(Window.partitionBy(*group, "_over").orderBy(*order))))
    capped = F.col("_over") | (F.col("cap_rank") > F.col("_cap"))
    reason = F.coalesce(
        "_guard",
        F.when(~F.col("_in"), "below_overflow_threshold"),
        F.when(capped, F.concat(F.lit("exceeds_hard_cap_"), F.col("_cap").cast("string"))),
    )
    df = df.withColumn("reject_reason", reason)
    return df.select(
        *(c for c in candidates.columns if c != "low_evidence_quality"),
        F.when(~F.col("_in"), "low_confidence").when(F.col("_down"), "SECONDARY").otherwise(F.col("_tier")).alias("tier"),
        F.when(~F.col("_in"), "LOW").when(F.col("_down") | (F.col("_tier") == "SECONDARY"), "MED").otherwise("HIGH").alias("confidence"),
        F.when(F.col("reject_reason").isNull() & ~F.col("_down"), "ACCEPT").otherwise("REJECT").alias("decision"),
        "reject_reason", F.when(F.col("_in"), F.col("priority")).alias("priority"), "cap_rank", F.col("_low").alias("low_evidence_quality"),
        F.col("_fined").alias("mismatch_penalty_applied"), F.when(F.col("_fined"), F.col("_combined")).otherwise(F.col("combined")).alias("final_combined"),
    )


def tier_summary(routed: DataFrame, by: list[str]) -> DataFrame:
    """Counts by tier, zero where a tier has none, and by decision."""
    tiers = ("PRIMARY", "SECONDARY", "OPTIONAL", "low_confidence")
    return routed.groupBy(*by).agg(
        *(F.count_if(F.col("tier") == t).alias(f"n_{t.lower()}") for t in tiers),
        F.count_if(F.col("decision") == "ACCEPT").alias("n_accept"),
        F.count("*").alias("n_all"),
    )
