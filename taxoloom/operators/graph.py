"""Property graph: node tables by label, one edge table, and their schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators.ranking import keep_first

# Labels with their properties (the key first), and edges with their ends and properties.
NODES = {
    "ChuongTrinhDaoTao": ("ma_ctdt", "ten_ctdt", "bac_dao_tao", "phien_ban"),
    "NhomHocPhan": ("group_id", "ten_nhom", "loai_nhom", "so_tin_chi_yeu_cau"),
    "HocPhan": ("ma_hoc_phan", "ten_vi", "ten_en", "so_tin_chi_tong", "mo_ta_tom_tat", "hoc_ky_goi_y", "loai_hoc_phan"),
    "MucTieuHocPhan": ("mucTieu_id", "loai_muc_tieu", "ma_muc_tieu", "noi_dung"),
    "CLO": ("clo_id", "ma_cdr_goc", "noi_dung", "pi_so", "muc_do"),
    "Bai": ("lesson_id", "so_thu_tu", "ten_bai", "noi_dung_tom_tat"),
    "KyNangESCO": ("skill_uri", "preferred_label", "alternative_labels", "description", "skill_type"),
    "NgheNghiepESCO": ("occupation_uri", "preferred_label", "alternative_labels", "description"),
    "ConceptTag": ("normalized", "text", "loai"),
}
EDGES = {
    "HAS_COURSE": ("ChuongTrinhDaoTao", "HocPhan", ()),
    "BELONGS_TO": ("HocPhan", "NhomHocPhan", ()),
    "HAS_OBJECTIVE": ("HocPhan", "MucTieuHocPhan", ()),
    "HAS_CLO": ("HocPhan", "CLO", ()),
    "HAS_LESSON": ("HocPhan", "Bai", ()),
    "SUPPORTS_CLO": ("Bai", "CLO", ()),
    "PREREQUISITE": ("HocPhan", "HocPhan", ("is_explicitly_empty", "source")),
    "PREVIOUS_COURSE": ("HocPhan", "HocPhan", ("is_explicitly_empty", "source")),
    "TEACHES_SKILL": ("HocPhan", "KyNangESCO", ("retrieval_score", "rerank_score", "validation_confidence", "matched_mentions")),
    "TEACHES_KNOWLEDGE": ("HocPhan", "KyNangESCO", ("retrieval_score", "rerank_score", "validation_confidence", "matched_mentions")),
    "SUPPORTS_SKILL": ("HocPhan", "KyNangESCO", ("matched_mentions", "validation_confidence")),
    "SUPPORTS_KNOWLEDGE": ("HocPhan", "KyNangESCO", ("matched_mentions", "validation_confidence")),
    "REQUIRES_SKILL": ("NgheNghiepESCO", "KyNangESCO", ("importance_type",)),
    "HAS_CONCEPT": ("HocPhan", "ConceptTag", ("role",)),
    "EVIDENCE_FOR": ("ConceptTag", "KyNangESCO", ("confidence", "pipeline_source")),
}


def schema_table(spark: SparkSession) -> DataFrame:
    """The graph's schema as rows ``(kind, name, source, target, properties)``."""
    rows = [("NODE", n, None, None, ", ".join(p)) for n, p in NODES.items()] + [("RELATIONSHIP", n, a, b, ", ".join(p)) for n, (a, b, p) in EDGES.items()]
    return spark.createDataFrame(rows, "kind string, name string, source string, target string, properties string")


def nodes(label: str, df: DataFrame, key: str, prefer: list[str] | None = None) -> DataFrame:
    """``(label, node_key, properties map)``, one a key: the row that comes first by ``prefer`` (by its properties where it is left out)."""
    rest = [c for c in df.columns if c != key and c not in (prefer or [])]
    props = F.map_filter(F.create_map(*(x for c in rest for x in (F.lit(c), F.col(c).cast("string")))), lambda k, v: v.isNotNull()) if rest else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = df.where(F.col(key).isNotNull()).select(F.lit(label).alias("label"), F.col(key).cast("string").alias("node_key"), props.alias("properties"), F.struct(*(prefer or rest or [key])).alias("_order"))
    return keep_first(rows, ["label", "node_key"], ["_order"]).drop("_order")


def edges(kind: str, df: DataFrame, source: Column, target: Column, properties: dict[str, Column] | None = None) -> DataFrame:
    """``(source_id, target_id, type, properties map)``, distinct by ends and type; rows with a null end go."""
    props = F.create_map(*(x for k, v in (properties or {}).items() for x in (F.lit(k), v.cast("string")))) if properties else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = df.select(source.cast("string").alias("source_id"), target.cast("string").alias("target_id"), F.lit(kind).alias("type"), props.alias("properties"))
    rows = rows.where(F.col("source_id").isNotNull() & F.col("target_id").isNotNull()).withColumn("_o", F.to_json("properties"))
    return keep_first(rows, ["source_id", "target_id", "type"], ["_o"]).drop("_o")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def optional(df: DataFrame, *names: str, default: str = "") -> Column:
    """The first of the columns that ``df`` has and that isn't empty, as text."""
    have = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(default))


def contract(courses: DataFrame, objectives: DataFrame, outcomes: DataFrame, lessons: DataFrame, members: DataFrame, programmes: DataFrame | None = None, legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of course contracts. ``_BS`` goes from codes; of equal codes the one without it is kept.

    ``courses(code, ten_vi, ten_en, ten_vi_en, prerequisites array, previous array)``, ``objectives(code, ma_muc_tieu, noi_dung)``,
    ``outcomes(code, ma_clo, noi_dung)``, ``lessons(code, pos, ten_bai, dap_ung_cdr array, ma_clo array)``,
    ``members(ma_ctdt, code, nhom_id, loai_nhom)``, ``programmes(ma_ctdt, ten_ctdt, bac_dao_tao, phien_ban)``. Further columns by the names of
    the nodes' properties are taken where they are there: credits, descriptions, suggested terms, kinds, levels, translations; a course
    without credits, term or kind takes those of its first membership, and so does one that only programmes name.
    ``legacy``: lesson edges by ``dap_ung_cdr`` alone.
    """
    bare = tx.strip_bs("code")
    term = optional(members, "hoc_ky_goi_y")
    credits = optional(members, "so_tin_chi", default="0.0")
    first = members.select(bare.alias("code"), F.struct("ma_ctdt", "nhom_id").alias("_at"), optional(members, "ten_hoc_phan").alias("m_vi"), optional(members, "ten_hoc_phan_en").alias("m_en"), credits.alias("m_credits"), term.alias("m_term"), F.coalesce("loai_nhom", F.lit("")).alias("m_kind"))
    first = first.groupBy("code").agg(F.min_by(F.struct("m_vi", "m_en", "m_credits", "m_term", "m_kind"), "_at").alias("m")).select("code", "m.*")
    own = courses.select(
        bare.alias("code"), "ten_vi", F.coalesce(F.nullif("ten_en", F.lit("")), "ten_vi_en").alias("ten_en"), optional(courses, "so_tin_chi_tong", default="0.0").alias("credits"),
        optional(courses, "mo_ta_tom_tat").alias("mo_ta_tom_tat_vi"), optional(courses, "mo_ta_tom_tat_en").alias("mo_ta_tom_tat_en"), optional(courses, "hoc_ky_goi_y", "hoc_ky_du_kien").alias("term"),
        optional(courses, "loai_hoc_phan").alias("kind"), F.col("code").endswith("_BS").alias("_bs"), F.col("ten_vi").alias("_name"),
    )
    c = own.join(first, "code", "left").select(
        "code", "ten_vi", "ten_en", F.when(F.col("credits").cast("double") == 0, F.coalesce("m_credits", "credits")).otherwise(F.col("credits")).cast("double").alias("so_tin_chi_tong"),
        "mo_ta_tom_tat_vi", "mo_ta_tom_tat_en", F.coalesce(F.nullif("term", F.lit("")), "m_term", F.lit("")).alias("hoc_ky_goi_y"), F.coalesce(F.nullif("kind", F.lit("")), "m_kind", F.lit("")).alias("loai_hoc_phan"), "_bs", "_name",
    )
    goals = objectives.where(F.coalesce("ma_muc_tieu", F.lit("")) != "").select(F.concat_ws("_", bare, "ma_muc_tieu").alias("id"), bare.alias("code"), optional(objectives, "loai_muc_tieu").alias("loai_muc_tieu"), "ma_muc_tieu", F.col("noi_dung").alias("noi_dung_vi"), optional(objectives, "noi_dung_en").alias("noi_dung_en"))
    clo = F.nullif(optional(outcomes, "ma_cdr_goc", "ma_clo"), F.lit(""))
    texts = lambda df, name: F.col(name) if name in df.columns else F.lit(None).cast("array<string>")
    outs = outcomes.withColumn("_clo", clo).where("_clo is not null").select(F.concat_ws("_", bare, "_clo").alias("id"), bare.alias("code"), F.col("_clo").alias("ma_cdr_goc"), F.col("noi_dung").alias("noi_dung_vi"), optional(outcomes, "noi_dung_en").alias("noi_dung_en"), F.array_join(texts(outcomes, "pi_so"), ";").alias("pi_so"), optional(outcomes, "muc_do").alias("muc_do"))
    number = F.coalesce(F.nullif(F.col("so_thu_tu"), F.lit(0)), F.col("pos")) if "so_thu_tu" in lessons.columns else F.col("pos")
    less = lessons.withColumn("_n", number).select(
        F.concat(bare, F.lit("_L"), F.col("_n").cast("string")).alias("id"), bare.alias("code"), F.col("_n").alias("so_thu_tu"), F.col("ten_bai").alias("ten_bai_vi"), optional(lessons, "ten_bai_en").alias("ten_bai_en"),
        optional(lessons, "noi_dung", "noi_dung_tom_tat").alias("noi_dung_tom_tat_vi"), optional(lessons, "noi_dung_en", "noi_dung_tom_tat_en").alias("noi_dung_tom_tat_en"), (F.col("dap_ung_cdr") if legacy else F.coalesce("dap_ung_cdr", "ma_clo")).alias("dap_ung_cdr"),
    )
    group = F.concat_ws("_", "ma_ctdt", "nhom_id")
    m = members.select("ma_ctdt", bare.alias("code"), group.alias("group_id"), F.col("nhom_id").alias("ten_nhom_vi"), optional(members, "nhom_id_en").alias("ten_nhom_en"), "loai_nhom")
    stray = first.join(c.select("code").distinct(), "code", "left_anti").select("code", F.col("m_vi").alias("ten_vi"), F.col("m_en").alias("ten_en"), F.col("m_credits").cast("double").alias("so_tin_chi_tong"), F.lit("").alias("mo_ta_tom_tat_vi"), F.lit("").alias("mo_ta_tom_tat_en"), F.col("m_term").alias("hoc_ky_goi_y"), F.col("m_kind").alias("loai_hoc_phan"))
    said = {"is_explicitly_empty": F.lit("false"), "source": F.lit("extract")}
    asked = lambda a: courses.select(bare.alias("code"), F.explode(a).alias("t")).select("code", tx.strip_bs("t").alias("t"))
    known = members.select("ma_ctdt").distinct() if programmes is None else programmes.select("ma_ctdt", *(optional(programmes, p).alias(p) for p in ("ten_ctdt", "bac_dao_tao", "phien_ban")))
    out_nodes = [
        nodes("HocPhan", c, "code", ["_bs", "_name"]), nodes("HocPhan", stray, "code"), nodes("MucTieuHocPhan", goals.drop("code"), "id"), nodes("CLO", outs.drop("code"), "id"), nodes("Bai", less.drop("code", "dap_ung_cdr"), "id"),
        nodes("ChuongTrinhDaoTao", known, "ma_ctdt"), nodes("NhomHocPhan", m.drop("ma_ctdt", "code"), "group_id"),
    ]
    out_edges = [
        edges("HAS_COURSE", m, F.col("ma_ctdt"), F.col("code")), edges("BELONGS_TO", m, F.col("code"), F.col("group_id")), edges("HAS_OBJECTIVE", goals, F.col("code"), F.col("id")), edges("HAS_CLO", outs, F.col("code"), F.col("id")),
        edges("HAS_LESSON", less, F.col("code"), F.col("id")), edges("SUPPORTS_CLO", less.select("id", "code", F.explode("dap_ung_cdr").alias("clo")), F.col("id"), F.concat_ws("_", "code", "clo")),
        edges("PREREQUISITE", asked("prerequisites"), F.col("code"), F.col("t"), said), edges("PREVIOUS_COURSE", asked("previous"), F.col("code"), F.col("t"), said),
    ]
    return union(out_nodes), union(out_edges)


def taxonomy(skills: DataFrame, occupations: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label lists (``altLabels``, ``hiddenLabels``, a label a line) are joined by ``;``; so are schemes (``inScheme``), which have commas at their ends."""
    listed = {"altLabels": False, "hiddenLabels": False, "inScheme": True}
    for c, comma in listed.items():
        if c in skills.columns:
            skills = skills.withColumn(c, tx.csv_value(tx.lines_list(c, strip_comma=comma), "array"))
    a = nodes("KyNangESCO", skills, "conceptUri")
    b = nodes("NgheNghiepESCO", occupations, "conceptUri")
    return a.unionByName(b), edges("REQUIRES_SKILL", relations, F.col("occupationUri"), F.col("skillUri"), {"importance_type": F.col("relationType")})


def mapping(records: DataFrame, tags: DataFrame, tag_edges: DataFrame, role: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of linked records. Only accepted records with a uri give skill edges; evidence edges aren't filtered.

    ``records(course_code, uri, decision, concept_type)`` and, where there, ``cross_encoder_score`` (else ``final_score``), ``confidence``,
    ``llm_reasoning`` and ``support_concept_origin`` (concepts at ``;``), which stands in for a reasoning that is missing.
    """
    verb = "TEACHES" if role == "teach" else "SUPPORTS"
    good = records.where(F.lower("decision").contains("accept") & (F.coalesce(F.col("uri").cast("string"), F.lit("")) != ""))
    origin = optional(records, "support_concept_origin")
    given = optional(records, "llm_reasoning")
    derived = (given == "") & F.lit("support_concept_origin" in records.columns)
    good = good.select(
        tx.strip_bs("course_code").alias("code"), "uri", "concept_type", optional(records, "cross_encoder_score", "final_score").alias("retrieval_score"), optional(records, "confidence").alias("validation_confidence"),
        F.when(derived, tx.csv_value(tx.split_list(origin, ";"), "array")).otherwise(optional(records, "matched_mentions")).alias("matched_mentions"),
        F.when(derived, F.concat(F.lit("Derived from concept tags: "), origin)).otherwise(given).alias("llm_reasoning"),
    )
    props = {c: F.col(c) for c in ("retrieval_score", "validation_confidence", "matched_mentions", "llm_reasoning")}
    link = lambda kind: edges(f"{verb}_{kind.upper()}", good.where(F.col("concept_type") == kind), F.col("code"), F.col("uri"), props)
    out = [
        link("skill"), link("knowledge"), edges("HAS_CONCEPT", tags, tx.strip_bs(F.col("course_code").cast("string")), F.col("normalized"), {"role": F.lit(role)}),
        edges("EVIDENCE_FOR", tag_edges, F.col("normalized"), F.col("uri"), {"confidence": F.col("confidence"), "pipeline_source": F.lit("teaches_B" if role == "teach" else "supports_M5")}),
    ]
    kind = F.nullif(F.nullif(optional(tags, "loai"), F.lit("")), F.lit("unknown"))
    named = tags.where("normalized <> ''").select("normalized", "text", F.coalesce(kind, F.lit("direct_extraction" if role == "teach" else "reasoned")).alias("loai"))
    return nodes("ConceptTag", named, "normalized"), union(out)


def edge_columns(df: DataFrame) -> list[str]:
    """The sorted property names of an edge table (the one small driver action of an export)."""
    return [r[0] for r in df.select(F.explode(F.map_keys("properties")).alias("k")).distinct().orderBy("k").collect()]


def widen(df: DataFrame) -> DataFrame:
    """Properties as columns, for writing."""
    return df.select("source_id", "target_id", "type", *(tx.csv_value(F.col("properties")[k]).alias(k) for k in edge_columns(df)))


def missing_links(members: DataFrame, courses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Courses that programmes name but no contract holds: distinct codes, and their programme links."""
    gone = members.select("ma_ctdt", tx.strip_bs("code").alias("code")).join(courses.select(tx.strip_bs("code").alias("code")).distinct(), "code", "left_anti").distinct()
    return gone.select("code").distinct(), gone


def cypher(df: DataFrame, relation: str = "SUPPORTS_SKILL") -> Column:
    """A merge statement: ``course_code, uri, concept, evidence_text, score, status, method``."""
    q = lambda c: F.concat(F.lit("'"), tx.cypher_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("'"))
    raw = lambda c: F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'"))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("MATCH (c:Course {course_id: "), raw("course_code"), F.lit("})")),
        F.concat(F.lit("MATCH (s:Skill {uri: "), raw("uri"), F.lit("})")),
        F.lit(f"MERGE (c)-[r:{relation}]->(s)"),
        F.concat(F.lit("SET r.support_concept = "), q("concept"), F.lit(",")),
        F.concat(F.lit("    r.evidence_text = "), q("evidence_text"), F.lit(",")),
        F.concat(F.lit("    r.final_score = "), F.format_string("%.4f", F.col("score").cast("double")), F.lit(",")),
        F.concat(F.lit("    r.review_status = "), raw("status"), F.lit(",")),
        F.concat(F.lit("    r.method = "), raw("method"), F.lit(",")),
        F.lit("    r.created_at = timestamp();"),
    )
