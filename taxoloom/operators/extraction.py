"""Course records out of grounded extractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions import text as tx

#: The classes of objectives.
OBJECTIVES = ("KIEN_THUC", "KY_NANG", "TU_CHU_TRACH_NHIEM")


def syllabi(extractions: DataFrame, sources: DataFrame) -> DataFrame:
    """A record a source: ``(source_file, ma_hoc_phan, source_course_code, hoc_phan, muc_tieu_hoc_phan, clo, bai_hoc)``.

    ``extractions(source_file, pos, extraction_class, extraction_text, char_start, char_end, attributes map<string,string>)``;
    ``sources(source_file, ma_hoc_phan, ten_vi, ten_en)`` holds what the source's own table says, a row a source. Extractions without a
    place in the source are left out; the last course wins; lists keep the order of ``pos``, and are null where empty. The source's
    code comes before the model's, the model's names before the source's; without a code it is the file's name up to ``_``. A source
    without any extraction has no record.
    """
    raw = lambda k: F.col("attributes")[k]
    said = lambda k: tx.clean_str(raw(k)).alias(k)
    text = lambda k: F.coalesce(tx.clean_str(raw(k)), F.col("extraction_text")).alias(k)
    parts = lambda k: tx.split_list(raw(k)).alias(k)
    kind = tx.clean_str(raw("loai_muc_tieu"))
    course = F.struct(said("ma_hoc_phan"), said("ten_vi"), said("ten_en"), tx.safe_float(tx.clean_str(raw("so_tin_chi_tong"))).alias("so_tin_chi_tong"), said("mo_ta_tom_tat"))
    placed = F.col("char_start").isNotNull() & F.col("char_end").isNotNull()
    of = lambda k: placed & (F.col("extraction_class") == k)
    found = extractions.groupBy("source_file").agg(
        F.max_by(F.when(of("hoc_phan"), course), F.when(of("hoc_phan"), F.col("pos"))).alias("h"),
        listed(of("muc_tieu"), said("ma_muc_tieu"), F.when(kind.isin(*OBJECTIVES), kind).alias("loai_muc_tieu"), text("noi_dung"), parts("so_ctdt")).alias("muc_tieu_hoc_phan"),
        listed(of("clo"), said("ma_cdr_goc"), text("noi_dung"), parts("pi_so"), said("muc_do")).alias("clo"),
        listed(of("bai_hoc"), said("so_thu_tu"), text("ten_bai"), said("noi_dung_tom_tat"), parts("ma_clo")).alias("bai_hoc"),
    )
    own = lambda c: tx.clean_str(f"o.{c}")
    out = found.alias("f").join(sources.select("source_file", "ma_hoc_phan", "ten_vi", "ten_en").alias("o"), "source_file", "left")
    code = F.coalesce(own("ma_hoc_phan"), "h.ma_hoc_phan", F.split_part(F.col("source_file").cast("string"), F.lit("_"), F.lit(1)))
    whole = F.struct(code.alias("ma_hoc_phan"), *(F.coalesce(f"h.{c}", own(c)).alias(c) for c in ("ten_vi", "ten_en")), F.col("h.so_tin_chi_tong").alias("so_tin_chi_tong"), F.col("h.mo_ta_tom_tat").alias("mo_ta_tom_tat"))
    return out.select("source_file", code.alias("ma_hoc_phan"), own("ma_hoc_phan").alias("source_course_code"), whole.alias("hoc_phan"), "muc_tieu_hoc_phan", "clo", "bai_hoc")


def listed(condition: Column, *parts: Column) -> Column:
    """Aggregate: structs of the rows that meet the condition, in the order of ``pos``; null where there is none."""
    rows = F.array_sort(F.collect_list(F.when(condition, F.struct("pos", F.struct(*parts).alias("v")))))
    return F.when(F.size(rows) > 0, F.transform(rows, lambda x: x["v"]))
