"""Programmes and entities: flatten, normalise, translate, assemble, materialise."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom import config
from taxoloom.functions import text as tx
from taxoloom.functions import unicode as un
from taxoloom.operators.ranking import global_batches, keep_first, suffix_duplicates


def group_ids(groups: DataFrame) -> DataFrame:
    """``groups(ma_ctdt, pos, ten_nhom)`` -> section, base name, credits, and a group id that is unique in its programme.

    Credits that a group declares (``so_tin_chi_yeu_cau``) come before those in its name. A sub-code that is no identifier becomes a slug.
    """
    parsed = groups.withColumn("_p", tx.parse_group_name("ten_nhom")).select("*", "_p.*").drop("_p")
    parsed = parsed.withColumn("sub", F.when(F.col("sub").rlike("^[A-Z0-9_]+$"), F.col("sub")).otherwise(un.slug_upper(F.col("sub"))))
    if "so_tin_chi_yeu_cau" in groups.columns:
        parsed = parsed.withColumn("credits", F.coalesce("so_tin_chi_yeu_cau", "credits")).drop("so_tin_chi_yeu_cau")
    raw = F.concat_ws("_", F.replace(F.col("section"), F.lit("."), F.lit("_")), F.nullif(F.col("sub"), F.lit("")))
    return suffix_duplicates(parsed.withColumn("raw_id", raw), ["ma_ctdt"], "raw_id", ["pos"], "nhom_id")


def fields(df: DataFrame, column: str) -> list[str]:
    """Names of the fields of an array of structs."""
    return df.schema[column].dataType.elementType.fieldNames()


def flatten(programmes: DataFrame) -> dict[str, DataFrame]:
    """Nested programmes -> ``header``, ``sections``, ``groups``, ``courses``, ``relations``.

    ``programmes(ma_ctdt, nhom_hoc_phan array<struct<ten_nhom, loai_nhom, [so_tin_chi_yeu_cau], hoc_phan array<struct<ma_hoc_phan, ten_hoc_phan,
    so_tin_chi_tong, [hoc_ky_goi_y], quan_he array<struct<loai, ma_hoc_phan>>>>>>, [chuong_trinh_dao_tao struct<ten_ctdt, bac_dao_tao, phien_ban>],
    [source_file])``. A section has the name and credits of its first group. A relation's name is looked up in its own programme.
    """
    own = fields(programmes, "nhom_hoc_phan")
    declared = ["g.so_tin_chi_yeu_cau"] if "so_tin_chi_yeu_cau" in own else []
    g = programmes.select("ma_ctdt", F.posexplode("nhom_hoc_phan").alias("pos", "g")).select("ma_ctdt", "pos", "g.ten_nhom", "g.loai_nhom", *declared, "g.hoc_phan")
    groups = group_ids(g)
    kept = ["ma_ctdt", "nhom_id", F.col("section").alias("ma_phan"), "loai_nhom", F.col("pos").alias("group_pos")]
    courses = groups.select(*kept, F.posexplode("hoc_phan").alias("pos", "c")).select("ma_ctdt", "nhom_id", "ma_phan", "loai_nhom", "group_pos", "pos", "c.*")
    if "hoc_ky_goi_y" not in courses.columns:
        courses = courses.withColumn("hoc_ky_goi_y", F.lit(None).cast("string"))
    courses = courses.withColumn("so_quan_he", F.coalesce(F.size("quan_he"), F.lit(0)))
    sections = groups.groupBy("ma_ctdt", "section").agg(
        F.min_by("base", "pos").alias("base"), F.min_by("credits", "pos").alias("credits"), F.count("*").alias("n_groups"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "nhom_id"))), lambda x: x["nhom_id"]).alias("nhom_ids"),
    )
    rel = courses.select("ma_ctdt", "nhom_id", "ma_hoc_phan", "ten_hoc_phan", F.posexplode("quan_he").alias("rel_pos", "r")).select("ma_ctdt", "nhom_id", "ma_hoc_phan", "ten_hoc_phan", "rel_pos", "r.loai", F.col("r.ma_hoc_phan").alias("target"))
    names = courses.select("ma_ctdt", "ma_hoc_phan", "ten_hoc_phan", F.struct("group_pos", "pos").alias("at"))
    info = [f"chuong_trinh_dao_tao.{c}" if "chuong_trinh_dao_tao" in programmes.columns else F.lit(None).cast("string").alias(c) for c in ("ten_ctdt", "bac_dao_tao", "phien_ban")]
    header = programmes.select("ma_ctdt", *info, F.col("source_file") if "source_file" in programmes.columns else F.lit(None).cast("string").alias("source_file"))
    return {"header": header, "sections": sections, "groups": groups.drop("hoc_phan"), "courses": courses.drop("quan_he"), "relations": backfill(rel, names, ["ma_ctdt"])}


def backfill(relations: DataFrame, names: DataFrame, scope: list[str]) -> DataFrame:
    """``relations(*scope, target)``, ``names(*scope, ma_hoc_phan, ten_hoc_phan, at)`` -> the name of the last occurrence, and
    whether it was found (``same_ctdt`` or ``not_found``)."""
    last = names.groupBy(*scope, F.col("ma_hoc_phan").alias("target")).agg(F.max_by("ten_hoc_phan", "at").alias("target_name"), F.lit(True).alias("_hit"))
    return relations.join(last, [*scope, "target"], "left").withColumn("resolution", F.when(F.col("_hit"), "same_ctdt").otherwise("not_found")).drop("_hit")


def memberships(programmes: DataFrame) -> DataFrame:
    """Course memberships from ``hoc_phan_flat`` if there is one, else from the nested groups (four fields kept)."""
    nested = F.flatten(F.transform("nhom_hoc_phan", lambda g: F.transform(g["hoc_phan"], lambda c: F.struct(c["ma_hoc_phan"].alias("ma_hoc_phan"), g["nhom_id"].alias("nhom_id"), g["loai_nhom"].alias("loai_nhom")))))
    flat = F.coalesce(F.when(F.size("hoc_phan_flat") > 0, F.col("hoc_phan_flat")), nested)
    return programmes.select("ma_ctdt", F.explode(flat).alias("c")).select("ma_ctdt", "c.*")


def id_reject(file_code: Column, declared: Column, source_code: Column) -> Column:
    """Why a record is turned away: its codes differ, or aren't two capitals and four digits. Null: it is fine."""
    return (
        F.when(~file_code.eqNullSafe(declared), "file_code_mismatch")
        .when(source_code.isNotNull() & (source_code != declared), "source_code_mismatch")
        .when(~F.coalesce(declared, F.lit("")).rlike("^[A-Z]{2}[0-9]{4}$"), "bad_code_format")
    )


def entities(records: DataFrame) -> DataFrame:
    """``records(code, source_file, content_hash, course struct, lessons array<struct<title,...>>, outcomes array, objectives array)`` ->
    ``(entity_id, entity_type, code, source_file, source_hash, data)``; lessons keep the first of each title."""
    first = F.filter("lessons", lambda x, i: F.forall(F.slice(F.col("lessons"), F.lit(1), i), lambda y: F.lower(F.trim(y["title"])) != F.lower(F.trim(x["title"]))))
    parts = F.array(
        *(F.struct(F.lit(k).alias("entity_type"), F.to_json(v).alias("data"), n.alias("n")) for k, v, n in (
            ("hoc_phan", F.col("course"), F.lit(1)), ("bai_hoc", first, F.size(first)), ("clo", F.col("outcomes"), F.size("outcomes")), ("muc_tieu", F.col("objectives"), F.size("objectives")),
        ))
    )
    rows = records.select("code", "source_file", F.coalesce("content_hash", F.md5(F.to_json("course"))).alias("source_hash"), F.explode(parts).alias("e"))
    return rows.where("e.n > 0").select(F.concat_ws(":", "code", "e.entity_type").alias("entity_id"), "e.entity_type", "code", "source_file", "source_hash", "e.data", "e.n")


def id_summary(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """Per group: how many rows and distinct keys, and whether each key occurs once."""
    each = df.groupBy(*by, key).agg(F.count("*").alias("n"))
    return each.groupBy(*by).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.bool_and(F.col("n") == 1).alias("is_unique"))


def replace_source(existing: DataFrame, rebuilt: DataFrame, source: str = "source_file") -> DataFrame:
    """Rows of the sources that were rebuilt give way to the new ones."""
    return existing.join(rebuilt.select(source).distinct(), source, "left_anti").unionByName(rebuilt.select(*existing.columns))


def zip_inner(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Pairs of items at the same place; the longer list's tail goes."""
    x = left.select(key, F.posexplode(a).alias("pos", "vi"))
    y = right.select(key, F.posexplode(b).alias("pos", "en"))
    return x.join(y, [key, "pos"])


def zip_left(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """As :func:`zip_inner`, but every left item stays."""
    x = left.select(key, F.posexplode(a).alias("pos", "vi"))
    y = right.select(key, F.posexplode(b).alias("pos", "en"))
    return x.join(y, [key, "pos"], "left")


def unique_strings(df: DataFrame, arrays: list[str], scalars: list[str]) -> DataFrame:
    """Distinct non-blank strings of several paths in one pass."""
    every = F.concat(F.array(*(F.col(c) for c in scalars)) if scalars else F.array().cast("array<string>"), *(F.coalesce(F.col(a), F.array().cast("array<string>")) for a in arrays))
    return df.select(F.explode(every).alias("vi")).select(F.trim("vi").alias("vi")).where("vi <> ''").distinct()


def missing_strings(strings: DataFrame, dictionary: DataFrame, size: int = 200) -> DataFrame:
    """Strings without a translation, in order, in numbered chunks."""
    return global_batches(strings.join(dictionary.select("vi"), "vi", "left_anti"), ["vi"], size, "chunk")


def apply_dictionary(df: DataFrame, dictionary: DataFrame, columns: list[str], suffix: str = "_en") -> DataFrame:
    """Looks each column up, trimmed; without an entry: null. Repeated entries of one string count once."""
    one = dictionary.groupBy("vi").agg(F.min("en").alias("en"))
    for c in columns:
        d = one.select(F.col("vi").alias("_vi"), F.col("en").alias(f"{c}{suffix}"))
        df = df.join(d, F.trim(F.col(c)) == F.col("_vi"), "left").drop("_vi")
    return df


def fill_if_empty(c: Column, other: Column) -> Column:
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", other).otherwise(c)


def assemble(rows: DataFrame, code: str, kind: str, data: str, order: str, kinds: list[str]) -> DataFrame:
    """One row a course, with a list for each entity type in order."""
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == k, F.struct(F.col(order).alias("o"), F.col(data).alias("d"))))), lambda x: x["d"])
    return rows.groupBy(code).agg(*(pick(k).alias(k) for k in kinds))


def overlay(base: DataFrame, over: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``over`` replace those of ``base`` with the same key; keys of either stay."""
    tagged = base.withColumn("_p", F.lit(1)).unionByName(over.withColumn("_p", F.lit(0)))
    return keep_first(tagged, key, ["_p"]).drop("_p")


def resolve(wanted: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` from the first table, else from the second (``fallback``), else none (``unresolved``)."""
    a, b = (t.select(key, F.col(value).alias(n)) for t, n in ((first, "_a"), (second, "_b")))
    out = wanted.join(a, key, "left").join(b, key, "left")
    status = F.when(F.col("_a").isNotNull(), "resolved").when(F.col("_b").isNotNull(), "fallback").otherwise("unresolved")
    return out.withColumn(value, F.coalesce("_a", "_b")).withColumn("status", status).drop("_a", "_b")


def resolution_summary(resolved: DataFrame, by: list[str]) -> DataFrame:
    return resolved.groupBy(*by).agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("resolved", "fallback", "unresolved")), F.count("*").alias("n_all"))


def membership_lists(members: DataFrame) -> DataFrame:
    """All memberships of a course as a sorted list (the older flow kept the last programme's only)."""
    return members.groupBy("ma_hoc_phan").agg(F.array_sort(F.collect_set(F.struct("ma_ctdt", "nhom_id", "loai_nhom"))).alias("ctdt_memberships"))


def impute(df: DataFrame, fields: list[str], prompt: Column, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Fills the empty ones of ``fields`` (texts) from a model's JSON answers; what is there stays, and what has no usable answer.

    ``ask`` adds ``answer`` to rows with ``prompt``; only rows that lack a field are asked about.
    """
    lacks = reduce(lambda a, b: a | b, (F.trim(F.coalesce(F.col(f), F.lit(""))) == "" for f in fields))
    asked = ask(df.where(lacks).withColumn("prompt", prompt))
    said = tx.parse_json_answer("answer", ", ".join(f"`{f}` string" for f in fields))
    filled = asked.withColumn("_said", said)
    for f in fields:
        filled = filled.withColumn(f, F.coalesce(fill_if_empty(F.col(f), F.col("_said")[f]), F.col(f)))
    return df.where(~lacks).unionByName(filled.select(*df.columns))


def export_codes(resolved: DataFrame, strict: bool = False) -> DataFrame:
    """Contract codes: a course from the fallback source gets ``_BS``; ``conflict`` marks codes with more than one payload. ``strict``: such
    a code is an error when its row is read."""
    out = resolved.withColumn("export_code", F.when(F.col("status") == "fallback", tx.add_bs("ma_hoc_phan")).otherwise(F.col("ma_hoc_phan")))
    found = out.where("status <> 'unresolved'").groupBy("export_code").agg(F.count_distinct("payload").alias("k")).select("export_code", (F.col("k") > 1).alias("conflict"))
    out = out.join(found, "export_code", "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))
    if not strict:
        return out
    stop = F.raise_error(F.concat(F.lit("Conflicting course data for contract code "), "export_code")).cast("boolean")
    return out.withColumn("conflict", F.when(F.col("conflict"), stop).otherwise(F.lit(False)))


def missing_report(missing: DataFrame, by: str, item: str, name: str) -> DataFrame:
    """Lines of a markdown report for each programme: a heading with the count, then a table, or a sentence if nothing is missing.

    ``missing`` has a row with a null ``item`` for a programme that misses nothing.
    """
    rows = F.array_sort(F.collect_list(F.when(F.col(item).isNotNull(), F.concat(F.lit("| "), F.col(item).cast("string"), F.lit(" | "), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(" |")))))
    body = F.when(F.size(rows) == 0, F.lit("No missing courses.")).otherwise(F.concat_ws("\n", F.lit("| Code | Name |"), F.lit("| --- | --- |"), F.array_join(rows, "\n")))
    return missing.groupBy(by).agg(F.concat_ws("\n", F.concat(F.lit("# "), F.first(F.col(by)).cast("string")), F.concat(F.lit("Missing: "), F.size(rows).cast("string")), F.lit(""), body).alias("report"))


def translate_enums(df: DataFrame, kind: str = "loai_nhom", relation: str | None = None) -> DataFrame:
    df = df.withColumn(f"{kind}_en", tx.map_values(kind, config.GROUP_KIND))
    return df if relation is None else df.withColumn(f"{relation}_en", tx.map_values(relation, config.RELATION_KIND))
