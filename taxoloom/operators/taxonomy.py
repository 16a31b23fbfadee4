"""Subsets of an occupation-skill taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators.ranking import keep_first


def subset(codes: DataFrame, occupations: DataFrame, relations: DataFrame, skills: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chained semi joins: the occupations of ``codes(code)``, their relations, and those relations' skills."""
    occ = occupations.join(codes.select("code").distinct(), "code", "left_semi")
    rel = relations.join(occ.select(F.col("conceptUri").alias("occupationUri")), "occupationUri", "left_semi")
    return occ, rel, skills.join(rel.select(F.col("skillUri").alias("conceptUri")).distinct(), "conceptUri", "left_semi")


def with_roles(occupations: DataFrame, roles: DataFrame) -> DataFrame:
    """The first role of each code; occupations without one stay."""
    return occupations.join(keep_first(roles.select("code", "role"), ["code"], ["role"]), "code", "left")


def matched(codes: DataFrame, occupations: DataFrame) -> DataFrame:
    """Whether each asked code is in the taxonomy."""
    have = occupations.select("code").distinct().withColumn("_hit", F.lit(True))
    return codes.join(have, "code", "left").withColumn("matched_in_esco", F.col("_hit").isNotNull()).drop("_hit")


def relation_pivot(relations: DataFrame, by: list[str], kinds: tuple[str, ...] = ("essential", "optional")) -> DataFrame:
    """Counts by relation type, 0 where none, and their total; null groups go."""
    rows = relations
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    wide = rows.groupBy(*by).pivot("relationType", list(kinds)).count().fillna(0, list(kinds))
    return wide.withColumn("total", sum((F.col(k) for k in kinds), F.lit(0)))


def relation_priority(relations: DataFrame, by: list[str], strong: str = "essential", weak: str = "optional") -> DataFrame:
    """One row a group: ``strong`` if any relation is, else ``weak``; the first skill type."""
    return relations.groupBy(*by).agg(
        F.when(F.bool_or(F.col("relationType") == strong), strong).otherwise(weak).alias("relationType"),
        F.min("skillType").alias("skillType"),
    )


def merge_occupations(groups: DataFrame, occupations: DataFrame, first: list[str], joined: list[str], legacy: bool = False) -> DataFrame:
    """``groups(code_list, label)`` -> one occupation for each comma list of codes.

    ``first`` columns take the first non-null value by code; ``joined`` ones join the non-blank values by `` | ``. The domain
    label asks that all codes are in the domain (``legacy``: that the list's text begins so).
    """
    codes = groups.withColumn("codes", tx.split_list("code_list"))
    rows = codes.select("code_list", "label", F.explode("codes").alias("code")).join(occupations, "code")
    agg = [F.min_by(c, F.struct(F.col(c).isNull(), F.col("code"))).alias(c) for c in first]
    agg += [F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.struct(F.col("code").alias("k"), F.trim(c).alias("v"))))), lambda x: x["v"]), " | ").alias(c) for c in joined]
    out = rows.groupBy("code_list", "label").agg(F.array_sort(F.collect_set("code")).alias("codes"), *agg)
    domain = F.col("code_list").rlike("^(13|25|35)") if legacy else tx.in_domain("codes")
    return out.withColumn("conceptUri", tx.custom_uri("code_list")).withColumn("domain", F.when(domain, "in_domain").otherwise("out_of_domain"))


def label_domains(relations: DataFrame, occupations: DataFrame) -> DataFrame:
    """Skills with the set of their occupations' codes, and whether all are in the domain."""
    sets = relations.join(occupations.select(F.col("conceptUri").alias("occupationUri"), "code"), "occupationUri").groupBy("skillUri").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return sets.withColumn("domain", F.when(tx.in_domain("codes"), "in_domain").otherwise("out_of_domain"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent."""
    return child.select(F.col(key).alias("k")).where("k is not null").distinct().join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def check_keys(tables: dict[str, DataFrame], primary: dict[str, list[str]], foreign: list[tuple[str, str, str, str]]) -> DataFrame:
    """A row a check: its name and the number of violations."""
    parts = [repeated_keys(tables[t], k).agg(F.count("*").alias("violations")).select(F.lit(f"pk:{t}").alias("check"), "violations") for t, k in primary.items()]
    parts += [orphans(tables[c], k, tables[p], pk).agg(F.count("*").alias("violations")).select(F.lit(f"fk:{c}.{k}").alias("check"), "violations") for c, k, p, pk in foreign]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
