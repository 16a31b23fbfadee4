"""Writers. Tables are written by executors; small manifests and reports come as one file."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import text as tx
from taxoloom.operators import graph


def nested_json(df: DataFrame, path: str, by: str) -> None:
    """One nested dataset, a folder a course: the canonical form of per-record files."""
    df.repartition(by).write.mode("overwrite").partitionBy(by).json(path)


def keyed_records(df: DataFrame, label: str, kind: str) -> DataFrame:
    """File names ``{type}__{slug}.json`` and payloads; a later uri with the same slug wins."""
    named = df.withColumn("file", F.concat(F.col(kind), F.lit("__"), tx.safe_label(label), F.lit(".json")))
    return named.groupBy("course_code", "file").agg(F.max_by(F.to_json(F.struct(*df.columns)), "uri").alias("payload"))


def text_lines(df: DataFrame, line: Column, path: str, order: list[str], by: str | None = None) -> None:
    """Text in order; ``by`` gives a folder a value."""
    out = df.select(line.alias("value"), *([by] if by else []), *(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)))
    keys = [f"_o{i}" for i in range(len(order))]
    if by:
        out.repartition(by).sortWithinPartitions(by, *keys).drop(*keys).write.mode("overwrite").partitionBy(by).text(path)
    else:
        out.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys).write.mode("overwrite").text(path)


def csv(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False) -> None:
    """CSV without duplicates, sorted. ``single``: one file, for tables known to be small."""
    df = df.dropDuplicates()
    df = df.orderBy(*order) if order else df
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').option("emptyValue", "").csv(path)


def node_csv(df: DataFrame, path: str) -> None:
    """A node table as graph import files want it."""
    kinds = dict(df.dtypes)
    df.select(*(tx.csv_value(c, "array" if kinds[c].startswith("array") else "string").alias(c) for c in df.columns)).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def edge_csv(df: DataFrame, path: str) -> None:
    graph.widen(df).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def tables(named: dict[str, DataFrame], path: str, form: str = "csv") -> None:
    for name, df in named.items():
        w = df.write.mode("overwrite")
        (w.option("header", True).csv if form == "csv" else w.json)(f"{path}/{name}")


def per_key(df: DataFrame, key: str, path: str) -> None:
    """A folder a key."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).json(path)


def manifest(spark: SparkSession, named: dict[str, str], path: str) -> dict:
    """Rows, files and SHA-256 of what was written, counted by executors; the manifest itself is one small file."""
    out = {}
    for name, at in named.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(at)
        hashes = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("f"), F.sha2("content", 256).alias("h"))
        out[name] = {"files": hashes.count(), "sha256": hashes.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256)).first()[0]}
    spark.createDataFrame([(json.dumps(out, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return out


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def contract_files(courses: DataFrame, lessons: DataFrame, outcomes: DataFrame, objectives: DataFrame, path: str) -> None:
    """The four tables of contracts, each course's records with their hash; lesson titles lose their numbering."""
    lessons = lessons.withColumn("ten_bai", tx.strip_lesson_prefix("ten_bai")).withColumn("ten_bai_en", tx.strip_lesson_prefix("ten_bai_en"))
    courses.withColumn("source_hash", tx.content_hash(*courses.columns)).write.mode("overwrite").partitionBy("code").json(f"{path}/hoc_phan")
    for name, df in (("bai_hoc", lessons), ("clo", outcomes), ("muc_tieu", objectives)):
        rows = df.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("pos", *(c for c in df.columns if c not in ("code", "pos"))))).alias("records"))
        rows.withColumn("source_hash", F.md5(F.to_json("records"))).write.mode("overwrite").partitionBy("code").json(f"{path}/{name}")
