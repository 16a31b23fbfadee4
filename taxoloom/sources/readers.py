"""Readers: course contracts, CSV tables, programme markdown, saved HTML, reviews and histories."""

from __future__ import annotations

import email
import email.policy
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from taxoloom import schemas
from taxoloom.functions import text as tx
from taxoloom.operators.ranking import keep_first
from taxoloom.operators.records import REVIEW


def whole_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, content)`` of text files, whole."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def unwrap(content: Column, schema: str) -> Column:
    """An object, an array, or an object with ``records`` -> array of rows. Rows of a wrapper take its ``source_hash``. Null where it is neither."""
    s = F.trim(content)
    wrapper = F.from_json(s, f"records array<struct<{struct_of(schema)}>>, source_hash string")
    listed = F.from_json(s, f"array<struct<{struct_of(schema)}>>")
    single = F.from_json(s, schema)
    names = [f.name for f in T.StructType.fromDDL(schema)]
    hashed = F.transform(wrapper["records"], lambda r: F.struct(*((F.coalesce(r[n], wrapper["source_hash"]) if n == "source_hash" else r[n]).alias(n) for n in names)))
    # What isn't JSON would come as a row of nulls.
    return F.when(F.try_parse_json(s).isNull(), F.lit(None)).when(s.startswith("["), listed).when(wrapper["records"].isNotNull(), hashed).when(s.startswith("{"), F.array(single))


def struct_of(schema: str) -> str:
    return T.StructType.fromDDL(schema).simpleString()[len("struct<") : -1]


def contract_table(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """One of a contract's four tables ``(code, pos, ...)``, over all courses below ``root``.

    A file is ``<code>/<code>__<kind>.json``; folders that begin with ``_`` are left out; files that don't parse give no rows here, and
    are named by :func:`unreadable`.
    """
    schema = schemas.CONTRACT[kind]
    files = whole_files(spark, root, f"*__{kind}.json")
    code = F.regexp_extract("path", r"([^/]+)__[a-z_]+\.json$", 1)
    rows = files.select(code.alias("code"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), unwrap(F.col("content"), schema).alias("r")).where(~F.col("folder").startswith("_"))
    return rows.select("code", F.posexplode("r").alias("pos", "r")).select("code", (F.col("pos") + 1).alias("pos"), "r.*")


def unreadable(spark: SparkSession, root: str) -> DataFrame:
    """``(code, kind, path)`` of contract files that aren't JSON of one of the known forms."""
    parts = []
    for kind, schema in schemas.CONTRACT.items():
        files = whole_files(spark, root, f"*__{kind}.json").where(unwrap(F.col("content"), schema).isNull())
        parts.append(files.select(F.regexp_extract("path", r"([^/]+)__[a-z_]+\.json$", 1).alias("code"), F.lit(kind).alias("kind"), "path"))
    return reduce(DataFrame.unionByName, parts)


def contracts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four tables of the courses that have all four files; ``incomplete`` names what the others lack."""
    files = whole_files(spark, root, "*__*.json").select(F.regexp_extract("path", r"([^/]+)__[a-z_]+\.json$", 1).alias("code"), F.regexp_extract("path", r"__([a-z_]+)\.json$", 1).alias("kind"))
    kinds = files.groupBy("code").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    lacking = kinds.withColumn("missing", F.array_except(F.array(*(F.lit(k) for k in schemas.CONTRACT)), "kinds"))
    whole = lacking.where(F.size("missing") == 0).select("code")
    out = {k: contract_table(spark, root, k).join(whole, "code", "left_semi") for k in schemas.CONTRACT}
    return out | {"incomplete": lacking.where(F.size("missing") > 0).select("code", "missing"), "unreadable": unreadable(spark, root)}


def merged_courses(spark: SparkSession, root: str) -> DataFrame:
    """``(code, kind, payload)`` from ``hoc_phan/<code>/``, else ``<code>/``, else ``<code>.json`` (kind ``course``): the first place that has one."""
    files = whole_files(spark, root, "*.json")
    name = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    kind = F.when(name.contains("__"), F.regexp_extract(name, "__(.+)$", 1)).otherwise("course")
    place = F.when(F.col("path").rlike("/hoc_phan/[^/]+/[^/]+$"), 0).when(name.contains("__"), 1).otherwise(2)
    rows = files.select(F.regexp_extract(name, "^(.+?)(?:__.*)?$", 1).alias("code"), kind.alias("kind"), place.alias("place"), F.col("content").alias("payload"))
    best = rows.groupBy("code").agg(F.min("place").alias("place"))
    return rows.join(best, ["code", "place"]).select("code", "kind", "payload")


def course_codes(spark: SparkSession, root: str) -> DataFrame:
    files = whole_files(spark, root, "*.json").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("code"))
    return files.where(~F.col("code").startswith("_")).distinct()


def string_csv(spark: SparkSession, path: str, columns: tuple[str, ...], required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with a header, all strings, trimmed, empty fields as empty text. ``columns`` are pruned at the scan;
    a file without one of ``required`` is an error."""
    head = spark.read.option("header", True).csv(path).columns
    have = [c.strip() for c in head]
    if lost := [c for c in required if c not in have]:
        raise ValueError(f"{path}: no column {', '.join(lost)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in have])
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').option("nullValue", "\0").option("emptyValue", "").csv(path)
    return df.select(*(F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in columns if c in have))


def programme_rows(files: DataFrame) -> DataFrame:
    """``files(path, content)`` of programme markdown -> a row a course of a pipe table.

    ``(ma_ctdt, ten_nhom, loai_nhom, credits_required, line_no, ma_hoc_phan, ten_hoc_phan, so_tin_chi, hoc_ky, tien_quyet, hoc_truoc)``.
    Rows follow a ``| STT`` heading and a ruler, until a line that doesn't begin with a pipe. The section is the last ``##``
    heading and the last ``###`` since; numbers that don't parse are null.
    """
    meta = lambda tag: F.nullif(F.trim(F.regexp_extract("content", rf"- \*\*{tag}:\*\*([^\n]*)", 1)), F.lit(""))
    code = F.coalesce(meta("Mã ngành"), F.nullif(F.regexp_extract("path", r"CTDT_(\w+)", 1), F.lit("")))
    lines = files.select("path", code.alias("ma_ctdt"), F.posexplode(F.split("content", "\n")).alias("line_no", "raw")).where("ma_ctdt is not null").withColumn("line", F.trim("raw"))
    w = Window.partitionBy("path").orderBy("line_no")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    h2 = F.when(F.col("line").startswith("## "), F.trim(F.substr("line", F.lit(4))))
    # A second-level heading clears the third level.
    h3 = F.when(F.col("line").startswith("## "), F.lit("")).when(F.col("line").startswith("### "), F.trim(F.substr("line", F.lit(5))))
    lines = lines.withColumn("h2", F.coalesce(F.last(h2, True).over(so_far), F.lit(""))).withColumn("h3", F.coalesce(F.last(h3, True).over(so_far), F.lit("")))
    kind = F.when(F.col("line").startswith("| STT"), F.lit(1)).when(~F.col("line").startswith("|"), F.lit(0))
    lines = lines.withColumn("in_table", F.coalesce(F.last(kind, True).over(so_far), F.lit(0)))
    start = F.last(F.when(F.col("line").startswith("| STT"), F.col("line_no")), True).over(so_far)
    lines = lines.withColumn("start", start)
    parts = F.transform(F.split("line", "[|]"), lambda x: F.trim(x))
    name = F.when(F.col("h3") != "", F.concat("h2", F.lit(" - "), "h3")).otherwise(F.col("h2"))
    rows = lines.where((F.col("in_table") == 1) & (F.col("line_no") > F.col("start") + 1) & (F.size(parts) >= 8))
    at = lambda i: F.get(parts, F.lit(i))
    return rows.select(
        "ma_ctdt", name.alias("ten_nhom"), F.when((F.col("h3") == "") | F.lower("h3").contains("bắt buộc"), "BAT_BUOC").otherwise("TU_CHON").alias("loai_nhom"),
        F.nullif(F.regexp_extract(F.lower(name), r"(\d+\.?\d*)\s*tín chỉ", 1), F.lit("")).try_cast("double").alias("credits_required"), "line_no",
        at(2).alias("ma_hoc_phan"), at(3).alias("ten_hoc_phan"), at(4).try_cast("double").alias("so_tin_chi"), at(5).try_cast("int").alias("hoc_ky"),
        tx.split_list(at(6)).alias("tien_quyet"), tx.split_list(at(7)).alias("hoc_truoc"),
    )


class LabelTable(HTMLParser):
    """Rows of class ``k-table-view`` as label and value; nested ``kTableRow`` rows as title and body."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[dict] = []
        self.stack: list[dict] = []
        self.cell: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "tr":
            self.stack.append({"class": (a.get("class") or "").split(), "cells": [], "spans": False})
        elif tag in ("td", "th") and self.stack:
            self.stack[-1]["spans"] |= "colspan" in a
            self.cell.append([])

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell and self.stack:
            self.stack[-1]["cells"].append(" ".join("".join(self.cell.pop()).split()))
        elif tag == "tr" and self.stack:
            self.rows.append(self.stack.pop())

    def handle_data(self, data):
        for c in self.cell:
            c.append(data)


def mhtml_part(raw: bytes) -> str | None:
    """The first HTML part of a saved page."""
    for part in email.message_from_bytes(raw, policy=email.policy.compat32).walk():
        if part.get_content_type() == "text/html":
            return (part.get_payload(decode=True) or b"").decode("utf-8", "replace")
    return None


def label_table(html: str) -> tuple[list[tuple[str, str]], list[str]]:
    p = LabelTable()
    p.feed(html)
    info, items = {}, []
    for r in p.rows:
        if "k-table-view" in r["class"] and len(r["cells"]) >= 2:
            info[r["cells"][0]] = r["cells"][1]
        elif "kTableRow" in r["class"] and len(r["cells"]) >= 3 and not r["spans"]:
            items.append(f"{r['cells'][1]}: {r['cells'][2]}")
    return list(info.items()), [x for i, x in enumerate(items) if not i or x != items[i - 1]]


def saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """MHTML files -> ``(path, html)``; files without an HTML part have null."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.mhtml").option("recursiveFileLookup", True).load(path)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            yield pd.DataFrame({"path": df["path"], "html": [mhtml_part(bytes(x)) for x in df["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, html string")


def label_tables(pages: DataFrame) -> DataFrame:
    """``pages(path, html)`` -> ``info`` (the last value of a label wins) and ``items`` (no item twice in a row)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            got = [label_table(x or "") for x in df["html"]]
            yield pd.DataFrame({"path": df["path"], "info": [dict(a) for a, _ in got], "items": [b for _, b in got]})

    return pages.select("path", "html").mapInPandas(run, "path string, info map<string,string>, items array<string>")


# Fixed names of the workbook format (ECMA-376).
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def last_sheet(raw: bytes) -> tuple[str, list[list[str]]]:
    """Name and cells of a workbook's last sheet; a missing cell is empty."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        part = lambda name: ElementTree.fromstring(z.read(name))
        shown = lambda x: "".join(t.text or "" for t in x.iter(f"{SHEET}t"))
        sheet = part("xl/workbook.xml").findall(f"{SHEET}sheets/{SHEET}sheet")[-1]
        target = {r.get("Id"): r.get("Target") for r in part("xl/_rels/workbook.xml.rels")}[sheet.get(RELATION)]
        strings = [shown(x) for x in part("xl/sharedStrings.xml").findall(f"{SHEET}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        table: list[list[str]] = []
        for row in part(posixpath.normpath(posixpath.join("/xl", target))[1:]).iter(f"{SHEET}row"):
            cells: list[str] = []
            for c in row.findall(f"{SHEET}c"):
                value = c.findtext(f"{SHEET}v") or ""
                value = strings[int(value)] if c.get("t") == "s" else shown(c) if c.get("t") == "inlineStr" else value
                at = column_number(c.get("r")) if c.get("r") else len(cells)
                cells += [""] * (at - len(cells)) + [value]
            number = int(row.get("r") or len(table) + 1)
            table += [[] for _ in range(number - 1 - len(table))] + [cells]
    width = max(map(len, table), default=0)
    return sheet.get("name"), [r + [""] * (width - len(r)) for r in table]


def column_number(reference: str) -> int:
    """Column of a cell's reference, from 0: ``B7`` is 1."""
    n = 0
    for letter in re.match("[A-Z]*", reference)[0]:
        n = 26 * n + ord(letter) - ord("A") + 1
    return n - 1


def markdown_table(cells: list[list[str]]) -> str:
    """A pipe table: the first row is the heading, and rows are numbered from 0."""
    line = lambda xs: "| " + " | ".join(x.replace("|", "\\|").replace("\n", " ") for x in xs) + " |"
    if not cells:
        return ""
    return "\n".join([line(["", *cells[0]]), "|" + "---|" * (len(cells[0]) + 1), *(line([str(i), *r]) for i, r in enumerate(cells[1:]))])


def workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Workbooks (``*.xlsx``) -> ``(path, sheet, markdown)`` of the last sheet of each; null for what isn't a workbook."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)

    def read(raw: bytes) -> tuple[str | None, str | None]:
        try:
            name, cells = last_sheet(raw)
        except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError):
            return None, None
        return name, markdown_table(cells)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            got = [read(bytes(x)) for x in df["content"]]
            yield pd.DataFrame({"path": df["path"], "sheet": [a for a, _ in got], "markdown": [b for _, b in got]})

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, markdown string")


def course_metadata(html: Column, path: Column) -> Column:
    """Title and code of a course page: the code in the page, else in the file's name."""
    title = tx.normalize_whitespace(tx.strip_html_tags(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))
    code = F.regexp_extract(tx.strip_html_tags(html), r"\b([A-Za-z]{2}\d{4})\b", 1)
    stem = F.regexp_extract(path, r"([A-Za-z]{2,}\d{3,})[^/]*$", 1)
    return F.struct(title.alias("title"), F.upper(F.coalesce(F.nullif(code, F.lit("")), F.nullif(stem, F.lit("")))).alias("code"))


def stream_label(path: Column) -> Column:
    """The stream of a source file: the name of its folder, in lower case."""
    return F.lower(F.regexp_extract(path, r"([^/]+)/[^/]*$", 1))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy metadata from JSON, a list of records or an object keyed by uri."""
    files = whole_files(spark, path, "*.json")
    body = "label:string,description:string,skill_type:string"
    listed = files.where(F.trim("content").startswith("[")).select(F.explode(F.from_json("content", f"array<struct<uri:string,{body}>>")).alias("r")).select("r.*")
    keyed = files.where(F.trim("content").startswith("{")).select(F.explode(F.from_json("content", f"map<string,struct<{body}>>")).alias("uri", "r")).select("uri", "r.*")
    return listed.unionByName(keyed)


def mentions(spark: SparkSession, path: str) -> DataFrame:
    """Cached mentions ``(cache_key, ...)``, a row a mention; the key is the file's name."""
    files = whole_files(spark, path, "*.json")
    rows = files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("cache_key"), F.explode(unwrap(F.regexp_replace("content", r'"mentions"\s*:', '"records":'), schemas.MENTION)).alias("m"))
    return rows.select("cache_key", "m.*")


def history(spark: SparkSession, path: str) -> DataFrame:
    """Earlier courses by name, the last file of a name winning."""
    files = whole_files(spark, path, "*.json").select("path", "content", F.get_json_object("content", "$.ten_vi").alias("ten_vi")).where("ten_vi is not null")
    return files.groupBy("ten_vi").agg(F.max_by("content", "path").alias("payload"))


def review_csv(spark: SparkSession, path: str) -> DataFrame:
    """A filled-in review sheet; what to do with it is in ``operators.records.reviewed``."""
    return string_csv(spark, path, tuple(REVIEW))


def latest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    return keep_first(df.withColumn("_o", -F.col(order)), key, ["_o"]).drop("_o")
