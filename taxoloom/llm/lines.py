"""Line deduplication by a deletion neighbourhood over words. DataFrame operations only.

Lines are compared as lists of lower-cased words. A line goes if its words occur earlier, or if it has
``fuzzy_words`` words or more and an earlier such line is within one word edit (insert, delete or replace).
Earlier: by (doc_id, line number); null ids come last. Judged on the input, not on what is left.

A line's deletion neighbourhood is itself and itself without one word. Two lines are within one edit exactly if
one equals a variant of the other, or both give the same variant by deleting at the same place. So all lines of a
bucket of equal variants are near each other, and it needs its earliest line only: no pairs are made, however
many lines share a variant. Variants are keyed by 64-bit hashes; the edit distance to the earliest is then verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.common import materialize


def place() -> Column:
    """The order of lines."""
    return F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "line_no", "th")


def text_of() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def plain_lines(text: Column) -> Column:
    """Each line in lower case with single spaces between its words, and none at its ends. Most lines are so already."""
    lines = F.split(F.regexp_replace(F.lower(text), r"[\x09\x0B-\x0D]", " "), "\n")
    ragged = lambda s: s.contains("  ") | s.startswith(" ") | s.endswith(" ")
    return F.transform(lines, lambda s: F.when(ragged(s), F.array_join(F.array_remove(F.split(s, " "), ""), " ")).otherwise(s))


def split_lines(docs: DataFrame, fuzzy_words: int) -> DataFrame:
    """``(doc_id, th, line_no, h, n, heads, tails)``; ``th`` tells rows of one id apart by a hash of their text.

    Of two lines within one edit, with m words the shorter, one of two holds: their first m // 2 words are equal, or their
    last m - m // 2. ``heads`` and ``tails`` hash these for m = n and m = n - 1 (null for lines too short to be near another).
    """

    lines = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("th"), F.posexplode(plain_lines(text_of())).alias("line_no", "s"))
    blanks = F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit("")))
    lines = lines.withColumn("n", F.when(F.col("s") == "", 0).otherwise(blanks + 1))
    cut = lambda k: F.expr(f"xxhash64({k}, substring_index(s, ' ', cast({k} as int)))")
    low, high = "(n - 1) div 2", "n div 2"
    heads = F.when(F.expr(f"{low} = {high}"), F.array(cut(high))).otherwise(F.array(cut(low), cut(high)))
    tails = F.when(F.expr(f"{low} = {high}"), F.array(cut(f"(- n + {high})"), cut(f"(1 - n + {low})"))).otherwise(F.array(cut(f"(- n + {high})")))
    long = F.col("n") >= fuzzy_words
    return lines.select("doc_id", "th", "line_no", F.xxhash64("s").alias("h"), "n", F.when(long, heads).alias("heads"), F.when(long, tails).alias("tails"))


def near_lines(rows: DataFrame, first: DataFrame, docs: DataFrame, fuzzy_words: int) -> DataFrame:
    """``h`` of the distinct lines that have an earlier line within one edit.

    Only lines that share a head or a tail with another line emit variants, and only where the edit can then be.
    """
    sides = F.concat(F.transform("heads", lambda k: F.struct(F.lit(0).alias("side"), k.alias("k"))), F.transform("tails", lambda k: F.struct(F.lit(1).alias("side"), k.alias("k"))))
    keyed = rows.where(F.col("n") >= fuzzy_words).select("h", F.explode(sides).alias("s")).select("h", "s.side", "s.k")
    shared = keyed.groupBy("side", "k").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("side", "k")
    wanted = keyed.join(shared, ["side", "k"], "left_semi").groupBy("h").agg(F.bool_or(F.col("side") == 0).alias("head"), F.bool_or(F.col("side") == 1).alias("tail"))
    spots = first.join(wanted, "h").select("at.doc_id", "at.th", "at.line_no", "h", "head", "tail")
    per_doc = spots.groupBy("doc_id", "th").agg(F.collect_list(F.struct("line_no", "h", "head", "tail")).alias("spots"))
    per_doc = per_doc.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "spots")
    found = docs.join(per_doc, same_doc()).dropDuplicates(["_doc", "_th"])
    took = F.transform("spots", lambda s: F.struct(s.alias("s"), F.split(F.get("words", s["line_no"]), " ").alias("w")))
    found = found.select("_doc", "spots", once(plain_lines(F.col("text"))).alias("words")).select("_doc", F.explode(took).alias("x"))
    lines = found.select(F.col("x.s.h").alias("h"), F.struct(F.col("_doc").isNull().alias("nil"), F.col("_doc").alias("doc"), F.col("x.s.line_no").alias("line"), F.col("x.s.h").alias("h")).alias("at"), F.col("x.s.head").alias("head"), F.col("x.s.tail").alias("tail"), F.col("x.w").alias("w"))
    lines = materialize(lines, "lines")
    grown = chains(lines)
    v = materialize(grown.select("at", F.explode(variants()).alias("v")).select("v", "at.*"), "variants")
    # Few variants are shared: they are counted first, and only theirs are compared.
    common = v.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    met = v.join(common, "v", "left_semi").select("v", F.struct("nil", "doc", "line", "h").alias("at"))
    met = materialize(met, "shared")
    pairs = met.join(met.groupBy("v").agg(F.min("at").alias("m")), "v").where("at.h <> m.h").select("at.h", F.col("m.h").alias("other")).distinct()
    a, b = lines.select("h", F.col("w").alias("x")), lines.select(F.col("h").alias("other"), F.col("w").alias("y"))
    return pairs.join(a, "h").join(b, "other").where(within_one_edit(F.col("x"), F.col("y"))).select("h").distinct()


def once(c: Column) -> Column:
    """A generator of one row: ``c`` is computed once, and not again for each element of a lambda that uses it."""
    return F.explode(F.array(c))


def same_doc() -> Column:
    return F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("_t") == F.col("_th"))


def chains(lines: DataFrame) -> DataFrame:
    """Hashes of all beginnings (``p``: of the first i words) and ends (``q``: of all but the first i), each made from the one before."""
    zero = F.array(F.lit(0).cast("long"))
    grow = lambda w: F.aggregate(w, zero, lambda a, x: F.array_append(a, F.xxhash64(F.element_at(a, -1), x)))
    both = F.struct(grow(F.col("w")).alias("p"), F.reverse(grow(F.reverse("w"))).alias("q"), F.size("w").alias("n"))
    return lines.select("at", "head", "tail", once(both).alias("c")).select("at", "head", "tail", "c.*")


def variants() -> Column:
    """Keys of a line's deletion neighbourhood: each word left out, and nothing left out at each place. Two lines share a key exactly
    if one edit at that place makes them equal. A shared head puts the edit behind it, a shared tail before it."""
    n = F.col("n")
    lo = F.when(F.col("tail"), 0).otherwise(F.floor((n - 1) / 2).cast("int"))
    hi = F.when(F.col("head"), n).otherwise(n - F.floor(n / 2).cast("int") + 1)
    at = F.sequence(lo, F.least(hi, n))
    whole = F.transform(at, lambda i: F.xxhash64(n, i, F.get("p", i), F.get("q", i)))
    less = F.transform(F.filter(at, lambda i: i < n), lambda i: F.xxhash64(n - 1, i, F.get("p", i), F.get("q", i + 1)))
    return F.concat(whole, less)


def within_one_edit(x: Column, y: Column) -> Column:
    """Whether the shared first and last words leave one word at most of the longer list."""

    def same(a: Column, b: Column) -> Column:
        differ = F.array_position(F.zip_with(a, b, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        return F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b)))

    least = F.least(F.size(x), F.size(y))
    return F.greatest(F.size(x), F.size(y)) - F.least(least, same(x, y) + same(F.reverse(x), F.reverse(y))) <= 1


def dedup_lines(docs: DataFrame, min_words: int = 3, fuzzy_words: int = 8) -> DataFrame:
    """All columns of ``docs`` with ``text`` less the lines that go, and ``n_lines``, ``n_removed``; a row a row.

    Lines of fewer than ``min_words`` words always stay. Texts keep their other lines as they were; a null text
    stays null. Rows of equal id and text are one document. Ids may be null or repeat; a text of any length is split in its row; an empty
    table gives no rows. Clashing extra columns ``n_lines`` and ``n_removed`` are replaced.
    """
    rows = materialize(split_lines(docs, fuzzy_words).where(F.col("n") >= min_words), "rows")
    first = materialize(rows.groupBy("h").agg(F.min(place()).alias("at")), "first")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # All columns travel in one struct, so that none can clash with the names used here.
    keep = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64(text_of()).alias("_t"), F.struct(*columns).alias("_own"))
    near = near_lines(rows, first, keep.select("doc_id", "text", "_t"), fuzzy_words).withColumn("near", F.lit(True))
    gone = (
        rows.select("doc_id", "th", "line_no", "h")
        .join(first.join(near, "h", "left"), "h")
        .where(F.col("near") | (place() != F.col("at")))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("line_no").alias("gone"))
        .select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "gone")
    )
    joined = keep.select("doc_id", "_t", "_own").join(gone, same_doc(), "left")
    text = F.col("_own.text")
    joined = joined.select("_own", "gone", once(F.when(F.col("gone").isNotNull(), F.split(text, "\n"))).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    new = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return joined.select(
        *(F.when(F.col("gone").isNull(), text).otherwise(new).alias(c) if c == "text" else F.col("_own")[c].alias(c) for c in columns),
        F.coalesce(breaks + 1, F.lit(1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


ORACLE = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, i - 1 AS line_no, ls[i] AS line, regexp_extract_all(lower(ls[i]), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM s)),
k AS (SELECT *, array_to_string(w, ' ') AS t, doc_id * 1000000 + line_no AS spot FROM l WHERE len(w) >= 3),
f AS (SELECT t, min(spot) AS spot, len(any_value(w)) AS n, any_value(w) AS w FROM k GROUP BY t),
v AS (
  SELECT t, spot, i AS pos, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS v
  FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM f WHERE n >= 8)),
p AS (SELECT v, pos, min(spot) AS spot FROM v GROUP BY ALL),
q AS (SELECT v, min(spot) AS spot FROM v GROUP BY ALL),
near AS (
  SELECT v.t FROM v JOIN p USING (v, pos) WHERE p.spot < v.spot
  UNION SELECT v.t FROM v JOIN f ON f.t = v.v AND f.n >= 8 WHERE f.spot < v.spot
  UNION SELECT f.t FROM f JOIN q ON f.t = q.v AND f.n >= 8 WHERE q.spot < f.spot),
gone AS (
  SELECT doc_id, line_no FROM k JOIN f USING (t) LEFT JOIN (SELECT t, true AS near FROM near) AS x USING (t)
  WHERE x.near OR k.spot <> f.spot),
kept AS (
  SELECT l.doc_id, array_to_string(list(l.line ORDER BY l.line_no) FILTER (g.doc_id IS NULL), chr(10)) AS text,
    count(*) AS n_lines, count(g.doc_id) AS n_removed
  FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, md5(coalesce(text, '')) AS text_md5 FROM kept
"""
