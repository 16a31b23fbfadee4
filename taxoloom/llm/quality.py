"""Quality rules as a ledger: each rule is evaluated once into a bit; policies and ablations read the bits."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The contract's word and symbol classes.
OTHER_BLANKS = r"[\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Other blanks become spaces first, as splitting at one character needs no pattern."""
    return F.array_remove(F.split(F.regexp_replace(text, OTHER_BLANKS, " "), " "), "")


def measure(docs: DataFrame) -> DataFrame:
    """Adds the measurements that rules use: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines``.

    Null text counts as empty. Three-word windows are compared by a 64-bit hash within one text, sorted in the row:
    no text is shuffled and the cost is n log n in its words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # All columns travel in one struct, so that none can clash with the names used here.
    base = docs.select(F.struct(*docs.columns).alias("_own"), text.alias("_text"))
    text = F.col("_text")
    base = base.withColumn("_words", words_of(text)).withColumn("_lines", F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    base = base.withColumn("_windows", windows)
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    base = base.withColumn("_sorted", F.when(repeats, F.sort_array(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
    base = base.withColumn("_twice", F.sort_array(F.transform(twice, lambda x: x["i"])))
    t = F.col("_twice")
    covered = F.aggregate(F.transform(t, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(t, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    # A generator keeps filters on the measurements from being moved below it, where they would repeat all of this.
    all_of = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    return base.select("_own", F.explode(F.array(all_of)).alias("_m")).select(*(F.col("_own")[c].alias(c) for c in docs.columns), "_m.*")


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over the measurements."""

    name: str
    fails: str


#: The order gives the bits; new rules go to the end, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: a row is rejected if it fails any of ``reject``."""

    version: str
    reject: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(rules)}
        return sum(bits[n] for n in self.reject)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = (BASE, Policy("v1", tuple(r.name for r in RULES)))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, measured: Callable[[DataFrame], DataFrame] = measure) -> DataFrame:
    """All columns and measurements, and ``failures``: bit i is set where rule i fails (null conditions pass). Written as a table, it
    serves any later policy.

    Null and empty texts have measurements of 0; a text of any length is measured in its row. A caller's column named like a
    measurement is replaced. Ids are not read; repeated rows stay; an empty table gives no rows.
    """
    clash = [c for c in docs.columns if c in MEASURES]
    docs = docs.drop(*clash)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, r in enumerate(rules)]
    out = measured(docs)
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return out.withColumn("failures", total)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "failures")


def apply_policy(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES, into: str = "kept") -> DataFrame:
    return rows.withColumn(into, F.col("failures").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0)


def ablations(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row a rule of the policy: rows that fail it, that fail it alone, and that the policy keeps without it; and the policy's other
    rules that all (``always_with``) or some (``ever_with``) of the rows that fail it fail as well, as bits.

    The ledger is summed up by the bits that are set, a row a pattern; the rest is bitwise aggregation of these.
    """
    mask = F.lit(policy.mask(rules)).cast("long")
    patterns = rows.groupBy(F.col("failures").bitwiseAND(mask).alias("hit")).agg(F.count("*").alias("rows"))
    hit, n = F.col("hit"), F.col("rows")
    which = [i for i, r in enumerate(rules) if r.name in policy.reject]
    bit = lambda i: F.lit(1 << i).cast("long")
    has = lambda i: hit.bitwiseAND(bit(i)) != 0
    of = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    others = lambda f, i: F.coalesce(f(F.when(has(i), hit)).bitwiseXOR(bit(i)), F.lit(0).cast("long"))
    one = patterns.agg(
        of(F.lit(True)).alias("n"),
        of(hit == 0).alias("kept"),
        *(x for i in which for x in (of(has(i)).alias(f"f{i}"), of(hit == bit(i)).alias(f"o{i}"), others(F.bit_and, i).alias(f"a{i}"), others(F.bit_or, i).alias(f"e{i}"))),
    )
    each = F.array(*(F.struct(F.lit(rules[i].name).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"o{i}").alias("failed_alone"), (F.col("kept") + F.col(f"o{i}")).alias("kept_without"), F.col(f"a{i}").alias("always_with"), F.col(f"e{i}").alias("ever_with")) for i in which))
    return one.select(F.lit(policy.version).alias("policy"), "n", "kept", F.explode(each).alias("x")).select("policy", "n", "kept", "x.*")


def filter_quality(docs: DataFrame, policy: Policy = POLICIES[-1]) -> DataFrame:
    """The rows that the policy keeps, with the columns of ``docs``. Null and empty texts have no words, so they go."""
    rows = ledger(docs.select("text", F.struct(*docs.columns).alias("_all")))
    return apply_policy(rows, policy, into="_kept").where("_kept").select(*(F.col("_all")[c].alias(c) for c in docs.columns))


LEDGER = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    [s FOR s IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(s, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM dup, (VALUES (0), (1), (2)) AS t(o) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > 3 * n_words)::BIGINT
    + 8 * (word_chars < 2 * n_words)::BIGINT + 16 * (word_chars > 15 * n_words)::BIGINT + 32 * (2 * n_dup_lines > n_lines)::BIGINT AS failures
  FROM m)
"""
ORACLE = LEDGER + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM b"
ABLATIONS = LEDGER + """SELECT 'v1' AS policy, (SELECT count(*) FROM b) AS n, (SELECT count(*) FROM b WHERE failures = 0) AS kept, rule,
  count(*) FILTER (failures >> bit & 1 = 1) AS failed, count(*) FILTER (failures = 1 << bit) AS failed_alone, count(*) FILTER (failures = 0 OR failures = 1 << bit) AS kept_without,
  coalesce(xor(bit_and(failures) FILTER (failures >> bit & 1 = 1), (1 << bit)::BIGINT), 0) AS always_with, coalesce(xor(bit_or(failures) FILTER (failures >> bit & 1 = 1), (1 << bit)::BIGINT), 0) AS ever_with
FROM b, (VALUES """ + ", ".join(f"('{r.name}', {i})" for i, r in enumerate(RULES)) + ") AS t(rule, bit) GROUP BY rule, bit"
