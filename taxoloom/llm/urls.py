"""URL verdicts: rules are indexed by their rarest literal token; a URL's tokens fetch the rules that may fit."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules are a list in the program; a list of more than this many bytes of text is not broadcast.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def literals(self) -> list[str]:
        """Tokens that every URL it fits has: all of the host's, and the path's but the one the prefix may cut."""
        whole = re.findall("[a-z0-9]+", self.path[: self.path.rfind("/") + 1] if "/" in self.path else "")
        return re.findall("[a-z0-9]+", self.host) + [t for t in whole]


@dataclass(frozen=True)
class PatternRule:
    """Fits where the Java regular expression is found in the lower-cased URL. It must have a whole token that all such URLs have."""

    verdict: str
    pattern: str

    def literals(self) -> list[str]:
        """The whole tokens (``[a-z0-9]+``) of each URL that the pattern is found in, read off the pattern: runs of letters and digits
        outside groups and classes, between elements that match none. A pattern with branches outside groups has none."""
        parts = re.findall(r"\\.|\[\^?\]?(?:\\.|[^\]])*\]|[a-z0-9]+|.", self.pattern)
        flat, depth, group = [], 0, ""
        for x in parts:
            if x == "(":
                depth += 1
            if depth:
                group += x
            else:
                flat.append(x)
            if x == ")" and depth:
                depth -= 1
                if not depth:
                    flat.append(group)
                    group = ""
        if "|" in flat:
            return []
        # A border is the pattern's anchor, or an element with no letter, digit, wildcard or escape of its own.
        border = lambda x: x in ("^", "$", r"\.", r"\-") or not re.search(r"[a-zA-Z0-9\\]|\.(?![^\[]*\])|\[\^|^[?*+{|]", x)
        return [x for i, x in enumerate(flat) if re.fullmatch("[a-z0-9]+", x) and 0 < i < len(flat) - 1 and border(flat[i - 1]) and border(flat[i + 1])]


CONTRACT = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)
PATTERNS = (
    PatternRule("block", r"(^|[./-])casino([./-]|$)"),
    PatternRule("block", r"(^|[./-])(cheap|buy)-pills([./-]|$)"),
    PatternRule("block", r"(^|[./-])adult([./-]|$)"),
    PatternRule("block", r"(^|[./-])xxx([./-]|$)"),
    PatternRule("block", r"[?&]phpsessid="),
)


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(url, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1)))


def rule_index(urls: DataFrame, rules: list[HostRule | PatternRule]) -> DataFrame:
    """A row a rule: ``(no, verdict, host, path, pattern, token)``, ``token`` being its literal that
    fewest rows of ``urls(token)`` have (ties: the first literal in order)."""
    rows = []
    for no, r in enumerate(rules):
        if not r.literals():
            raise ValueError(f"rule {no} has no literal token to be indexed by")
        host = isinstance(r, HostRule)
        values = {"no": no, "verdict": r.verdict, "host": r.host if host else None, "path": r.path if host else None, "pattern": None if host else r.pattern}
        rows.append(F.struct(*(F.lit(v).cast("int" if k == "no" else "string").alias(k) for k, v in values.items()), F.array(*map(F.lit, r.literals())).alias("literals")))
    table = urls.sparkSession.range(1).select(F.inline(F.array(*rows)))
    literal = table.select("no", F.explode("literals").alias("token")).distinct()
    hint = F.broadcast if small(rules) else (lambda df: df)
    seen = urls.join(hint(literal.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = literal.join(hint(seen) if small(rules) else seen, "token", "left").groupBy("no").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("m"))
    return table.drop("literals").join(rarest.select("no", F.col("m.token").alias("token")), "no")


def small(rules: list[HostRule | PatternRule]) -> bool:
    return sum(len(str(r)) for r in rules) <= BROADCAST_BYTES


def judge(pages: DataFrame, host_rules: tuple[HostRule, ...] = CONTRACT, patterns: tuple[PatternRule, ...] = PATTERNS, default: str = "allow") -> DataFrame:
    """``pages(page_id, url, ...)`` -> ``(page_id, host, path, rule, verdict, pattern)``, a row a row.

    The longest host rule that fits gives ``rule`` and the verdict (ties: the first in text order). Without
    one, ``rule`` is null; the verdict is ``block`` if a blocking pattern is found, else ``default``, and ``pattern`` is the
    first such pattern. Each distinct URL is judged once. A null url, and one without ``://``, have an empty host and path; a URL of any
    length is judged whole. Repeated rows stay; other columns are not read; an empty table gives no rows.
    """
    rules = [*host_rules, *patterns]
    urls = pages.select("url").distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"), tokens_of(F.col("url")).alias("tokens"))
    counted = pages.select(F.explode(tokens_of(F.col("url"))).alias("token"))
    index = rule_index(counted, rules)
    fetched = parts.select("url", "h", "p", F.explode("tokens").alias("token")).join(F.broadcast(index) if small(rules) else index, "token")
    is_host = F.col("host").isNotNull()
    fits = F.when(is_host, ((F.col("h") == F.col("host")) | F.col("h").endswith(F.concat(F.lit("."), "host"))) & F.col("p").startswith(F.col("path")))
    fits = fits.otherwise(F.expr("lower(url) rlike pattern"))
    text = F.concat("host", "path")
    found = fetched.where(fits).groupBy("url").agg(
        F.min(F.when(is_host, F.struct((-F.char_length(text)).alias("n"), text.alias("rule"), "verdict"))).alias("best"),
        F.min(F.when(~is_host & (F.col("verdict") == "block"), F.struct("no", "pattern"))).alias("bad"),
    )
    judged = pages.select("page_id", "url").join(found, "url", "left")
    return judged.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("bad").isNotNull(), "block"), F.lit(default)).alias("verdict"),
        F.col("bad.pattern").alias("pattern"),
    )


ORACLE = """
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
  SELECT page_id, url, max({'n': length(h || p), 'rule': h || p, 'verdict': verdict}) AS b
  FROM (SELECT DISTINCT page_id, url, host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL),
bad(no, pattern) AS (VALUES
  (0, '(^|[./-])casino([./-]|$)'), (1, '(^|[./-])(cheap|buy)-pills([./-]|$)'), (2, '(^|[./-])adult([./-]|$)'), (3, '(^|[./-])xxx([./-]|$)'), (4, '[?&]phpsessid=')),
hit AS (
  SELECT url, min_by(pattern, no) AS pattern FROM (SELECT DISTINCT url FROM parts) JOIN bad ON regexp_matches(lower(url), pattern) GROUP BY url)
SELECT p.page_id, p.host, p.path, b.b.rule AS rule,
  coalesce(b.b.verdict, CASE WHEN h.pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict, h.pattern AS pattern
FROM parts p LEFT JOIN best b USING (page_id, url) LEFT JOIN hit h USING (url)
"""
