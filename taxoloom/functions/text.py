"""Scalar functions over columns. All run in the JVM; those that need Unicode tables are in ``unicode``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxoloom import config

#: Fixed value: runs of white space as Unicode and the separators of ASCII have it (plain ``\s`` in Java knows ASCII only,
#: and its Unicode mode is slow).
SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_whitespace(c: Column | str) -> Column:
    """Runs of white space become one blank, the ends go; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACES, " "))


def strip_html_tags(c: Column | str) -> Column:
    """Tags become blanks. Bodies of scripts and entities stay."""
    return F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", " ")


def slugify_label(c: Column | str) -> Column:
    """Trimmed lower case without punctuation, blanks and hyphens as ``_``; ``unknown`` if nothing is left."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(col(c), F.lit("")))), r"(?U)[^\w\s-]", "")
    return F.coalesce(F.nullif(F.regexp_replace(bare, r"(?U)[\s-]+", "_"), F.lit("")), F.lit("unknown"))


def safe_label(c: Column | str) -> Column:
    """Lower case with all but ASCII letters and digits as ``_``, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def strip_noise(c: Column | str) -> Column:
    """Control characters, a leading number, letter or bullet go; white space is normalised."""
    s = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\p{Cc}&&[^\n\t]]", "")
    for lead in (r"^(?U)\s*\d+[.)]\s*", r"^(?U)\s*[a-zA-Z][.)]\s*", r"^(?U)\s*[•\-–—]\s*"):
        s = F.regexp_replace(s, lead, "")
    return normalize_whitespace(s)


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """Whether the lower-cased text contains one of ``words`` (plain substrings: ``microprocessor`` has ``crop``)."""
    # One pattern, so that the lower-cased text is made once.
    found = [rf"\Q{w}\E" for w in words]
    return F.lower(F.coalesce(col(c), F.lit(""))).rlike("|".join(found)) if found else F.lit(False)


def is_grading_event(c: Column | str) -> Column:
    return contains_any(c, config.GRADING)


def is_boilerplate(c: Column | str, patterns: Sequence[str] = config.BOILERPLATE) -> Column:
    return F.trim(F.lower(F.coalesce(col(c), F.lit("")))).rlike("|".join(f"(?:{p})" for p in patterns))


def truncate_tokens(c: Column | str, n: int) -> Column:
    """The first ``n`` tokens, joined by blanks; a shorter text stays as it is."""
    tokens = tokenize(c, lower=False)
    return F.when(F.size(tokens) <= n, col(c)).otherwise(F.array_join(F.slice(tokens, 1, n), " "))


def tokenize(c: Column | str, lower: bool = True) -> Column:
    """White-space tokens, repeats and punctuation kept."""
    text = F.coalesce(col(c), F.lit(""))
    return F.array_remove(F.split(F.lower(text) if lower else text, SPACES), "")


def split_sentences(c: Column | str, longer_than: int = 10) -> Column:
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), r"[.\n;]+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: F.char_length(s) > longer_than)


def clean_str(c: Column | str) -> Column:
    """Trimmed; null for the words that stand for nothing."""
    s = F.trim(col(c))
    return F.when(~F.lower(s).isin("null", "none", "", "n/a"), s)


def safe_float(c: Column | str) -> Column:
    """A decimal comma is a point; null for what isn't a number."""
    return F.replace(F.trim(col(c)), F.lit(","), F.lit(".")).try_cast("double")


def split_list(c: Column | str, mark: str = ",") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), f"[{mark}]"), lambda s: F.trim(s)), lambda s: s != "")


def clean_list(c: Column | str) -> Column:
    """Trimmed items without the words that stand for nothing; empty items stay."""
    return F.filter(F.transform(col(c), lambda s: F.trim(s)), lambda s: ~F.lower(s).isin("null", "none", "n/a", "-"))


def lines_list(c: Column | str, strip_comma: bool = False) -> Column:
    """Items on lines; ``strip_comma`` drops a comma at an item's end."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), "\n"), lambda s: F.trim(F.regexp_replace(F.trim(s), ",+$", "") if strip_comma else s))
    return F.filter(parts, lambda s: s != "")


# Fixed pattern: "I.2. name — 13.0 tín chỉ - group".
GROUP_NAME = r"(?s)^([IVX]+\.\d+)\.(?U)\s+(.+?)\s+—\s+([\d.]+)\s+tín chỉ(?:\s*-\s*(.*))?$"
GROUP_BASE = r"(?s)^(?:[IVX]+\.\d+\.(?U)\s+)?(.+?)(?U)\s+—\s+[\d.]+\s+tín chỉ(?:\s*-\s*.*)?$"


def parse_group_name(c: Column | str) -> Column:
    """``struct(section, base, credits, sub)``; a name of another form is ``('?', name, 0, null)``. ``sub`` is
    upper-cased and without a leading ``Nhóm``; where it isn't an identifier, :func:`reshape.group_ids` makes it one."""
    s = F.trim(col(c))
    part = lambda i: F.regexp_extract(s, GROUP_NAME, i)
    fits = s.rlike(GROUP_NAME)
    sub = F.trim(F.regexp_replace(F.trim(part(4)), r"^[Nn]h[oó]m(?U)\s+", ""))
    return F.struct(
        F.when(fits, part(1)).otherwise("?").alias("section"),
        F.when(fits, F.trim(part(2))).otherwise(s).alias("base"),
        F.when(fits, part(3).cast("double")).otherwise(0.0).alias("credits"),
        F.when(fits & (sub != ""), F.when(sub.rlike("^[A-Za-z0-9_]+$"), F.upper(sub)).otherwise(sub)).alias("sub"),
    )


def group_base_name(c: Column | str) -> Column:
    s = F.trim(col(c))
    return F.when(s.rlike(GROUP_BASE), F.trim(F.regexp_extract(s, GROUP_BASE, 1))).otherwise(F.nullif(s, F.lit("")))


def map_values(c: Column | str, table: dict[str, str], default: Column | None = None) -> Column:
    """A closed list translated by a ``CASE``."""
    out = None
    for k, v in table.items():
        out = F.when(col(c) == k, v) if out is None else out.when(col(c) == k, v)
    return out if default is None else out.otherwise(default)


def strip_bs(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "_BS$", "")


def add_bs(c: Column | str) -> Column:
    return F.when(col(c).endswith("_BS"), col(c)).otherwise(F.concat(col(c), F.lit("_BS")))


def content_hash(*cols: Column | str) -> Column:
    """MD5 of a canonical form: fields in the given order, nulls told apart from empty text."""
    parts = [F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit("~")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *parts))


def cache_key(evidence_id: Column | str, version: str) -> Column:
    return F.md5(F.concat(F.lit(f"llm_{version}_"), col(evidence_id)))


def custom_uri(codes: Column | str, base: str = "http://data.europa.eu/esco/occupation/custom-") -> Column:
    return F.concat(F.lit(base), F.md5(col(codes)))


def uri_tail(c: Column | str) -> Column:
    """The last segment of a path, after slashes at the end are dropped."""
    return F.regexp_extract(F.regexp_replace(col(c), "/+$", ""), "([^/]*)$", 1)


def in_domain(codes: Column | str, prefixes: Sequence[str] = config.DOMAIN_CODES) -> Column:
    """A non-empty array whose codes all begin with a prefix."""
    return (F.size(col(codes)) > 0) & F.forall(col(codes), lambda c: c.rlike(f"^({'|'.join(prefixes)})"))


def strip_fence(c: Column | str) -> Column:
    """The payload of an answer that may stand in a code fence."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(col(c)), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def parse_json_answer(c: Column | str, schema: str) -> Column:
    return F.from_json(strip_fence(c), schema)


def valid_concepts(c: Column | str, most: int) -> Column:
    """Non-blank concepts, trimmed and lower-cased, the first ``most``; repeats stay."""
    return F.slice(F.filter(F.transform(col(c), lambda s: F.lower(F.trim(s))), lambda s: s != ""), 1, most)


def cypher_escape(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("'"), F.lit("\\'"))


def rank_or(c: Column | str, missing: int = 999) -> Column:
    return F.coalesce(col(c), F.lit(missing))


def best_rank(*ranks: Column | str) -> Column:
    return F.least(*(rank_or(r) for r in ranks))


def rounded(c: Column | str, places: int) -> Column:
    """A double rounded as the SQL that queries must agree with has it: times ten to the ``places``, half away from zero, divided again.

    ``F.round`` rounds the shortest decimal instead: 0.5167025, of which a million-fold is 516702.49999999994, goes to 0.516703
    there and to 0.516702 here. Where the product is no finite number, the value stays.
    """
    out = F.round(col(c) * 10.0**places, 0) / 10.0**places
    return F.when(F.abs(out) < float("inf"), out).otherwise(col(c))


def sigmoid(c: Column | str) -> Column:
    return 1 / (1 + F.exp(-col(c)))


def softmax_last(scores: Column | str) -> Column:
    """The probability of the last class of an array of scores; a scorer's output where it has more than one."""
    last = F.element_at(col(scores), -1)
    return 1 / F.aggregate(col(scores), F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - last.cast("double")))


def outcome_class(c: Column | str) -> Column:
    return F.when(contains_any(c, config.OUTCOME_ATTITUDE), "TU_CHU_TRACH_NHIEM").when(contains_any(c, config.OUTCOME_KNOWLEDGE), "KIEN_THUC").otherwise("KY_NANG")


def concept_kind(skill_type: Column | str) -> Column:
    return F.when(F.lower(F.coalesce(col(skill_type), F.lit(""))).contains("knowledge"), "knowledge").otherwise("skill")


def concept_class(text: Column | str, skill_type: Column | str) -> Column:
    return (
        F.when(concept_kind(skill_type) == "knowledge", "foundational")
        .when(contains_any(text, config.CONCEPT_INTERPERSONAL), "interpersonal")
        .when(contains_any(text, config.CONCEPT_COGNITIVE), "cognitive")
        .when(contains_any(text, config.CONCEPT_METHODOLOGICAL), "methodological")
        .otherwise("cognitive")
    )


def evidence_weight(source_type: Column | str, subtype: Column | str) -> Column:
    out = None
    for (kind, sub), w in config.EVIDENCE_WEIGHTS.items():
        hit = (col(source_type) == kind) & col(subtype).eqNullSafe(F.lit(sub))
        out = F.when(hit, w) if out is None else out.when(hit, w)
    return out.otherwise(config.DEFAULT_WEIGHT)


def csv_value(c: Column | str, kind: str = "string") -> Column:
    """A property as graph import files want it: null as empty, lists joined by ``;`` (``;`` in items as ``,``),
    booleans in lower case, line ends as blanks."""
    if kind == "array":
        kept = F.transform(F.filter(col(c), lambda x: x.isNotNull()), lambda x: F.replace(x.cast("string"), F.lit(";"), F.lit(",")))
        text = F.array_join(kept, ";")
    else:
        text = col(c).cast("string")
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\r\n]", " "))


def strip_lesson_prefix(c: Column | str) -> Column:
    """Drops ``Bài 1:``, ``Lesson 2 -`` and their like from the beginning of a title."""
    lead = r"^(?iu)(?:Bài|Chương|Phần|Lab|Lesson|Chapter|Part)(?U)\s*\d+\s*[:.\-]*\s*"
    return F.trim(F.regexp_replace(col(c), lead, ""))
