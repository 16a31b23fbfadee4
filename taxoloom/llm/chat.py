"""Transcript parsing: a hidden Markov model over speaker markers and line features recovers who speaks.

A conversation is parsed as a whole, in the order of its turns, however many partitions it spans. Scores are whole numbers,
so that they add up alike in any order: each piece of a long conversation is summed up as the best scores from each state
before it to each state at its end, a scan over the pieces (a row a piece) gives the scores at each piece's start, and one in
reverse the state at its end; then pieces are parsed on their own, and turns that cross a border are put together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.common import materialize, spread

ROLES = ("system", "user", "assistant")
#: States: a role's first line, and its further lines.
STATES = [(r, first) for r in ROLES for first in (True, False)]
#: Speaker markers by kind, at the start of a line.
MARKERS = (
    ("user", re.compile(r"(?:user|human|customer|q|you)\s*[:>]\s*", re.I)),
    ("assistant", re.compile(r"(?:assistant|ai|bot|agent|a)\s*[:>]\s*", re.I)),
    ("system", re.compile(r"(?:system|instructions?|context)\s*[:>]\s*", re.I)),
    ("user", re.compile(r"#+ *(?:user|prompt|question)\s*$", re.I)),
    ("assistant", re.compile(r"#+ *(?:assistant|response|answer)\s*$", re.I)),
    ("system", re.compile(r"#+ *(?:system|instruction)\s*$", re.I)),
    ("other", re.compile(r"[\w .]{1,24}:\s+|[-*>]\s")),
)
#: Raw styles used to render training and test transcripts, by role; the last style has dashes for turns.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "Context: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "Instructions: ", "user": "Q: ", "assistant": "A: "},
    {"system": "### Instruction\n", "user": "### Prompt\n", "assistant": "### Response\n"},
    {"system": "", "user": "- ", "assistant": "- "},
)


def marker(line: str) -> tuple[str, int]:
    """Kind of the marker that a line begins with, and its length."""
    for kind, pattern in MARKERS:
        if m := pattern.match(line):
            return kind, m.end()
    return "none", 0


#: Kinds of lines before a line: other lines, a blank one, none.
PLAIN, BLANK, START = 0, 1, 2
#: Log probabilities are held as multiples of this part of 1.
UNIT = 1 << 20
K = len(STATES)
BEGINS = np.array([begins for _, begins in STATES])


def features(lines: list[str], before: int = START) -> np.ndarray:
    """Per line: marker kind, length class, whether it asks, and what comes before."""
    kinds = {"none": 0, "user": 1, "assistant": 2, "system": 3, "other": 4}
    out = []
    for s in lines:
        kind, n = marker(s)
        body = s[n:].strip()
        size = 0 if not body else 1 if len(body) < 40 else 2 if len(body) < 160 else 3 if len(body) < 400 else 4
        out.append((kinds[kind], size, int(body.endswith("?")), before))
        before = PLAIN if s.strip() else BLANK
    return np.array(out, np.int64).reshape(-1, 4)


SIZES = (5, 5, 2, 3)


@dataclass
class Model:
    """Log probabilities in units: of the first state, of steps, and of each feature's values in each state."""

    first: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, lines: list[str], before: int) -> np.ndarray:
        f = features(lines, before)
        return sum(e[:, f[:, i]] for i, e in enumerate(self.emit))

    def span(self, lines: list[str], before: int) -> np.ndarray:
        """Best scores from each state before the lines (a row each) to each state of the last line."""
        score = self.scores(lines, before)
        if before == START:
            now = np.repeat((self.first + score[:, 0])[None], K, 0)
        else:
            now = self.step + score[:, 0]
        for t in range(1, score.shape[1]):
            now = (now[:, :, None] + self.step).max(axis=1) + score[:, t]
        return now

    def forward(self, lines: list[str], before: int = START, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the last line's states, and each line's best state before it. ``start``: scores of the states before the lines."""
        score = self.scores(lines, before)
        back = np.zeros((len(lines), K), np.int8)
        if start is None:
            now = self.first + score[:, 0]
        else:
            way = start[:, None] + self.step
            back[0], now = way.argmax(axis=0), way.max(axis=0) + score[:, 0]
        for t in range(1, len(lines)):
            way = now[:, None] + self.step
            back[t] = way.argmax(axis=0)
            now = way.max(axis=0) + score[:, t]
        return now, back

    def viterbi(self, lines: list[str]) -> list[int]:
        now, back = self.forward(lines)
        return traced(back, int(now.argmax()))[1:]


def traced(back: np.ndarray, last: int) -> list[int]:
    """The state before the lines, then that of each line, given the last."""
    path = [last]
    for t in range(len(back) - 1, -1, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


def counts(lines: list[str], states: list[int], before: int = START, last: int | None = None) -> np.ndarray:
    """What a labelled run of lines adds to the counts that a model is fitted from. ``last``: the state before the run."""
    first, step, emit = np.zeros(K), np.zeros((K, K)), [np.zeros((K, n)) for n in SIZES]
    if lines:
        if last is None:
            first[states[0]] += 1
        else:
            step[last, states[0]] += 1
        np.add.at(step, (states[:-1], states[1:]), 1)
        f = features(lines, before)
        for i in range(len(SIZES)):
            np.add.at(emit[i], (states, f[:, i]), 1)
    return np.concatenate([x.ravel() for x in (first, step, *emit)])


def fit(total: np.ndarray, smooth: float = 0.5) -> Model:
    """A model from summed counts, smoothed. A role's further lines only follow a line of that role."""
    cut = np.cumsum([K, K * K, *(K * n for n in SIZES)])[:-1]
    first, step, *emit = np.split(total + smooth, cut)
    step, emit = step.reshape(K, K), [e.reshape(K, n) for e, n in zip(emit, SIZES, strict=True)]
    for i, (role, begins) in enumerate(STATES):
        if not begins:
            first[i] = 1e-9
            for j, (other, _) in enumerate(STATES):
                if other != role:
                    step[j, i] = 1e-9
    log = lambda x: np.rint(UNIT * np.log(x / x.sum(axis=-1, keepdims=True))).astype(np.int64)
    return Model(log(first), log(step), [log(e) for e in emit])


def render_raw(key: str, number: str, role: str | None, text: str | None, drop: float = 0.1) -> tuple[list[str], list[int]]:
    """A turn's raw lines and their states, in the style that ``key`` chooses; some turns (by ``number``) have no marker."""
    h = hashlib.md5(key.encode()).digest()
    role = role if role in ROLES else "user"
    bare = hashlib.md5(f"{key}/{number}".encode()).digest()[0] < 256 * drop
    lines = (("" if bare else STYLES[h[0] % len(STYLES)][role]) + (text or "")).split("\n")
    if h[0] & 128:
        lines.append("")
    return lines, [STATES.index((role, i == 0)) for i in range(len(lines))]


def turns_of(lines: list[str], states: list[int], first: bool = True) -> list[tuple[str | None, list[str]]]:
    """Runs of lines by turn, markers gone; where the lines begin within a turn (``first`` is false), its run comes first, without a role."""
    turns: list[tuple[str | None, list[str]]] = []
    for s, state in zip(lines, states, strict=True):
        role, begins = STATES[state]
        if begins or (first and not turns):
            kind, n = marker(s)
            turns.append((role, [s[n:] if kind in ROLES or (kind == "other" and s[:2] in ("- ", "* ", "> ")) else s]))
        elif turns:
            turns[-1][1].append(s)
        else:
            turns.append((None, [s]))
    return turns


def parse(model: Model, transcript: str | None) -> list[tuple[str, str]]:
    """Turns (role, text) of a transcript: markers go, blank lines at the ends of a turn too. An empty transcript has none."""
    if not transcript or not transcript.strip():
        return []
    lines = transcript.split("\n")
    return [(r, "\n".join(x).strip()) for r, x in turns_of(lines, model.viterbi(lines))]


def in_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` sorted over the whole table, by ranges: a conversation may span many partitions.

    Rows of one turn number, and turns without a number, go by a hash of role and text. Repeated rows stay; in quantity they spread.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    order = ["conv_id", "turn", "h", "copy"]
    return spread(rows).repartitionByRange(*order).sortWithinPartitions(*order, "role", "text").select("conv_id", "turn", "role", "text", "copy")


def key_of(c: int | None) -> str:
    return "none" if c is None else str(c)


def fit_on(conversations: DataFrame, sample: int = 20_000) -> Model:
    """Fit on ``sample`` turns at most, those of the conversations with the least hashes; what is gathered are counts."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.orderBy(F.xxhash64("conv_id"), "conv_id", "turn", F.xxhash64("role", "text")).limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, now, before, last = counts([], []), object(), START, None
        for b in batches:
            for r in b.to_pylist():
                if r["conv_id"] != now:
                    now, before, last = r["conv_id"], START, None
                lines, states = render_raw(key_of(now), f"{r['turn']}", r["role"], r["text"])
                total += counts(lines, states, before, last)
                before, last = PLAIN if lines[-1].strip() else BLANK, states[-1]
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    got = rows.mapInArrow(run, "total array<double>").toArrow().column("total").to_pylist()
    return fit(np.sum(got, axis=0) if got else counts([], []))


def transcripts(conversations: DataFrame) -> DataFrame:
    """``(conv_id, part, transcript)``: raw transcripts, one a conversation and partition, ``part`` rising in a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        now: tuple = ()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array(["\n".join(held)])], ["conv_id", "part", "transcript"])

        for b in batches:
            for r in b.to_pylist():
                if now != (r["conv_id"], r["part"]):
                    if held:
                        yield out()
                    now, held = (r["conv_id"], r["part"]), []
                held += render_raw(key_of(r["conv_id"]), f"{r['turn']}", r["role"], r["text"])[0]
        if held:
            yield out()

    return in_order(conversations).withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, "conv_id long, part long, transcript string")


def over(rows: DataFrame, f: Callable[[list[dict]], list[tuple]], columns: str) -> DataFrame:
    """``f`` of the rows of each conversation, in the order of pieces."""
    schema = pa.schema([(n, KINDS[k]) for n, k in (c.split() for c in columns.split(", "))])

    def run(t: pa.Table) -> pa.Table:
        out = f(sorted(t.to_pylist(), key=lambda r: r["part"]))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return rows.groupBy("conv_id").applyInArrow(run, columns)


def mapped(rows: DataFrame, f: Callable[[dict], list[tuple]], columns: str) -> DataFrame:
    schema = pa.schema([(n, KINDS[k]) for n, k in (c.split() for c in columns.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                if out := [x for r in b.slice(i, 64).to_pylist() for x in f(r)]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return rows.mapInArrow(run, columns)


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}


def parse_transcripts(raw: DataFrame, model: Model) -> DataFrame:
    """``raw(conv_id, part, transcript)`` -> ``(conv_id, turn, role, text, rendered)``, a row a recovered turn.

    A conversation's transcript is that of its pieces in the order of ``part``, line after line; where it is cut does not
    matter, but a turn's text is one string. Conversations of one null or blank transcript give no rows. Null ids are one conversation.
    Pieces with equal (conv_id, part), repeated rows too, follow each other in the order of their texts. A null ``part`` comes first.
    Empty tables give no rows; other columns are not read.
    """
    raw = raw.select(F.col("conv_id").cast("long"), F.coalesce(F.col("part").cast("long"), F.lit(-(1 << 62))).alias("part"), F.col("transcript").cast("string"))
    raw = materialize(raw, "raw")
    if not raw.groupBy("conv_id", "part").count().where("count > 1").isEmpty():
        raw = raw.groupBy("conv_id", "part").agg(F.array_join(F.sort_array(F.collect_list("transcript")), "\n").alias("transcript"))
    many = raw.groupBy("conv_id").agg(F.count("*").alias("c"), F.min("part").alias("first")).where("c > 1").select(F.col("conv_id").alias("cc"), "first")
    known = materialize(raw.join(many, F.col("conv_id").eqNullSafe(F.col("cc")), "left").withColumn("long", F.col("first").isNotNull()).drop("cc"), "pieces")
    whole = mapped(known.where("not long"), lambda r: [(r["conv_id"], i, role, text) for i, (role, text) in enumerate(parse(model, r["transcript"]))], "conv_id long, turn long, role string, text string")
    long = known.where("long").select("conv_id", "part", "first", F.coalesce("transcript", F.lit("")).alias("transcript"))
    lines_of = lambda r: r["transcript"].split("\n")

    def summary(r: dict) -> list[tuple]:
        x, begins = lines_of(r), r["part"] == r["first"]
        spans = [model.span(x, START).ravel().tolist()] * 2 if begins else [model.span(x, k).ravel().tolist() for k in (PLAIN, BLANK)]
        return [(r["conv_id"], r["part"], *spans, BLANK if not x[-1].strip() else PLAIN)]

    def starts(rows: list[dict]) -> list[tuple]:
        """The scores before each piece, and what kind of line comes before it."""
        out, now, before = [], np.zeros(K, np.int64), START
        for r in rows:
            out.append((r["conv_id"], r["part"], now.tolist(), before))
            span = np.array(r["blank" if before == BLANK else "plain"]).reshape(K, K)
            now, before = (now[:, None] + span).max(axis=0), r["last"]
        return out

    def ends(r: dict) -> list[tuple]:
        """For each state at the end: its score, the state before the piece, turns that begin in it, and whether it begins with one."""
        now, back = model.forward(lines_of(r), r["before"], None if r["before"] == START else np.array(r["start"]))
        paths = [traced(back, q) for q in range(K)]
        fresh = [BEGINS[p[1:]] | (np.arange(len(p) - 1) == 0) * (r["before"] == START) for p in paths]
        return [(r["conv_id"], r["part"], now.tolist(), [p[0] for p in paths], [int(x.sum()) for x in fresh], [int(x[0]) for x in fresh])]

    def chosen(rows: list[dict]) -> list[tuple]:
        """The state at the end of each piece, turns before it, and whether a turn goes on past its end."""
        state, out, goes_on = int(np.argmax(rows[-1]["score"])), [], False
        for r in reversed(rows):
            out.append([r["conv_id"], r["part"], state, r["turns"][state], goes_on])
            goes_on, state = not r["begins"][state], r["prior"][state]
        done, n = [], 0
        for c, part, state, turns, goes_on in reversed(out):
            done.append((c, part, state, n, goes_on))
            n += turns
        return done

    def turns(r: dict) -> list[tuple]:
        x = lines_of(r)
        _, back = model.forward(x, r["before"], None if r["before"] == START else np.array(r["start"]))
        got, out = turns_of(x, traced(back, r["state"])[1:], r["before"] == START), []
        at = r["turns"] - (got[0][0] is None)
        for i, (role, some) in enumerate(got):
            piece = role is None or (i == len(got) - 1 and r["goes_on"])
            out.append((r["conv_id"], at + i, r["part"], role, "\n".join(some), piece))
        return out

    at = ["conv_id", "part"]
    both = lambda a, b: a.join(b.select(*(F.col(c).alias(f"_{c}") if c in at else F.col(c) for c in b.columns)), F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("part") == F.col("_part"))).drop("_conv_id", "_part")
    sums = mapped(long, summary, "conv_id long, part long, plain array<long>, blank array<long>, last int")
    begun = materialize(both(long, over(sums, starts, "conv_id long, part long, start array<long>, before int")), "begun")
    told = mapped(begun, ends, "conv_id long, part long, score array<long>, prior array<long>, turns array<long>, begins array<long>")
    last = over(told, chosen, "conv_id long, part long, state long, turns long, goes_on boolean")
    got = materialize(mapped(both(begun, last), turns, "conv_id long, turn long, part long, role string, text string, piece boolean"), "turns")
    joined = got.where("piece").groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("part", "role", "text"))).alias("x"))
    joined = joined.select("conv_id", "turn", F.get(F.filter(F.transform("x", lambda p: p["role"]), lambda r: r.isNotNull()), F.lit(0)).alias("role"), F.array_join(F.transform("x", lambda p: p["text"]), "\n").alias("text"))
    parts = got.where("not piece").select("conv_id", "turn", "role", "text").unionByName(joined).withColumn("text", F.regexp_replace("text", EDGES, ""))
    some = F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.replace(F.col("text"), F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>")
    return whole.unionByName(parts).withColumn("rendered", F.concat(*some))


#: White space as Python strips it, at the ends of a text.
SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
EDGES = f"^{SPACE}+|{SPACE}+\\z"


def canonical(role: str, text: str) -> str:
    return f"<|im_start|>{role}\n{text.replace('<|', '< |')}<|im_end|>"
