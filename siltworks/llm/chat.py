"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is a text, or a row of texts where it is long.  Its lines carry a
hidden state, a role and whether the line begins a turn, and show features: a
speaker marker at the front, length, a question mark, and whether a blank line
or the start of the text comes before.  Viterbi decoding recovers the roles;
lines of a turn are joined and rendered in canonical form.

Conversations of any length are cut into segments that fit a task, and decoded
as one text all the same: a segment is summed up as a matrix of the best scores
from each state before it to each state at its end, a pass over these matrices
finds the states at the borders, and each segment is then decoded between them.

The model's probabilities are counts over the first ``TRAIN_TURNS`` turns of at
most ``TRAIN_CONVERSATIONS`` labelled conversations, those of the least hashes;
their texts are read whole, where they lie, and only counts reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .workspace import Workspace, ship

TRAIN_CONVERSATIONS, TRAIN_TURNS = 500, 32
#: Turns, and characters, of a conversation that a task holds at a time; results do not depend on them.
SEGMENT, SEGMENT_CHARS = 256, 1 << 20
ROLES = ("system", "user", "assistant", "tool")
_NAMES = {
    "system": "system|sys|instructions?", "user": "user|human|question|q|prompt|customer|person|me",
    "assistant": "assistant|ai|bot|answer|a|gpt|model|agent|response", "tool": "tool|function|observation|tool result",
}
_MARKER = re.compile(r"^\s{0,8}(?:[#>*\[(<|-]{1,4}\s{0,2})?(?:" + "|".join(f"(?P<{k}>{v})" for k, v in _NAMES.items()) + r")\s?\d{0,4}\s{0,2}(?:[\])>*|]{0,4}:|[\])>*|]{1,4})\s{0,4}", re.I)
#: Lines a transcript writer puts before a turn, by style; fixed forms of common transcript formats.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: ", "tool": "Tool: "},
    {"system": "### System: ", "user": "### Human: ", "assistant": "### Assistant: ", "tool": "### Tool: "},
    {"system": "[system] ", "user": "[user] ", "assistant": "[assistant] ", "tool": "[tool] "},
    {"system": "SYSTEM: ", "user": "Q: ", "assistant": "A: ", "tool": "Observation: "},
)
START, END = "<|im_start|>", "<|im_end|>"


def observe(text: str, gap: int = 2) -> list[tuple[str, str, tuple[int, int, int, int]]]:
    """(line, line without its marker, features) of the non-blank lines; gap is 2 at the start of a transcript, 1 behind a blank line."""
    out = []
    for line in text.split("\n"):
        if not line.strip():
            gap = max(gap, 1)
            continue
        m = _MARKER.match(line)
        role = 0 if m is None else 1 + ROLES.index(m.lastgroup)
        bare = line[m.end() :] if m else line
        n = len(bare)
        out.append((line, bare, (role, (n > 40) + (n > 120) + (n > 300), int(bare.rstrip().endswith("?")), gap)))
        gap = 0
    return out


class RoleModel:
    """States are 2 * role + (0 if the line begins a turn, 1 if it goes on)."""

    SIZES = (1 + len(ROLES), 4, 2, 3)

    def __init__(self) -> None:
        n = 2 * len(ROLES)
        self.first = np.full(n, 0.5)
        self.first[1::2] = 1e-3
        self.step = np.full((n, n), 0.1)
        for r in range(len(ROLES)):
            for s in range(len(ROLES)):
                self.step[2 * r : 2 * r + 2, 2 * s + 1] = 0.5 if r == s else 1e-6  # a turn goes on only in its own role
        self.show = [np.full((n, k), 0.2) for k in self.SIZES]
        for r in range(len(ROLES)):  # a marker speaks for its own role, at the start of a turn
            self.show[0][2 * r, 1 + r] += 4
            self.show[0][2 * r + 1, 1:] = 0.01

    def count_turn(self, role: int, lines: int, first: tuple, others: list[int], last: int | None) -> None:
        """Add a turn: its first line's features, counts of its other lines' features, and the state before it."""
        s, at = 2 * role, 0
        for table, v, size in zip(self.show, first, self.SIZES):
            table[s, v] += 1
            table[s + 1] += others[at : at + size]
            at += size
        if last is None:
            self.first[s] += 1
        else:
            self.step[last, s] += 1
        if lines > 1:
            self.step[s, s + 1] += 1
            self.step[s + 1, s + 1] += lines - 2

    def _scores(self, seen: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.array(seen)
        return sum(np.log(t / t.sum(1, keepdims=True)).T[x[:, k]] for k, t in enumerate(self.show)), np.log(self.step / self.step.sum(1, keepdims=True))

    def start(self) -> np.ndarray:
        return np.log(self.first / self.first.sum())

    def summary(self, seen: list[tuple[int, int, int, int]], first: bool) -> np.ndarray:
        """Best scores of each state at the lines' end, from each state before them or from the start of a text."""
        show, step = self._scores(seen)
        a = (self.start()[None] if first else step) + show[0]
        for row in show[1:]:
            a = (a[:, :, None] + step).max(1) + row
        return a

    def decode(self, seen: list[tuple[int, int, int, int]], enter: int | None = None, leave: int | None = None) -> list[int]:
        """The likeliest states by Viterbi, between the state before and the last one if given; of equals, the one that comes first."""
        if not seen:
            return []
        show, step = self._scores(seen)
        a, back = (self.start() if enter is None else step[enter]) + show[0], []
        for row in show[1:]:
            z = a[:, None] + step
            back.append(z.argmax(0))
            a = z.max(0) + row
        state = int(a.argmax()) if leave is None else leave
        out = [state]
        for b in reversed(back):
            state = int(b[state])
            out.append(state)
        return out[::-1]


def parse_part(text: str | None, model: RoleModel, gap: int = 2, enter: int | None = None, leave: int | None = None) -> list[tuple[bool, str, int, str]]:
    """(begins, role, lines, content) of each recovered turn; the first may go on from the part before."""
    rows = observe(text or "", gap)
    turns: list[list] = []
    for (line, bare, _), s in zip(rows, model.decode([x for *_, x in rows], enter, leave)):
        begins = s % 2 == 0
        if begins or not turns:
            turns.append([begins or enter is None, ROLES[s // 2], 1, [bare if begins else line]])
        else:
            turns[-1][2] += 1
            turns[-1][3].append(line)
    return [(b, r, n, "\n".join(c)) for b, r, n, c in turns]


def parse(text: str | None, model: RoleModel) -> list[tuple[str, int, str]]:
    """(role, lines, content) of each recovered turn."""
    return [(r, n, c.strip()) for _, r, n, c in parse_part(text, model)]


def render(role: str, content: str) -> str:
    """A turn in canonical form; what reads as a marker of that form is taken out of the content, however nested."""
    while START in content or END in content:
        content = content.replace(START, "").replace(END, "")
    return f"{START}{role}\n{content}{END}\n"


_COUNTS = (RoleModel.SIZES, sum(RoleModel.SIZES))


def _turn_counts(text: str, role: int) -> tuple[int, list[int], list[int]]:
    """Lines of a turn, the first line's features without its gap, and counts of the other lines' features."""
    lines = [x for *_, x in observe(text, 1)]
    counts = [0] * _COUNTS[1]
    for x in lines[1:]:
        at = 0
        for v, size in zip(x, _COUNTS[0]):
            counts[at + v] += 1
            at += size
    return len(lines), list(lines[0]) if lines else [], counts


def train(conversations: DataFrame, most: int = TRAIN_CONVERSATIONS) -> RoleModel:
    """Count a model from (conv_id, turn, role, text), written as transcripts of several styles.

    Rows without a conversation, a turn number or a known role are not counted;
    equal rows count once.  Without any, the model keeps its first guesses.
    """
    ship(conversations.sparkSession)
    conversations = conversations.select("conv_id", "turn", "role", "text")
    ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").alias("of")).distinct().orderBy(F.xxhash64("of"), "of").limit(most)
    rows = conversations.join(F.broadcast(ids), F.col("conv_id") == F.col("of")).where(F.col("turn").between(0, TRAIN_TURNS - 1) & F.col("role").isin(*ROLES))
    rows = rows.select(F.xxhash64("conv_id").alias("conv"), "turn", "role", F.concat(_front(), F.coalesce("text", F.lit(""))).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            role = [ROLES.index(x) for x in b.column(2).to_pylist()]
            n, first, counts = zip(*map(_turn_counts, b.column(3).to_pylist(), role)) if role else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(role, pa.int32()), pa.array(n, pa.int64()), pa.array(first, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["conv", "turn", "role", "n", "first", "counts"])

    picked = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    model, now, last = RoleModel(), None, None
    # a row of numbers for each turn of the bounded sample
    for r in picked.mapInArrow(run, "conv bigint, turn bigint, role int, n bigint, first array<int>, counts array<int>").orderBy("conv", "turn", "role", "n", "first", "counts").limit(most * TRAIN_TURNS).collect():
        if r.conv != now:
            now, last = r.conv, None
        if r.n:
            model.count_turn(r.role, r.n, (*r.first[:3], 2 if last is None else 1), r.counts, last)
            last = 2 * r.role + (r.n > 1)
    return model


def _style() -> Column:
    return F.pmod(F.xxhash64(F.col("conv_id")), F.lit(len(STYLES))).cast("int")


def _marked() -> Column:
    """Four turns of five carry a marker."""
    return F.pmod(F.xxhash64(F.col("conv_id"), F.col("turn")), F.lit(5)) > 0


def _front() -> Column:
    """What a transcript writer puts before a turn."""
    front = F.lit("")
    for k, style in enumerate(STYLES):
        for role, mark in style.items():
            front = F.when((_style() == k) & (F.col("role") == role) & _marked(), mark).otherwise(front)
    return front


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, segment, text): conversations as texts, cut into segments that rise within a conversation.

    Turns are ordered by number, those without one last, then by role (system,
    user, assistant, tool, others) and a hash of the text, and parted by a blank
    line; equal numbered rows count once.  Some turns have no marker.  Rows are
    dealt by ranges of that order, so a conversation of any length is spread over
    tasks, and a null conv_id is a conversation of its own.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")), F.lit(0))
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(rank == 0, len(ROLES) + 1).otherwise(rank).alias("rank"), "role", F.coalesce("text", F.lit("")).alias("text"), _front().alias("front"))
    order = F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("rank"), F.col("role"), F.xxhash64("text")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "front", F.spark_partition_id().cast("bigint").alias("part"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size, number, before = [], [], 0, 0, None
        for b in batches:
            for c, turn, role, text, front, part in zip(*(x.to_pylist() for x in b.columns)):
                if turn is not None and (c, turn, role, text) == before:
                    continue
                if held and (c != before[0] or len(held) == SEGMENT or size + len(text) > SEGMENT_CHARS):
                    made.append((before[0], (part << 33) + number, "\n\n".join(held)))
                    held, size, number = [], 0, number + 1
                held.append(front + text)
                size, before, at = size + len(text), (c, turn, role, text), part
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*made), (b.schema.field(0).type, pa.int64(), pa.string()))], ["conv_id", "segment", "text"])
                made = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([before[0]], b.schema.field(0).type), pa.array([(at << 33) + number]), pa.array(["\n\n".join(held)])], ["conv_id", "segment", "text"])

    return rows.mapInArrow(run, f"`conv_id` {kind}, segment bigint, text string")


RESULTS = ("turn_no", "role", "n_lines", "rendered")


def _unlike(names: list[str]) -> dict[str, str]:
    """New names of input columns that a result's name would clash with, in whatever case."""
    return {c: f"in_{c}" for c in names if c.lower() in RESULTS}


def format_transcripts(texts: DataFrame, model: RoleModel, text: str = "text") -> DataFrame:
    """A row for each recovered turn: the other columns of texts, turn_no, role, n_lines, rendered.

    Null and blank transcripts have no turns; an empty table gives none.  Each
    row is a transcript of its own and decoded whole, repeated rows too.  Input
    columns named like a result get the prefix `in_`.
    """
    ship(texts.sparkSession)
    keep = [c for c in texts.columns if c != text]
    picked = texts.select(*(F.col(f"`{c}`").alias(_unlike(keep).get(c, c)) for c in keep), F.col(f"`{text}`").cast("string").alias("__text"))
    keep = picked.columns[:-1]
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in picked.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                rows = [(k, n, role, lines, render(role, content)) for k, t in enumerate(part.column(len(keep)).to_pylist()) for n, (role, lines, content) in enumerate(parse(t, model))]
                if rows:
                    k, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(k)) for c in part.columns[:-1]), *map(pa.array, rest)], [*keep, *RESULTS])

    return picked.mapInArrow(run, head + "turn_no bigint, role string, n_lines bigint, rendered string")


def _borders(ws: Workspace, parts: DataFrame, model: RoleModel) -> DataFrame:
    """(of, part, enter, leave): the states before and at the end of the parts (of, part, text) of long transcripts.

    enter is null at the start of a transcript; parts without a line have no
    row.  Rows of numbers stream by in the order of the parts, and back again,
    so a transcript of many parts costs its task time, not memory.
    """

    n = 2 * len(ROLES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, rows = [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                if opening := [x for *_, x in observe(text or "")]:
                    later = [(*opening[0][:3], 1), *opening[1:]]
                    m.append(np.concatenate([model.summary(opening, True).ravel(), model.summary(later, False).ravel()]))
                    rows.append(k)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(m, pa.list_(pa.float64()))], ["of", "part", "m"])

    def ends(m: list[float], a: list[float] | None) -> np.ndarray:
        """Scores from the states before to those at the end of a part, with one row at the start of a transcript."""
        m = np.array(m)
        return m[None, :n] if a is None else np.array(a)[:, None] + m[n:].reshape(n, n)

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, a = None, None
        for b in batches:
            before = []
            for of, m in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                now, a = of, a if of == now else None
                before.append(a)
                a = ends(m, a).max(0).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before, pa.list_(pa.float64()))], ["of", "part", "m", "a"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            enter, leave = [], []
            for of, m, a in zip(*(b.column(k).to_pylist() for k in (0, 2, 3))):
                z = ends(m, a)
                state = state if of == now else int(z.max(0).argmax())
                leave.append(state)
                now, state = of, int(z[:, state].argmax())
                enter.append(None if a is None else state)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(enter, pa.int32()), pa.array(leave, pa.int32())], ["of", "part", "enter", "leave"])

    head = "of string, part bigint, "
    rows = parts.mapInArrow(sums, head + "m array<double>").repartition("of").sortWithinPartitions("of", "part")
    rows = ws.save(rows.mapInArrow(onward, head + "m array<double>, a array<double>"), "onward")
    rows = rows.repartition("of").sortWithinPartitions("of", F.col("part").desc())
    return ws.save(rows.mapInArrow(back, head + "enter int, leave int"), "borders")


def format_parts(texts: DataFrame, model: RoleModel, key: str = "conv_id", part: str = "segment", text: str = "text") -> DataFrame:
    """(key, turn_no, role, n_lines, rendered): rows of one key are one transcript, in the order of part.

    Parts are as if parted by a blank line, and turns may run over them.  Most
    transcripts are one part and stay where they lie.  Null keys are one key;
    null and blank parts add nothing; equal parts of a key have no order.
    """
    ws = Workspace(texts.sparkSession, "chat")
    of = F.concat(F.when(F.col(key).isNull(), "n").otherwise("v"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = ws.save(texts.select(F.col(key).alias("key"), of.alias("of"), F.col(part).cast("bigint").alias("part"), F.col(text).cast("string").alias("text")), "parts")
    long = ws.save(rows.groupBy("of").agg(F.count("*").alias("n")).where("n > 1").select(F.col("of").alias("of_long")), "long")
    kind = rows.schema["key"].dataType.simpleString()
    single = format_transcripts(rows.join(long, F.col("of") == F.col("of_long"), "left_anti").select("key", "text"), model)
    if long.isEmpty():
        return single.withColumnRenamed("key", key)
    many = rows.join(long, F.col("of") == F.col("of_long"))
    ends = _borders(ws, many.select("of", "part", "text"), model)
    ends = ends.select(F.col("of").alias("of_end"), F.col("part").alias("part_end"), "enter", "leave")
    known = many.join(ends, (F.col("of") == F.col("of_end")) & (F.col("part") == F.col("part_end"))).select("key", "of", "part", "text", "enter", "leave")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 32):
                some = b.slice(at, 32)
                rows = []
                for k, (t, enter, leave) in enumerate(zip(*(c.to_pylist() for c in some.columns[3:]))):
                    turns = parse_part(t, model, 2 if enter is None else 1, enter, leave)
                    rows += [(k, n, *x) for n, x in enumerate(turns, 0 if turns[0][0] else -1)]  # -1: the last turn before this part
                if rows:
                    k, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(k)) for c in some.columns[:3]), *map(pa.array, rest)], ["key", "of", "part", "n", "begins", "role", "n_lines", "content"])

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([render(r, c.strip()) for r, c in zip(b.column(2).to_pylist(), b.column(4).to_pylist())], pa.string())], ["key", *RESULTS])

    found = ws.save(known.mapInArrow(pieces, f"key {kind}, of string, part bigint, n bigint, begins boolean, role string, n_lines bigint, content string"), "pieces")
    # how many turns begin before a part: one row a part in each window
    counts = found.groupBy("of", "part").agg(F.count_if("begins").alias("begun"))
    upto = F.sum("begun").over(W.Window.partitionBy("of").orderBy("part").rowsBetween(W.Window.unboundedPreceding, 0))
    counts = counts.select(F.col("of").alias("of_count"), F.col("part").alias("part_count"), (upto - F.col("begun")).alias("before"))
    numbered = found.join(counts, (F.col("of") == F.col("of_count")) & (F.col("part") == F.col("part_count"))).withColumn("turn_no", F.col("before") + F.col("n"))
    merged = numbered.groupBy("key", "of", "turn_no").agg(F.min_by("role", "part").alias("role"), F.sum("n_lines").alias("n_lines"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "content"))), lambda x: x.content), "\n").alias("content"))
    return single.unionByName(merged.select("key", "turn_no", "role", "n_lines", "content").mapInArrow(rendered, f"key {kind}, turn_no bigint, role string, n_lines bigint, rendered string")).withColumnRenamed("key", key)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return format_parts(transcripts(rows), train(rows))


QUERIES = {"op9_chat_format": op9_chat}
