"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns (operator 8)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

ROLES = ("system", "user", "assistant")
#: A state is a role and whether the line opens a turn or continues one.
STATES = [(r, first) for r in ROLES for first in (True, False)]
#: What can be a speaker marker: a name in one of four forms. It is one only if the model has learned it as a speaker's.
MARKER = re.compile(r"\s*(?:#{1,4}\s*(\w{1,20}):?\s*$|(?:<\|(\w{1,20})\|>|\[(\w{1,20})\]) ?|\*{0,2}(\w{1,20})\*{0,2}:(?: |$))")
FORMS = ("# {}", "<|{}|>", "[{}]", "{}:")
#: A log-probability that outweighs all others.
NEVER = -1e4


def split_marker(line: str) -> tuple[str, str | None]:
    """(what can be a speaker marker, lower-cased in its form, or '', the rest of the line); the rest is None if the marker has the line to itself."""
    m = MARKER.match(line)
    if not m:
        return "", line
    form, name = next((f, g) for f, g in zip(FORMS, m.groups(), strict=True) if g)
    rest = line[m.end() :]
    return form.format(name.lower()), rest if rest or m[0][-1] == " " and not m[1] else None


def plain_features(line: str) -> tuple[str, ...]:
    """Of a line without speaker marker; a blank one says nothing."""
    end = line.rstrip()[-1:]
    return ("m:", f"w:{min(10, len(line.split()).bit_length())}", f"e:{end if end in '?.!:,' else 'x'}") if end else ("m:",)


def features(line: str) -> tuple[str, ...]:
    marker = split_marker(line)[0]
    return (f"m:{marker}",) if marker else plain_features(line)


class RoleHMM:
    """Start, step and feature log-probabilities of the states; features are independent given the state.

    A marker name is a speaker's if nearly all lines that carry it open a turn of one role; such a line
    always does. Other names, as of headings, notes or footnotes, say nothing and stay in the text.
    A blank line opens no turn, nor does a line without a speaker's marker just after one that has its line to itself. Values of a feature never seen in training say nothing either.
    """

    def __init__(self, start: dict, step: dict, seen: dict, smooth: float = 0.5, least: int = 5, sure: float = 0.9):
        n = len(STATES)
        self.start = np.log(np.array([start.get(i, 0) + smooth * STATES[i][1] + 1e-9 for i in range(n)]))
        self.step = np.log(np.array([[step.get((i, j), 0) + smooth * (STATES[j][1] or STATES[i][0] == STATES[j][0]) + 1e-9 for j in range(n)] for i in range(n)]))
        self.start -= np.log(np.exp(self.start).sum())
        self.step -= np.log(np.exp(self.step).sum(axis=1, keepdims=True))
        by = {}
        for (s, f), c in seen.items():
            by.setdefault(f, np.zeros(n))[s] += c
        #: The state that a line with a speaker's marker is in.
        self.speakers = {f[2:]: int(c.argmax()) for f, c in by.items() if f[:2] == "m:" and len(f) > 2 and c.sum() >= least and STATES[c.argmax()][1] and c.max() >= sure * c.sum()}
        kinds: dict[str, dict] = {}
        for f, c in by.items():  # rare values of a kind share its unknown value
            if f[:2] == "m:":
                f = f if f[2:] in self.speakers else "m:"
            elif c.sum() < least:
                f = f[:2] + "?unknown"
            k = kinds.setdefault(f[:2], {})
            k[f] = k.get(f, 0) + c
        self.emit, self.unknown = {}, {}
        for k, values in kinds.items():
            mass = sum(values.values()) + smooth * len(values)
            self.emit |= {f: np.log((c + smooth) / mass) for f, c in values.items()}
            self.unknown[k] = self.emit.get(k + "?unknown", np.zeros(n))

    def emissions(self, lines: list[str]) -> np.ndarray:
        """Log-probabilities (lines, states)."""
        e = np.zeros((len(lines), len(STATES)))
        opens, alone = np.array([first for _, first in STATES]), False
        for i, x in enumerate(lines):
            marker, rest = split_marker(x)
            speaker = self.speakers.get(marker)
            for f in plain_features(x) if speaker is None else (f"m:{marker}",):
                e[i] += self.emit.get(f, self.unknown.get(f[:2], 0.0))
            if speaker is not None:
                e[i] += np.where(np.arange(len(STATES)) == speaker, 0.0, NEVER)
            elif alone or not x.strip():
                e[i] += np.where(opens, NEVER, 0.0)
            alone = speaker is not None and rest is None
        return e

    def decode(self, lines: list[str]) -> list[int]:
        """The most likely states, by Viterbi."""
        e = self.emissions(lines)
        best, back = self.start + e[0], []
        for i in range(1, len(lines)):
            t = best[:, None] + self.step
            back.append(t.argmax(axis=0))
            best = t.max(axis=0) + e[i]
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def text_of(self, line: str) -> str | None:
        """The line without a speaker's marker, all else as it is; None if nothing else is in it."""
        marker, rest = split_marker(line)
        return rest if marker in self.speakers else line


def transcript_lines(turns: DataFrame, raw: Column) -> DataFrame:
    """turns(conv_id, turn, ...) -> the same with (at, line): raw text of each turn in lines; turn and at order them."""
    return turns.withColumn("turn", F.coalesce(F.col("turn").cast("long"), F.lit(0))).select("*", F.posexplode(F.split(F.coalesce(raw, F.lit("")), "\n", -1)).alias("at", "line"))


def _segments(lines: DataFrame, span: int, overlap: int) -> DataFrame:
    """Adds seg; the turns at either end of a segment also go to its neighbour as context (own = false)."""
    seg, place = F.floor(F.col("turn") / span), F.pmod("turn", F.lit(span))
    to = lambda which, own, when: F.when(when, F.struct(which.alias("seg"), F.lit(own).alias("own")))
    every = F.array(to(seg, True, F.lit(True)), to(seg + 1, False, place >= span - overlap), to(seg - 1, False, place < overlap))
    return lines.select("*", F.inline(F.array_compact(every)))


def train(lines: DataFrame, span: int = 256) -> RoleHMM:
    """lines(conv_id, turn, at, line, role) -> the model, from counts over all lines with a known role.

    Only counts by state and feature value reach the driver; feature values seen in fewer than five
    lines are counted as one.
    """
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("fs", pa.array([features(x) for x in b.column("line").to_pylist()], pa.list_(pa.string()))).select(["conv_id", "seg", "turn", "at", "state", "fs"])

    state = F.coalesce(*[F.when((F.col("role") == r) & ((F.col("at") == 0) == first), F.lit(i)) for i, (r, first) in enumerate(STATES)])
    known = lines.where(F.col("role").isin(*ROLES)).select("conv_id", F.floor(F.col("turn") / span).alias("seg"), "turn", "at", state.alias("state"), "line")
    known = known.mapInArrow(mark, "conv_id long, seg long, turn long, at int, state int, fs array<string>")
    before = F.lag("state").over(Window.partitionBy("conv_id", "seg").orderBy("turn", "at", "state"))
    steps = known.select("state", before.alias("before"), "seg", "fs")
    counts = steps.where("before is not null or seg = 0").groupBy("before", "state").count().collect()
    seen = steps.select("state", F.explode("fs").alias("f")).groupBy("f", "state").count()
    frequent = seen.groupBy("f").agg(F.sum("count").alias("n"))
    seen = seen.join(frequent, "f").withColumn("f", F.when(F.col("n") >= 5, F.col("f")).otherwise(F.concat(F.substring("f", 1, 2), F.lit("?unknown"))))
    table = seen.groupBy("f", "state").agg(F.sum("count").alias("count")).collect()
    return RoleHMM({r["state"]: r["count"] for r in counts if r["before"] is None}, {(r["before"], r["state"]): r["count"] for r in counts if r["before"] is not None},
                   {(r["state"], r["f"]): r["count"] for r in table})


def recover_turns(lines: DataFrame, model: RoleHMM, span: int = 256, overlap: int = 4, most: int = 20_000, context: int = 16) -> DataFrame:
    """lines(conv_id, turn, at, line, ...) -> (conv_id, turn, at, nth, role, n_lines, rendered), one row a recovered turn.

    Lines are decoded in order of turn and at, a long conversation in segments of ``span`` turn numbers, each with
    ``overlap`` turns of either neighbour as context. A segment of more than ``most`` lines, as
    a very long turn or many rows under one turn number make it, is decoded piece by piece with ``context`` lines
    on either side, so no task holds more. A turn runs from an opening line to the next one and is rendered
    as ``<|role|>\\ntext\\n<|end|>``: all its lines as they are, blank ones too, but for the speaker's marker of the
    first; turn and at are its first line's, nth numbers the openings at one place. Every line is in one turn. An unmarked turn
    without text can't be told from a blank line and is one of the turn before. Null lines are empty ones; rows without
    conv_id form one conversation; repeated rows are repeated lines; other columns are ignored; an empty
    table gives an empty result.
    """
    held = _segments(lines.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("at").cast("int"), F.coalesce("line", F.lit("")).alias("line")), span, overlap)
    held = held.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "turn", "at", "line")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string())
    names = ["conv_id", "turn", "at", "nth", "role", "line_turn", "line_at", "line"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], int, int]]:
        """(lines, from, to): lines of one segment to decode together, and which of them count."""
        group, begin = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "seg", "turn", "at", "line", "own")), strict=True):
                if group and group[-1][:2] != row[:2]:
                    yield group, begin, len(group)
                    group, begin = [], 0
                elif len(group) >= most + 2 * context:
                    yield group, begin, len(group) - context
                    group, begin = group[-2 * context :], context
                group.append(row)
        if group:
            yield group, begin, len(group)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, nth, first = [], None, 0, None
        for group, begin, end in pieces(batches):
            if not begin:
                last = first = None
            for i, ((conv, _, turn, at, line, own), s) in enumerate(zip(group, model.decode([g[4] for g in group]), strict=True)):
                if not begin <= i < end:
                    continue
                nth = nth + 1 if last == (turn, at) else 0
                last = turn, at
                if first is None or STATES[s][1]:
                    first = turn, at, nth, STATES[s][0]
                if own:
                    out.append((conv, *first, turn, at, model.text_of(line)))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    found = held.mapInArrow(decode, "conv_id long, turn long, at int, nth long, role string, line_turn long, line_at int, line string")
    turns = found.groupBy("conv_id", "turn", "at", "nth", "role").agg(F.array_sort(F.collect_list(F.struct("line_turn", "line_at", "line"))).alias("x"))
    text = F.array_join(F.transform("x", lambda z: z["line"]), "\n")  # a null is a marker's own line
    return turns.select("conv_id", "turn", "at", "nth", "role", F.size("x").alias("n_lines"), F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"))


#: Speaker markers of raw logs by style: one for each of ROLES.
STYLES = (("System: ", "User: ", "Assistant: "), ("### System\n", "### Human\n", "### Response\n"), ("<|sys|> ", "<|usr|> ", "<|bot|> "), ("[note] ", "[q] ", "[a] "))


def raw_log(turns: DataFrame, omit: int = 9) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> lines(conv_id, turn, at, line, role) of raw logs.

    A conversation's log marks its speakers in one of STYLES; one turn in ``omit`` has no marker.
    """
    key = F.coalesce(F.crc32(F.col("conv_id").cast("string")), F.lit(0))
    mark = F.lit("")
    for s, style in enumerate(STYLES):
        for r, m in zip(ROLES, style, strict=True):
            mark = F.when((key % len(STYLES) == s) & (F.col("role") == r), m).otherwise(mark)
    shown = F.coalesce((key + F.col("turn")) % omit != 0, F.lit(True))
    raw = F.concat(F.when(shown, mark).otherwise(""), F.coalesce("text", F.lit("")))
    return transcript_lines(turns.select("conv_id", "turn", "role", "text"), raw).select("conv_id", "turn", "at", "line", "role")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text, ...) -> recovered turns of their raw logs.

    The model learns from logs of conversations whose crc32(conv_id) mod 5 is not 0; decoding sees lines
    only, never roles.
    """
    lines = Scratch(conversations.sparkSession, "transcripts").save(raw_log(conversations))
    model = train(lines.where(F.crc32(F.col("conv_id").cast("string")) % 5 != 0))
    return recover_turns(lines.drop("role"), model).drop("at", "nth")
