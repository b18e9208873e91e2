"""Conversation structure repair at least cost, by cost layers of grammar states (operator 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Faults of a row, the first that fits.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: States of the grammar (s?(ua)+)? : nothing yet, after s, after u, after a. The first and last accept.
START, S, U, A = range(4)
STEP = {("s", START): S, ("u", START): U, ("u", S): U, ("u", A): U, ("a", U): A}
#: The one state that a user's or an assistant's turn leads to.
NEXT = (U, U, A, U)
NONE = 1 << 60
#: Cost from each state to acceptance after the last row: turns still to insert.
END = [0, 2 * INSERT, INSERT, 0]
#: States from which a turn leads into a set of states; sets are bits.
BEFORE = {x: [sum(1 << q for q in range(4) if (x, q) in STEP and mask >> STEP[x, q] & 1) for mask in range(16)] for x in "sua"}
BEFORE_ANY = [sum(1 << q for q in range(4) if mask >> NEXT[q] & 1) for mask in range(16)]
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
WHITE = " \t\n\x0b\x0c\r"

Row = tuple[str, int]  # role's initial, fault


def layers(rows: list[Row], ends: list[int]) -> list[list[int]]:
    """out[cost][i]: the set of states at row i from which the rest costs exactly ``cost``, when state q after the last row costs ends[q].

    Layers are made by increasing cost until every state has its least cost at row 0.
    """
    m, base, out, seen = len(rows), min(ends), [], 0
    nothing = [0] * (m + 1)
    back = lambda cost: out[cost] if cost >= 0 else nothing
    while seen != 15:
        cost = len(out)
        inserted, deleted = back(cost - INSERT), back(cost - DELETE)
        kept_cut, reroled, reroled_cut = back(cost - CUT), back(cost - REROLE), back(cost - REROLE - CUT)
        layer = [0] * (m + 1)
        layer[m] = sum(1 << q for q, e in enumerate(ends) if e - base == cost)
        for i in range(m - 1, -1, -1):
            role, fault = rows[i]
            states = BEFORE_ANY[inserted[i]] | deleted[i + 1]
            if fault == TRUNCATED:
                states |= BEFORE_ANY[reroled_cut[i + 1]] | (BEFORE[role][kept_cut[i + 1]] if role in BEFORE else 0)
            elif not fault:
                states |= BEFORE_ANY[reroled[i + 1]] | (BEFORE[role][layer[i + 1]] if role in BEFORE else 0)
            layer[i] = states
        out.append(layer)
        seen |= layer[0]
    return out


def least(found: list[list[int]], q: int) -> int:
    """The first layer that holds state q at row 0."""
    return next(c for c, layer in enumerate(found) if layer[0] >> q & 1)


def trace(rows: list[Row], found: list[list[int]], q: int) -> tuple[str, int]:
    """(the least string of edits from state q at row 0, the state after the last row)."""
    cost, i, edits = least(found, q), 0, []
    at = lambda c, j, s: c >= 0 and found[c][j] >> s & 1
    while i < len(rows):
        role, fault = rows[i]
        cut = CUT * (fault == TRUNCATED)
        if at(cost - DELETE, i + 1, q):
            edits.append("D")
            cost, i = cost - DELETE, i + 1
        elif at(cost - INSERT, i, NEXT[q]):
            edits.append("I")
            cost, q = cost - INSERT, NEXT[q]
        elif fault in (0, TRUNCATED) and (role, q) in STEP and at(cost - cut, i + 1, STEP[role, q]):
            edits.append("K")
            cost, i, q = cost - cut, i + 1, STEP[role, q]
        else:
            edits.append("R")
            cost, i, q = cost - cut - REROLE, i + 1, NEXT[q]
    return "".join(edits), q


def costs(rows: list[Row]) -> list[int]:
    """Least cost from each state (rows of four) to each state across some rows, inserts before any of them counted.

    Back to ``START`` leads only the deletion of all rows, to ``S`` that of all but one.
    """
    out = [NONE] * 16
    out[4 * START + START] = out[4 * S + S] = DELETE * len(rows)
    firsts = [CUT * (fault == TRUNCATED) for role, fault in rows if role == "s" and fault in (0, TRUNCATED)]
    if firsts:
        out[4 * START + S] = DELETE * (len(rows) - 1) + min(firsts)
    for e in (U, A):
        found = layers(rows, [0 if q == e else NONE for q in range(4)])
        for q in range(4):
            out[4 * q + e] = least(found, q)
    return out


def _across(m: list[int], ends: list[int]) -> list[int]:
    return [min(NONE, *(m[4 * q + e] + ends[e] for e in range(4))) for q in range(4)]


def _both(a: list[int], b: list[int]) -> list[int]:
    """Figures of one stretch of rows and the next as those of both: 16 costs, first and last initial, illegal neighbours."""
    cost = [min(NONE, *(a[4 * q + k] + b[4 * k + e] for k in range(4))) for q in range(4) for e in range(4)]
    return [*cost, a[16], b[17], a[18] + b[18] + ((chr(a[17]), chr(b[16])) not in LEGAL)]


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Sorted rows by their first columns; a group is one piece or block, never a conversation."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, group in groupby(rows, key=itemgetter(*range(keys))):
        yield key, list(group)


def _arrow(names: list[str], kinds: list[pa.DataType], rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names=names)
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


_LONGS = pa.list_(pa.int64())


def _up(table: DataFrame, fan: int, both: Callable) -> DataFrame:
    """table(conv_id, p, v) -> one row for each ``fan`` neighbouring p, their v combined in order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (conv, up), group in _grouped(batches, 2):
                v = group[0][3]
                for g in group[1:]:
                    v = both(v, g[3])
                yield conv, up, v
        return _arrow(["conv_id", "p", "v"], [pa.int64(), pa.int64(), _LONGS], rows())

    t = table.select("conv_id", F.floor(F.col("p") / fan).alias("up"), "p", "v")
    return t.repartition("conv_id", "up").sortWithinPartitions("conv_id", "up", "p").mapInArrow(work, "conv_id long, p long, v array<long>")


def _down(table: DataFrame, above: DataFrame, fan: int, last_first: bool, step: Callable) -> DataFrame:
    """Hands the state at the end (or the start) of each block in above(conv_id, p, at) on to its members."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (conv, _), group in _grouped(batches, 2):
                at = group[0][4]
                for g in reversed(group) if last_first else group:
                    yield conv, g[2], at
                    at = step(g[3], at)
        return _arrow(["conv_id", "p", "at"], [pa.int64(), pa.int64(), _LONGS], rows())

    t = table.select("conv_id", F.floor(F.col("p") / fan).alias("up"), "p", "v")
    above = above.select(F.col("conv_id").alias("of"), F.col("p").alias("block"), "at")
    t = t.join(above, t["conv_id"].eqNullSafe(above["of"]) & (t["up"] == above["block"])).select("conv_id", "up", "p", "v", "at")
    return t.repartition("conv_id", "up").sortWithinPartitions("conv_id", "up", "p").mapInArrow(work, "conv_id long, p long, at array<long>")


def _sweep(table: DataFrame, levels: int, fan: int, both: Callable, top: list[int], last_first: bool, step: Callable, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(the figures of whole conversations, the state handed to every p)."""
    tables = [table]
    for _ in range(levels):
        tables.append(scratch.save(_up(tables[-1], fan, both)))
    at = tables[-1].select("conv_id", "p", F.array(*[F.lit(x).cast("long") for x in top]).alias("at"))
    for t in reversed(tables[:-1]):
        at = _down(t, at, fan, last_first, step)
    return tables[-1], scratch.save(at)


class Repair:
    """The least repair of every conversation in turns(conv_id, turn, role, text, ...).

    Rows go by turn, nulls first, those of one turn by role and a hash of the text. A null role or text is one space; rows without
    conv_id are one conversation; other columns are ignored; an empty table gives empty results. A row's first fault
    counts: blank, duplicate (role and text seen earlier in its conversation), truncated (last character
    that isn't white space is none of .!?). Roles count by their first letter.

    ``totals``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost). ``turns``: (conv_id, pos, nth, edit, role, text), the edits in order of
    pos and nth; deleted rows have role and text null.

    Rows are sorted across all tasks and cut into pieces of at most ``span`` rows of a conversation. A piece is worked out
    for each state at its ends, and pieces meet ``fan`` at a time, so a conversation of any length is shared by many tasks.
    """

    def __init__(self, turns: DataFrame, span: int = 64, fan: int = 256):
        self.scratch = scratch = Scratch(turns.sparkSession, "turn-repair")
        text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        held = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_of("role"), text_of("text"))
        held = held.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))  # row: copies too spread over tasks
        order = ["conv_id", F.asc_nulls_first("turn"), "role", "h", "row"]
        held = held.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "row")
        key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
        rows = scratch.save(held.select("*", F.monotonically_increasing_id().alias("pos"), key.alias("k")))
        # The position is a task's number and a row's place in it: pieces are numbered in that order, without gaps by more than the longest task.
        part, piece = F.shiftright("pos", 33), F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / span)
        most = rows.agg(F.max(part), F.max(piece)).first()
        width = (most[1] or 0) + 1
        self.rows = rows.withColumn("p", part * width + piece)
        levels, room = 0, 1
        while room < ((most[0] or 0) + 1) * width:
            levels, room = levels + 1, room * fan

        firsts = rows.groupBy("conv_id", "k").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
        firsts = firsts.select(F.col("conv_id").alias("of"), F.col("k").alias("fk"), "first")
        bare = F.rtrim("text", F.lit(WHITE))
        fault = (F.when(bare == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
                 .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
        marks = self.rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("k") == F.col("fk")), "left")
        self.marks = scratch.save(marks.select("conv_id", "p", "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")))

        def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                for (conv, p), group in _grouped(batches, 2):
                    of = [(g[3], g[4]) for g in group]
                    illegal = sum((a[0], b[0]) not in LEGAL for a, b in zip(of, of[1:], strict=False))
                    yield conv, p, [*costs(of), ord(of[0][0] or "\0"), ord(of[-1][0] or "\0"), illegal]
            return _arrow(["conv_id", "p", "v"], [pa.int64(), pa.int64(), _LONGS], out())

        def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                for (conv, p), group in _grouped(batches, 2):
                    of = [(g[3], g[4]) for g in group]
                    found = layers(of, group[0][5])
                    all_ = [trace(of, found, q) for q in range(4)]
                    yield conv, p, [x[1] for x in all_], [x[0] for x in all_]
            return _arrow(["conv_id", "p", "v", "edits"], [pa.int64(), pa.int64(), _LONGS, pa.list_(pa.string())], out())

        place = ["conv_id", "p", "pos"]
        sorted_marks = self.marks.select(*place, "initial", "fault").repartition("conv_id", "p").sortWithinPartitions(*place)
        pieces = scratch.save(sorted_marks.mapInArrow(figures, "conv_id long, p long, v array<long>"))
        self.whole, ends = _sweep(pieces, levels, fan, _both, END, True, _across, scratch)
        ends = ends.select(F.col("conv_id").alias("of"), F.col("p").alias("piece"), "at")
        held = self.marks.select(*place, "initial", "fault").join(ends, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("p") == F.col("piece")))
        held = held.select(*place, "initial", "fault", "at").repartition("conv_id", "p").sortWithinPartitions(*place)
        traced = scratch.save(held.mapInArrow(traces, "conv_id long, p long, v array<long>, edits array<string>"))
        self.finals, starts = _sweep(traced, levels, fan, lambda a, b: [b[q] for q in a], [START], False, lambda v, at: [v[at[0]]], scratch)
        starts = starts.select(F.col("conv_id").alias("of"), F.col("p").alias("piece"), F.col("at")[0].alias("start"))
        traced = traced.join(starts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("p") == F.col("piece")))
        self.edits = traced.select("conv_id", "p", "start", F.col("edits")[F.col("start").cast("int")].alias("edits"))

    @property
    def totals(self) -> DataFrame:
        count = lambda f: F.count_if(F.col("fault") == f)
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
        counts = self.marks.groupBy("conv_id").agg(
            gaps.alias("gaps"), count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"))
        cost = F.least(*[F.col("v")[e] + END[e] for e in range(4)])
        whole = self.whole.select(F.col("conv_id").alias("of"), F.col("v")[18].alias("illegal"), cost.alias("cost"))
        return counts.join(whole, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")

    @property
    def turns(self) -> DataFrame:
        """The edits piece by piece; a piece's own record comes before its rows."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                edits, state, nth = iter(""), START, 0
                for b in batches:
                    for conv, _, pos, role, text, of, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                        if pos < 0:
                            edits, state, nth = iter(of), start, 0
                            continue
                        for e in edits:
                            nth += 1
                            if e == "D":
                                yield conv, pos, nth, e, None, None
                                break
                            new = STEP[role[0], state] if e == "K" else NEXT[state]
                            named = role if e == "K" else "user" if new == U else "assistant"
                            state = new
                            yield conv, pos, nth, e, named, "" if e == "I" else text
                            if e != "I":
                                break
            return _arrow(["conv_id", "pos", "nth", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()], out(), 1024)

        none = lambda kind, name: F.lit(None).cast(kind).alias(name)
        both = self.rows.select("conv_id", "p", "pos", "role", "text", none("string", "edits"), none("long", "start")).unionByName(
            self.edits.select("conv_id", "p", F.lit(-1).cast("long").alias("pos"), none("string", "role"), none("string", "text"), "edits", "start"))
        schema = "conv_id long, pos long, nth long, edit string, role string, text string"
        done = both.repartition("conv_id", "p").sortWithinPartitions("conv_id", "p", "pos").mapInArrow(work, schema)
        missing = F.when(F.col("v")[START] == U, F.array(F.lit("assistant"))).when(F.col("v")[START] == S, F.array(F.lit("user"), F.lit("assistant")))
        tail = self.finals.select("conv_id", F.lit((1 << 62)).alias("pos"), F.posexplode(missing).alias("nth", "role"))
        return done.unionByName(tail.select("conv_id", "pos", F.col("nth").cast("long"), F.lit("I").alias("edit"), "role", F.lit("").alias("text")))


def damage(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text, ...) -> the same columns of damaged rows; nulls of role and text become one space.

    By crc32 of ``conv_id:turn`` mod 20: 0 drops the row, 1 empties its text, 2 removes .!? from it, 3 repeats it, 4 sets role user.
    """
    shown: Callable[[str], Column] = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), k.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def digests(turns: DataFrame) -> DataFrame:
    """Turns of a repair -> (conv_id, audit, repaired_sha256). The texts of a conversation stream past in order; none is held."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text")), strict=True))
            for conv, group in groupby(rows, key=itemgetter(0)):
                sha, audit, sep = hashlib.sha256(), bytearray(), b""
                for _, edit, role, text in group:
                    audit += edit.encode()
                    if edit != "D":
                        sha.update(sep + f"{role}:{text}".encode())
                        sep = b"\n"
                yield conv, audit.decode(), sha.hexdigest()
        return _arrow(["conv_id", "audit", "repaired_sha256"], [pa.int64(), pa.string(), pa.string()], out())

    held = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "nth")
    return held.mapInArrow(work, "conv_id long, audit string, repaired_sha256 string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damages conversations, repairs them and returns figures, audit and digest of every original conv_id.

    A conversation of which no row is left has zeros, an empty audit and the digest of nothing.
    """
    repair = Repair(damage(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = {"t": repair.totals, "d": digests(repair.turns)}
    for name, df in found.items():
        df = df.withColumnRenamed("conv_id", name)
        every = every.join(df, F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
