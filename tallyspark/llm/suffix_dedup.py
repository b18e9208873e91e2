"""Repeated byte strings by suffix arrays with common-prefix interval trees (operator 1).

A 400-byte string that occurs twice picks the same anchor in both places: the k-gram with the least hash
among those that start in it. So suffixes need comparing only among the contexts of one anchor: the bytes
that strings through the anchor may reach. Equal contexts are counted before anything is shuffled as
text; only distinct contexts of an anchor meet in an enhanced suffix array, whose common-prefix
intervals give the maximal repeats. An anchor with very many distinct contexts is split into blocks of
string starts, and blocks whose contexts still differ into single starts, which need no text at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix

GRAM = 128
CHUNK = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(3).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, kept for the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n2 = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n2 - 1, b, np.uint64)])) for b in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def anchors(text: bytes, length: int = 400, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors: every ``length``-byte window holds the leftmost least gram of its own."""
    pos, hashes = [], []
    w = length - gram + 1
    for at in range(0, len(text) - length + 1, CHUNK):
        b = np.frombuffer(text, np.uint8, min(len(text) - at, CHUNK + length - 1), at)
        up, down = _POWERS.get(len(b))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * up)])
        h = mix((total[gram:] - total[:-gram]) * down[: len(b) - gram + 1])
        key = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        m = -(-len(key) // w) * w
        padded = np.full(m, 0xFFFFFFFFFFFFFFFF, np.uint64)
        padded[: len(key)] = key
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[: len(key) - w + 1], ahead[w - 1 : len(key)])
        first = np.concatenate([np.ones(1, bool), least[1:] != least[:-1]])
        p = np.unique((least[first] & np.uint64(0xFFFFFF)).astype(np.int64))
        pos.append(p + at)
        hashes.append(h[p])
    if not pos:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    pos, hashes = np.concatenate(pos), np.concatenate(hashes)
    keep = np.unique(pos, return_index=True)[1]
    return pos[keep], hashes[keep]


def suffix_array(texts: list[bytes], groups: list[int] | None = None, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes, common prefixes, symbols before, starts) of texts of under 2^20 bytes in all, each closed by a symbol of its own.

    ``common[i]`` is the common prefix of suffixes i - 1 and i if that is at least ``least``, else at most
    what it is. Texts of different ``groups`` (ascending numbers; by default all are one) share none, as if
    each of their symbols were marked with its group.

    Prefix doubling; a suffix that its first h symbols already tell from all others is not sorted again.
    """
    n = sum(map(len, texts)) + len(texts)
    assert n < 1 << 20 and len(texts) < 1700
    s = np.empty(n, np.uint64)
    starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    for i, x in enumerate(texts):
        s[starts[i] : starts[i + 1] - 1] = np.frombuffer(x, np.uint8)
        s[starts[i + 1] - 1] = 257 + i
    group = np.repeat(np.array(groups or [0] * len(texts), np.uint64), np.diff(starts))
    pad = np.concatenate([s + np.uint64(1), np.zeros(3, np.uint64)])
    key = (group << np.uint64(33)) | (pad[:n] << np.uint64(22)) | (pad[1 : n + 1] << np.uint64(11)) | pad[2 : n + 2]
    place = np.arange(n)

    def first_of(new: np.ndarray) -> np.ndarray:
        """Where the run of equal keys that each element belongs to begins."""
        return np.maximum.accumulate(np.where(new, place[: len(new)], 0))

    def changes(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[True], x[1:] != x[:-1]])

    packed = np.sort((key << np.uint64(20)) | place.astype(np.uint64))
    sa = (packed & np.uint64(0xFFFFF)).astype(np.int64)
    new = changes(packed >> np.uint64(20))
    rank = np.empty(n, np.uint32)
    rank[sa] = first_of(new)  # a suffix's rank is the place of the first one that is still equal to it
    active, levels, h = sa[~(new & np.append(new[1:], True))], [(3, rank)], 3
    while len(active):
        # 20 bits each: the rank, the rank of what follows the first h symbols, the suffix.
        packed = np.sort((rank[active].astype(np.uint64) << np.uint64(40)) | (rank[active + h].astype(np.uint64) << np.uint64(20)) | active.astype(np.uint64))
        at, old = (packed & np.uint64(0xFFFFF)).astype(np.int64), (packed >> np.uint64(40)).astype(np.int64)
        begin, new = first_of(changes(old)), changes(packed >> np.uint64(20))
        rank = rank.copy()
        rank[at] = old + first_of(new) - begin
        sa[old + place[: len(at)] - begin] = at
        active, h = at[~(new & np.append(new[1:], True))], 2 * h
        levels.append((h, rank))
    common = np.zeros(n, np.int64)
    base = next((r for size, r in reversed(levels) if size <= least), None)
    near = np.flatnonzero(base[sa[1:]] == base[sa[:-1]]) if base is not None else place[: n - 1]
    a, b = sa[near], sa[near + 1]
    for size, rank in reversed(levels):
        same = (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]) * size
        a, b = a + same, b + same
    for _ in range(2):  # what the shortest level leaves
        same = np.maximum(a, b) < n
        same[same] = (s[a[same]] == s[b[same]]) & (group[a[same]] == group[b[same]])
        a, b = a + same, b + same
    common[near + 1] = a - sa[near]
    return sa, common, s[sa - 1], starts


def maximal_repeats(sa: np.ndarray, common: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last): intervals of the suffix array whose suffixes share a prefix of ``length`` >= least
    that no longer interval shares and that differ in the symbol before, found in one stack scan."""
    n = len(sa)
    deep = common >= least
    edge = np.diff(np.concatenate([[False], deep, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    turns = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    for lo, hi in zip(begins, ends, strict=True):  # suffixes lo - 1 .. hi - 1
        if turns[hi - 1] == turns[lo - 1]:
            continue  # every one continues the same string to the left
        stack = [(0, lo - 1)]
        for i in range(lo, hi + 1):
            c = int(common[i]) if i < hi and i < n else 0
            left = i - 1
            while stack[-1][0] > c:
                length, left = stack.pop()
                if turns[i - 1] > turns[left]:
                    yield length, left, i - 1
            if stack[-1][0] < c:
                stack.append((c, left))


def repeated_parts(texts: list[bytes], least: int, groups: list[int] | None = None) -> list[list[tuple[int, int]]]:
    """For each text, the spans covered by strings of ``least`` bytes that occur twice among its group."""
    sa, common, before, starts = suffix_array(texts, groups, least)
    reach = np.zeros(len(sa), np.int64)
    for length, lo, hi in maximal_repeats(sa, common, before, least):
        np.maximum(reach[lo : hi + 1], length, out=reach[lo : hi + 1])
    hit = np.flatnonzero(reach)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    at = sa[hit]
    which = np.searchsorted(starts, at, "right") - 1
    for i, a, r in sorted(zip(which.tolist(), (at - starts[which]).tolist(), reach[hit].tolist(), strict=True)):
        spans = out[i]
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], a + r))
        else:
            spans.append((a, a + r))
    return out


def _texts(docs: DataFrame) -> DataFrame:
    """d and t, two 64-bit hashes of doc_id and text, stand together for a row and its exact copies."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    both = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "text")
    return own.select(both(1).alias("d"), both(2).alias("t"), "doc_id", "text")


def _scan(length: int):
    back = length - GRAM

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.column("text"):
                raw = memoryview(x.as_buffer())
                p, h = anchors(raw, length)
                c = [xxhash.xxh3_64_intdigest(raw[max(0, q - back) : q + length], seed=min(q, back)) for q in p.tolist()]
                rows.append((p, h.view(np.int64), np.array(c, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), b.column("t")] + [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in range(3)],
                names=["d", "t", "pos", "a", "c"])

    return make


def _contexts(length: int):
    back = length - GRAM

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, t, text, want in zip(*(b.column(x) for x in ("d", "t", "text", "want")), strict=True):
                raw, want = memoryview(text.as_buffer()), want.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d.as_py()] * len(want), pa.int64()), pa.array([t.as_py()] * len(want), pa.int64()),
                     pa.array([w["a"] for w in want], pa.int64()), pa.array([w["c"] for w in want], pa.int64()),
                     pa.array([w["pos"] for w in want], pa.int64()),
                     pa.array([bytes(raw[max(0, w["pos"] - back) : w["pos"] + length]) for w in want], pa.binary())],
                    names=["d", "t", "a", "c", "pos", "context"])

    return make


def _promising(group: list[tuple], length: int, step: int = 8) -> list[tuple]:
    """The contexts (a, c, d, t, pos, context) of one anchor cut down to what may repeat: (a, d, t, start, bytes).

    Two contexts share a string only at equal distances from the anchor. The strings that start in one
    block of ``step`` distances all hold the block's core, so a block whose core no other context has
    holds no repeat. Pieces of one text that overlap become one, or its bytes would repeat themselves.
    """
    back = length - GRAM
    seen: dict = {}
    found = []
    for _, _, _, _, pos, text in group:
        origin = min(pos, back) - back  # where distance 0 lies in the context
        cores = []
        for k in range(0, back + 1, step):
            last = origin + min(k + step - 1, back)
            if origin + k + length <= len(text) and last >= 0:
                core = (k, text[last : origin + k + length])
                seen[core] = seen.get(core, 0) + 1
                cores.append(core)
        found.append((origin, cores))
    out = []
    for (a, _, d, t, pos, text), (origin, cores) in zip(group, found, strict=True):
        alive = [k for k, core in cores if seen[k, core] > 1]
        if alive:
            x, y = max(0, origin + alive[0]), origin + min(alive[-1] + step - 1, back) + length
            out.append((a, d, t, max(0, pos - back) + x, text[x:y]))
    merged: list[tuple] = []
    for a, d, t, start, text in sorted(out):
        if merged and merged[-1][1:3] == (d, t) and start <= (end := merged[-1][3] + len(merged[-1][4])):
            merged[-1] = (*merged[-1][:4], merged[-1][4] + text[end - start :])
        else:
            merged.append((a, d, t, start, text))
    return merged


def _search(length: int):
    def one(rows: list[tuple]) -> pa.RecordBatch | None:
        number = np.cumsum([0, *(x[0] != y[0] for x, y in zip(rows, rows[1:]))]).tolist()
        parts = repeated_parts([r[4] for r in rows], length, number)
        out = [(d, t, start + x, start + y) for (_, d, t, start, _), spans in zip(rows, parts, strict=True) for x, y in spans]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate([pa.int64()] * 4)], names=["d", "t", "x", "y"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, size, last = [], [], 0, None

        def close() -> Iterator[pa.RecordBatch]:
            """The group joins those held; they are searched first if all would be too much for one suffix array."""
            nonlocal held, group, size
            group = _promising(group, length)
            more = sum(len(r[4]) + 1 for r in group)
            if held and (size + more >= 1 << 20 or len(held) + len(group) >= 1600):
                yield one(held)
                held, size = [], 0
            held, size, group = held + group, size + more, []

        for b in batches:
            for row in zip(*(b.column(x).to_pylist() for x in ("a", "c", "d", "t", "pos", "context")), strict=True):
                if last == row[:2]:
                    continue
                if group and group[-1][0] != row[0]:
                    yield from close()
                group.append(row)
                last = row[:2]
        yield from close()
        if held:
            yield one(held)

    return make


def _blocks(length: int, step: int, within: int):
    """Rows for the blocks of ``step`` string starts inside the blocks of ``within`` starts named in ``todo``.

    k is a block's first start, counted from the first string that holds the anchor.
    """
    back = length - GRAM

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, t, text, want in zip(*(b.column(x) for x in ("d", "t", "text", "want")), strict=True):
                raw = memoryview(text.as_buffer())
                d, t = d.as_py(), t.as_py()
                for w in want.as_py():
                    p = w["pos"]
                    for k in (k for o in w["todo"] for k in range(o, min(o + within, back + 1), step)):
                        first = p - back + k
                        last = min(p, first + step - 1, p - back + k - k % within + within - 1)
                        lo, hi = max(first, 0), min(last, len(raw) - length)
                        if lo <= hi:  # every string of the block holds its core
                            core = xxhash.xxh3_64_intdigest(raw[last : first + length])
                            out.append((d, t, p, w["a"], k, core, xxhash.xxh3_64_intdigest(raw[lo : hi + length], seed=lo - first), lo, hi + length))
            kinds = (*[pa.int64()] * 5, pa.uint64(), pa.uint64(), pa.int64(), pa.int64())
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            cols = [c.view(pa.int64()) if c.type == pa.uint64() else c for c in cols]
            yield pa.RecordBatch.from_arrays(cols, names=["d", "t", "pos", "a", "k", "core", "h", "x", "y"])

    return make


_BLOCK = "d long, t long, pos long, a long, k long, core long, h long, x long, y long"


def _split_hot(held: DataFrame, length: int, scratch: Scratch, steps: tuple[int, ...] = (96, 32, 8, 2, 1)) -> DataFrame:
    """Spans in contexts of anchors with very many distinct contexts; held(d, t, text, want).

    All contexts of an anchor are aligned, so a string that starts in block k of one starts in block k of
    the other: blocks that are equal in whole are covered in whole; one of each kind goes on to smaller
    blocks if another kind shares the core that all their strings hold, down to single starts. All of it
    is counts by hash. Steps divide each other, so blocks nest.
    """
    within, done = length, []
    todo = held
    for step in steps:
        rows = scratch.save(todo.mapInArrow(_blocks(length, step, within), _BLOCK))
        whole = rows.groupBy("a", "k", "core", "h").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "pos")).alias("r"))
        cores = scratch.save(rows.groupBy("a", "k", "core").agg(F.count("*").alias("alike")).where("alike > 1"))
        whole = scratch.save(whole.join(cores, ["a", "k", "core"]))
        done.append(rows.join(whole.where("n > 1").select("a", "k", "core", "h"), ["a", "k", "core", "h"]).select("d", "t", "x", "y"))
        left = whole.where("alike > n").select("r.d", "r.t", "r.pos", "a", "k").groupBy("d", "t", "pos", "a").agg(F.collect_list("k").alias("todo"))
        left = left.groupBy("d", "t").agg(F.collect_list(F.struct("pos", "a", "todo")).alias("want"))
        todo, within = held.drop("want").join(left, ["d", "t"]).select("d", "t", "text", "want"), step
    spans = done[0]
    for x in done[1:]:
        spans = spans.unionByName(x)
    return scratch.save(spans)


def repeated_spans(docs: DataFrame, length: int = 400, most_contexts: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """docs(doc_id, text, ...) -> (d, t, spans): for each text with any, its bytes covered by strings of
    ``length`` bytes that also start elsewhere, as (x, y) pieces that may overlap."""
    scratch = scratch or Scratch(docs.sparkSession, "suffix")
    texts = _texts(docs)
    found = scratch.save(texts.where(F.octet_length("text") >= length).mapInArrow(_scan(length), "d long, t long, pos array<long>, a array<long>, c array<long>"))
    occ = found.select("d", "t", F.explode(F.arrays_zip("pos", "a", "c")).alias("z")).select("d", "t", "z.pos", "z.a", "z.c")
    again = occ.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 1")
    # Saved before the join, as other counts by anchor: Spark splits a frequent key of a join only if no grouping by it is in the same stage.
    again = scratch.save(again.select("a", (F.col("lo") != F.col("hi")).alias("mixed")))
    alive = scratch.save(occ.join(again, "a"))
    count = alive.groupBy("a", "c", "mixed").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "pos")).alias("r"))
    count = scratch.save(count)
    end = F.col("pos") + length
    equal = alive.join(count.where("n > 1").select("a", "c"), ["a", "c"]).select(
        "d", "t", F.greatest(F.lit(0), F.col("pos") - (length - GRAM)).alias("x"), end.alias("y"))
    reps = count.where("mixed").select("a", "c", "r.d", "r.t", "r.pos")
    many = scratch.save(reps.groupBy("a").agg(F.count("*").alias("contexts")).where(F.col("contexts") > most_contexts).select("a"))
    want = lambda rows: rows.groupBy("d", "t").agg(F.collect_list(F.struct("a", "c", "pos")).alias("want"))
    plain = texts.join(want(reps.join(many, "a", "left_anti")), ["d", "t"])
    contexts = plain.select("d", "t", "text", "want").mapInArrow(_contexts(length), "d long, t long, a long, c long, pos long, context binary")
    parts = [equal, contexts.repartition("a").sortWithinPartitions("a", "c").mapInArrow(_search(length), "d long, t long, x long, y long")]
    all_of = lambda rows: rows.groupBy("d", "t").agg(F.collect_list(F.struct("pos", "a", F.array(F.lit(0).cast("long")).alias("todo"))).alias("want"))
    if not many.isEmpty():
        parts.append(_split_hot(scratch.save(texts.join(all_of(reps.join(many, "a")), ["d", "t"]).select("d", "t", "text", "want")), length, scratch))
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.unionByName(p)
    return scratch.save(spans.distinct().groupBy("d", "t").agg(F.collect_list(F.struct("x", "y")).alias("spans")))  # a text's own spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, spans in zip(b.column("text"), b.column("spans"), strict=True):
            raw, kept, at, gone, runs = memoryview(text.as_buffer()), hashlib.sha256(), 0, 0, 0
            for x, y in sorted((s["x"], s["y"]) for s in spans.as_py() or ()):
                y = min(y, len(raw))
                if y <= at and runs:
                    continue
                if x > at or not runs:
                    kept.update(raw[at:x])
                    runs += 1
                    gone += y - x
                else:
                    gone += y - at
                at = y
            kept.update(raw[at:])
            out.append((len(raw), gone, runs, kept.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id")] + [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))] + [pa.array([r[1] > 0 for r in out])],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "repeats"])


def suffix_dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeats), one row per input row.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in another row or
    the same one, is removed, all copies alike, judged on the input; ``repeats`` says whether there is any. Null texts count as empty; texts
    under ``length`` bytes lose nothing; repeated rows are copies of each other; a null doc_id is
    returned as such; other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    spans = repeated_spans(docs, length, scratch=scratch)
    held = _texts(docs).join(spans, ["d", "t"], "left").select("doc_id", "text", "spans")
    return held.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, repeats boolean")
