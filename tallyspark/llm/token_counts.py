"""Exact token counts at every prefix of a text, by dynamic programming over pieces (operator 12)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SPACE = "▁"


class PrefixCounter:
    """How many pieces a byte-pair model makes of every prefix of a text.

    A list of pieces is an encoding just if each two neighbours are what the model makes of the two
    together. So the encoding of a prefix that ends in piece t goes on from the encoding of the prefix
    before t, whose last piece must stay apart from t; exactly one t does, and
    count[i] = count[i - len(t)] + 1.

    Characters outside the vocabulary are as many tokens as bytes and never merge. Where no piece of
    several characters reaches across (before white space, between letters and other signs, at digits and line ends), a text
    falls into parts that don't act on each other; each part is worked out once and held while there is room.
    """

    def __init__(self, model_file: str, held: int = 400_000, longest_held: int = 64):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        special = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i) for i in ids]
        if sum(map(model.is_byte, ids)) != 256 or model.normalize("a  ａ\t") != f"{SPACE}a {SPACE}ａ\t".replace(" ", SPACE):
            raise ValueError("this needs a model with all byte pieces, a space put before the text and no other normalisation")
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in ids if not special[i]}
        #: The last merge of each piece that the model makes of its own characters; None for a character.
        self.halves: dict[str, tuple[str, str] | None] = {}
        for p in self.rank:
            parts, last = self._merged(p)
            if parts == [p]:
                self.halves[p] = last
        #: Pieces by their last character, the one before it and so on; the piece itself under "".
        self.ends: dict = {}
        for p in self.halves:
            node = self.ends
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = p
        self.ranks = Counter(self.rank.values())
        self.grown: dict[tuple[str, int], list | None] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.held, self.longest_held = held, longest_held
        self.parts: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # parts held when there was no more room; those used since are in both
        self.shared: dict[bytes, bytes] = {}  # many parts have the same steps
        several = [p for p in self.rank if len(p) > 1]
        pairs = {a + b for p in several for a, b in zip(p, p[1:], strict=False)}
        inside = {c for p in several for c in p}
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c != " " and c not in inside)
        signs = "".join(re.escape(c) for c in map(chr, range(128)) if c in inside and not c.isalnum())
        sign = lambda c: c in inside and ord(c) < 128 and not c.isalnum()
        mixed = any(sign(a) != sign(b) for a, b in pairs if SPACE not in (a, b))
        words = f"[^ {alone}]+" if mixed else f"(?:[{signs}]+|[^ {alone}{signs}]+)"
        self.part = re.compile(r"(?s).+" if any(b == SPACE != a for a, b in pairs) else f"[{alone}]| +{words}| +|{words}")

    def _merged(self, s: str) -> tuple[list[str], tuple[str, str] | None]:
        """What the model makes of a few characters, and its last merge: the best neighbours merge first, the left ones of equals."""
        parts, last = list(s), None
        while True:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank), default=None)
            if best is None:
                return parts, last
            i = best[1]
            last = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _growth(self, p: str, side: int) -> list[tuple[str, float, float]] | None:
        """The left (side 0) or right ends of a piece as it grows, the whole first, which nothing takes up: [(end, rank of the merge that makes it,
        of the one that takes it up)]; none if a merge doesn't come after those before it."""
        if (p, side) not in self.grown:
            out, until, x = [], np.inf, p
            while out is not None and (halves := self.halves[x]) is not None:
                if self.rank[x] >= until or self.ranks[self.rank[x]] > 1:
                    out = None
                else:
                    out.append((x, self.rank[x], until))
                    until, x = self.rank[x], halves[side]
            self.grown[p, side] = None if out is None else [*out, (x, -1.0, until)]
        return self.grown[p, side]

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether the model makes a and b of the two together.

        Merges come by rank, so an end of a and an end of b stand side by side until the first of them is taken
        up; they merge if their own merge comes before, the left one of equals first.
        """
        known = self.apart.get((a, b))
        if known is None:
            if len(self.apart) >= 4 * self.held:
                self.apart.clear()
            x, y = self._growth(a, 1), self._growth(b, 0)
            if x is None or y is None:
                known = self._merged(a + b)[0] == [a, b]
            else:
                rank = self.rank.get
                known = not any(max(r, born_x, born_y) < until_x and max(r, born_x, born_y) <= until_y
                                for p, born_x, until_x in x for q, born_y, until_y in y if (r := rank(p + q)) is not None)
            self.apart[a, b] = known
        return known

    def _work_out(self, parts: list[str]) -> Iterator[bytes]:
        """The steps of each of some sorted parts, going on from where it leaves the one before it."""
        last, count, steps, done = [""], [0], bytearray(), ""  # "": nothing that could merge
        apart, ends, rank = self.apart, self.ends, self.rank
        for s in (p.replace(" ", SPACE) for p in parts):
            n, most = 0, min(len(s), len(done))
            while n < most and s[n] == done[n]:
                n += 1
            del last[n + 1 :], count[n + 1 :], steps[n:]
            for i in range(n, len(s)):
                c = s[i]
                if c not in rank:
                    size = len(c.encode("utf-8", "replace"))
                    last.append("")
                    count.append(count[i] + size)
                    steps.append(size)
                    continue
                node, at, found = ends, i, []
                while at >= 0 and (node := node.get(s[at])) is not None:
                    if "" in node:
                        found.append(at)
                    at -= 1
                for at in reversed(found):
                    t, before = s[at : i + 1], last[at]
                    ok = not before or apart.get((before, t))
                    if ok or ok is None and self._stay_apart(before, t):
                        last.append(t)
                        count.append(count[at] + 1)
                        steps.append(count[at] + 1 - count[i] & 255)
                        break
                else:
                    raise ValueError(f"no encoding ends at character {i + 1} of {s[: i + 1][-40:]!r}")
            done = s
            x = bytes(steps)
            yield self.shared.setdefault(x, x) if len(x) < 16 and len(self.shared) < self.held else x

    def _learn(self, wanted: set[str]) -> dict[str, bytes]:
        """The steps of all parts in ``wanted``; those of moderate length are held for other texts."""
        if len(self.parts) + len(wanted) > self.held:
            self.before, self.parts = self.parts, {}
        known, before = self.parts, self.before
        new = sorted(w for w in wanted if w not in known and w not in before)
        every = dict(zip(new, self._work_out(new), strict=True))
        every |= {w: before[w] for w in wanted if w not in known and w in before}
        known |= {w: x for w, x in every.items() if len(w) <= self.longest_held}
        return every | {w: known[w] for w in wanted if w not in every}

    def steps(self, texts: list[str]) -> list[bytes]:
        """For each text one signed byte a character: the count at a prefix is the sum of its bytes."""
        split = [self.part.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]  # both are the same to the model
        of = self._learn(set(chain.from_iterable(split)))
        joined = (b"".join(map(of.__getitem__, x)) for x in split)
        # The space put before a text goes with its first character.
        return [bytes([(x[0] + x[1]) & 255]) + x[2:] if x else b"" for x in joined]


@lru_cache(1)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def count_at(steps: bytes, characters: int) -> int:
    """Tokens of the first ``characters`` characters."""
    return int(np.frombuffer(steps, np.int8)[:characters].sum(dtype=np.int64))


def longest_within(steps: bytes, budget: int) -> int:
    """The longest prefix, in characters, that makes at most ``budget`` tokens; a longer prefix can make fewer than a shorter one."""
    within = np.flatnonzero(np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def prefix_table(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_bytes, n_tokens, steps), one row per input row.

    steps holds the exact token count at every prefix, as differences of one signed byte a character;
    see ``count_at``, ``longest_within`` and ``within_budget``. Null texts are empty: no bytes, no tokens. Bytes that
    are not UTF-8 count as replacement characters. Begin, end and special tokens aren't added; their
    strings inside a text are ordinary text. Repeated and id-less rows are counted each; other columns are
    ignored; an empty table gives an empty result. A task holds four megabytes of text, or one text, and the parts seen last.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(model_file)
        for b in batches:
            at = 0
            for texts in slices(b.column("text").to_pylist(), 1 << 22):
                steps = of.steps([(t or b"").decode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(at, len(texts)), pa.array([len(t or b"") for t in texts], pa.int64()),
                    pa.array([count_at(s, len(s)) for s in steps], pa.int64()), pa.array(steps, pa.binary())], names=["doc_id", "n_bytes", "n_tokens", "steps"])
                at += len(texts)

    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return held.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, steps binary")


def within_budget(table: DataFrame, budget: int) -> DataFrame:
    """A prefix table -> (doc_id, n_bytes, n_tokens, over_limit, kept_chars): whether the text makes more than ``budget`` tokens,
    and its longest prefix that doesn't. Read off the stored counts; nothing is encoded again."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [longest_within(s.as_py(), budget) for s in b.column("steps")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_bytes", "n_tokens")), pa.array(kept, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "kept_chars"])

    kind = table.schema["doc_id"].dataType.simpleString()
    out = table.select("doc_id", "n_bytes", "n_tokens", "steps").mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, kept_chars long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "kept_chars")
