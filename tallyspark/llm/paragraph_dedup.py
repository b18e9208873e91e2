"""Repeated passages by MinHash banding of content-defined paragraphs (operator 9).

A text is one stream of words; lines play no part. It is cut before each word whose pair with the next
word has a hash that is least among its neighbours, so every stretch of text is cut alike wherever it
stands, in the middle of a line or across many, and every word lies in a paragraph. Paragraphs are 7
words or more, 13 on average; a repeated passage of over 50 words holds whole ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _P, Scratch, mix, parts, words_of
from .neardup import SETS, NodeIds, OddSketcher, meeting, near_links

#: A paragraph starts at the least word pair among this many on either side.
REACH = 6
#: A passage is a run of neighbouring repeated paragraphs of at least so many words; shorter repeats are phrases.
LEAST = 16


class Paragraphs:
    """The paragraphs of some texts: text, start and size (in words), the shingle set's two hashes, and the sorted sets.

    Fewer ``bits`` of the first hash are for tests.
    """

    def __init__(self, texts: list[str | None], k: int, reach: int = REACH, bits: int = 64):
        words, counts = words_of(texts)
        n, ends = len(words), np.cumsum(counts)
        begins = ends - counts
        place = np.arange(n) - np.repeat(begins, counts)
        cut = (place == 0) | (cuts(words, reach) & (place >= reach) & (np.repeat(counts, counts) - place >= reach + 2))
        first = np.flatnonzero(cut)
        self.text = np.repeat(np.arange(len(texts)), counts)[first]
        self.start, self.words = place[first], np.diff(np.append(first, n))
        which = np.cumsum(cut) - 1
        h = np.zeros(max(0, n - k + 1), np.uint64)
        for j in range(k if n >= k else 0):
            h += words[j : n - k + 1 + j] * _P[j]
        whole = which[: n - k + 1] == which[k - 1 :] if n >= k else np.empty(0, bool)
        items, unit = mix(h[whole]), which[: len(whole)][whole]
        for i in np.flatnonzero(self.words < k):  # a text of under k words is one shingle
            w = words[first[i] : first[i] + self.words[i]]
            items = np.append(items, mix(np.array([(w * _P[: len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))], np.uint64)))
            unit = np.append(unit, i)
        order = np.lexsort((items, unit))
        items, unit = items[order], unit[order]
        new = np.append(True, (items[1:] != items[:-1]) | (unit[1:] != unit[:-1])) if len(items) else np.empty(0, bool)
        self.items, self.unit = items[new], unit[new]
        self.at = np.searchsorted(self.unit, np.arange(len(first) + 1))
        self.own = (self._sums(0x51ED270B9F6C) >> np.uint64(64 - bits)).view(np.int64)
        self.alt = self._sums(0x2545F4914F6CDD1D).view(np.int64)

    def _sums(self, salt: int) -> np.ndarray:
        """A hash of each set: its members' mixed hashes, summed."""
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.items ^ np.uint64(salt)), dtype=np.uint64)])
        return mix(total[self.at[1:]] - total[self.at[:-1]])

    def distinct(self) -> np.ndarray:
        """The paragraphs that are the first with their set."""
        order = np.lexsort((self.alt, self.own))
        a, b = self.own[order], self.alt[order]
        return order[np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))] if len(order) else order

    def keys(self, of: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, key) for the paragraphs in ``of``: one-permutation MinHash, each bin a band of one row.

        The range of hashes is dealt into bins, and a bin's least member is its key. Two sets that reach the
        threshold differ in at most d = (1 - t) / (1 + t) of their sizes' sum; with more than d bins, some
        bin is the same in both. So the number of bins, a power of two, follows from the sizes that linked
        sets can have; a set near a step is keyed for both numbers. Bins that are the same can all be empty only
        in sets that occupy no more than d bins: these few are also keyed by their n - ceil(t n) + 1 least members, of
        which two linked sets share one. So any two linked sets share a key.
        """
        size = np.diff(self.at)
        most = size * (100 - threshold) // threshold
        low, high = self._levels(size * (100 - threshold) // 100), self._levels(most)
        crowded = np.zeros(len(size), bool)
        wanted = np.zeros(len(size), bool)
        wanted[of] = True
        units, keys = [], []
        for e in range(2, int(high[of].max(initial=0)) + 1):
            pick = (wanted & (low <= e) & (e <= high))[self.unit]
            u, x = self.unit[pick], self.items[pick]
            b = x >> np.uint64(64 - e)
            new = np.append(True, (u[1:] != u[:-1]) | (b[1:] != b[:-1])) if len(u) else np.empty(0, bool)
            units.append(u[new])
            keys.append(mix(x[new] + np.uint64(e)))
            filled = np.bincount(u[new], minlength=len(size))
            crowded |= (filled > 0) & (filled <= most)
        least = np.arange(len(self.items)) - self.at[self.unit] <= (size + -threshold * size // 100)[self.unit]
        pick = crowded[self.unit] & least
        units.append(self.unit[pick])
        keys.append(mix(self.items[pick] + np.uint64(64)))
        none = np.empty(0, np.int64)
        return np.concatenate(units or [none]), np.concatenate(keys or [none.view(np.uint64)]).view(np.int64)

    @staticmethod
    def _levels(differ: np.ndarray) -> np.ndarray:
        """The least e of at least 2 for which 2^e is more than the number of members in which sets differ."""
        return np.maximum(2, np.floor(np.log2(np.maximum(differ, 1))).astype(int) + 1)


def cuts(words: np.ndarray, reach: int) -> np.ndarray:
    """Whether the pair that starts at a word has the leftmost least hash of the pairs up to ``reach`` away."""
    out = np.zeros(len(words), bool)
    if len(words) < 2 * reach + 2:
        return out
    pairs = mix(words[:-1] * _P[0] + words[1:] * _P[1])
    side = np.lib.stride_tricks.sliding_window_view(pairs, reach).min(axis=1)
    mid = pairs[reach : len(pairs) - reach]
    out[reach : reach + len(mid)] = (mid < side[: len(mid)]) & (mid <= side[reach + 1 : reach + 1 + len(mid)])
    return out


def _held(docs: DataFrame) -> DataFrame:
    """doc_id and t, a hash of the text, stand for a row and its exact copies."""
    text = F.col("text").cast("string")
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("t"), text.alias("text"))


def paragraphs(docs: DataFrame, k: int, bits: int = 64) -> DataFrame:
    """(doc_id, t, start, n_words, own, alt) of every paragraph; own and alt are the hashes of its shingle set."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            p = Paragraphs(b.column("text").to_pylist(), k, bits=bits)
            take = pa.array(p.text)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("t").take(take), pa.array(p.start.astype(np.int32)), pa.array(p.words.astype(np.int32)), pa.array(p.own), pa.array(p.alt)],
                names=["doc_id", "t", "start", "n_words", "own", "alt"])

    return _held(docs).mapInArrow(make, "doc_id long, t long, start int, n_words int, own long, alt long")


def band_keys(docs: DataFrame, k: int, threshold: int, bits: int = 64) -> DataFrame:
    """(h, own, alt): the band keys of each paragraph set, once for all its copies in a slice of texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            p = Paragraphs(b.column("text").to_pylist(), k, bits=bits)
            unit, h = p.keys(p.distinct(), threshold)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(p.own[unit]), pa.array(p.alt[unit])], names=["h", "own", "alt"])

    return _held(docs).select("text").mapInArrow(make, "h long, own long, alt long")


def paragraph_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Full sets (id, n, items) of the ids in wanted(doc_id, t, start, id), each read from that place."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            p, asked = Paragraphs(b.column("text").to_pylist(), k), b.column("want")
            text = np.repeat(np.arange(b.num_rows), np.diff(asked.offsets.to_numpy()))
            asked = asked.flatten()
            ids, once = np.unique(asked.field("id").to_numpy(), return_index=True)
            start = asked.field("start").to_numpy().astype(np.int64)
            place = np.searchsorted(p.text << 32 | p.start, (text << 32 | start)[once])
            a, z = p.at[place], p.at[place + 1]
            items = [p.items[i:j].tobytes() for i, j in zip(a.tolist(), z.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(z - a, pa.int64()), pa.array(items, pa.binary())], names=["id", "n", "items"])

    lists = wanted.groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "id")).alias("want"))  # at most a text's own paragraphs
    return _held(docs).join(lists, ["doc_id", "t"]).select("text", "want").mapInArrow(make, SETS).dropDuplicates(["id"])


def repeated_paragraphs(docs: DataFrame, k: int = 5, threshold: int = 80, least: int = LEAST, scratch: Scratch | None = None, bits: int = 64) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, t, start, n_words, run_words, component_id, first_doc_id, first_start, copies, kept).

    Paragraphs (see above) whose sets of k-word shingles (A-Z lower-cased) have 100 * intersection >=
    threshold * union are linked; each component of two or more occurrences counts as repeated, with
    its first occurrence by (doc_id, start, t) kept. A row is one occurrence: n_words words from word
    ``start`` of the text with xxhash64 ``t``. Neighbouring repeated paragraphs of a text are one run of
    ``run_words`` words; runs shorter than ``least`` are left out of the result, as short phrases and
    single boilerplate lines repeat in clean text. Every paragraph is searched, whatever its size, and
    equal sets, by 128 bits of hash, are one node from the start. Null or empty texts have no paragraphs, rows without doc_id
    take no part, rows that share a doc_id are told apart by their text, and exact copies of a row
    count as copies that share one set of result rows; other columns are ignored; an empty table
    gives an empty result.
    """
    scratch = scratch or Scratch(docs.sparkSession, "paragraphs")
    some = docs.where(F.pmod(F.xxhash64(F.col("text").cast("string"), F.lit(1)), F.lit(256)) == 0)
    stored = scratch.save(paragraphs(docs, k, bits))
    ids, settled = NodeIds(), False
    while not settled:
        keys = [ids.of(band_keys(d, k, threshold, bits)).select("h", "id") for d in (docs, some)]
        met = scratch.save(meeting(*keys, scratch))
        every = ids.of(stored)
        classes = every.groupBy("id").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "start", "t")).alias("first"), ids.differ().alias("mixed"))
        classes = classes.join(met.select("id").distinct().withColumn("met", F.lit(True)), "id", "left").where("copies > 1 or met")
        classes = scratch.save(classes)
        settled = ids.settled(classes)  # a mixed id has two copies or more
    every = every.drop("own", "alt")
    source = classes.where("met").select("first.doc_id", "first.t", "first.start", "id")
    links, roots = near_links(met, lambda ids: paragraph_sets(docs, source, k), scratch, threshold, OddSketcher(bits=128))
    found = classes.join(roots, "id", "left").withColumn("component_id", F.coalesce("root", "id"))
    grouped = found.groupBy("component_id").agg(F.sum("copies").alias("copies"), F.min("first").alias("first")).where("copies > 1")
    member = scratch.save(found.select("id", "component_id").join(grouped, "component_id"))
    rows = every.join(member, "id").repartition("doc_id", "t").dropDuplicates(["doc_id", "t", "start"])
    text = Window.partitionBy("doc_id", "t").orderBy("start")  # the paragraphs of one text
    opens = F.coalesce(F.col("start") != F.lag(F.col("start") + F.col("n_words")).over(text), F.lit(True)).cast("int")
    rows = rows.withColumn("opens", opens).withColumn("run", F.sum("opens").over(text))
    rows = rows.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("doc_id", "t", "run")).cast("int")).where(F.col("run_words") >= least)
    out = scratch.save(rows.select(
        "doc_id", "t", "start", "n_words", "run_words", "component_id", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
        "copies", (F.col("first") == F.struct("doc_id", "start", "t")).alias("kept")))
    scratch.free(met, stored, classes, member, links)
    return out


def without_repeats(docs: DataFrame, k: int = 5, threshold: int = 80, least: int = LEAST, scratch: Scratch | None = None) -> DataFrame:
    """docs with every repeated paragraph but the first removed from ``text``, and n_chars counted anew if there.

    A paragraph goes with the white space that follows it; all else stays byte for byte. A document keeps its
    row even if nothing is left of its text; null ids and texts stay as they are.
    """
    return without_paragraphs(docs, F.col("doc_id"), repeated_paragraphs(docs, k, threshold, least, scratch).where("not kept"))


def without_paragraphs(docs: DataFrame, key: Column, spans: DataFrame) -> DataFrame:
    """docs without the paragraphs in spans(doc_id, t, start, n_words); ``key`` is what doc_id means for a row of docs."""
    gone = spans.groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "n_words")).alias("gone"))  # at most a text's own paragraphs
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for b in parts(batches, "row", field=at):
            columns = b.column("row").flatten()
            texts = [_without(t, g) if g else t for t, g in zip(columns[at].to_pylist(), b.column("gone").to_pylist(), strict=True)]
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                i = names.index("n_chars")
                sizes = [len(t) if g else n for t, g, n in zip(texts, b.column("gone").to_pylist(), columns[i].to_pylist(), strict=True)]
                columns[i] = pa.array(sizes, columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    row = docs.select(F.struct("*").alias("row"), key.cast("long").alias("d"), F.xxhash64(F.col("text").cast("string")).alias("s"))
    return row.join(gone, F.expr("d = doc_id and s = t"), "left").select("row", "gone").mapInArrow(cut, docs.schema)


def _without(text: str, gone: list[dict]) -> str:
    raw = np.frombuffer(text.encode(), np.uint8)
    space = np.isin(raw, [9, 10, 11, 12, 13, 32])
    begins = np.flatnonzero(~space & np.append(True, space[:-1]))
    begins = np.append(begins, len(raw))
    keep = np.ones(len(raw), bool)
    for g in gone:
        keep[begins[g["start"]] : begins[g["start"] + g["n_words"]]] = False
    return raw[keep].tobytes().decode()
