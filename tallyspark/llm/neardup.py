"""Near-duplicate links from banded MinHash samples, odd-sketch estimates and exact set comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, mix, parts
from .components import components


class MinHasher:
    """MinHash samples by multiply-add permutations, and the keys of ``bands`` bands of ``rows`` samples."""

    def __init__(self, bands: int = 32, rows: int = 4, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
        self.p = rng.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 1024):
            np.minimum(best, (x[at : at + 1024, None] * self.a + self.b).min(axis=0), out=best)
        return best

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        """(n, bands) int64; the band's number is part of its key."""
        s = samples.reshape(len(samples), self.bands, self.rows).astype(np.uint64)
        return mix((s * self.p).sum(axis=2, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


class OddSketcher:
    """Odd sketches: the ``keep`` least hashes of a set, its bottom MinHash samples, folded into ``bits`` parities.

    Equal samples cancel in the XOR of two sketches, so its population count is at most the number of
    samples in which they differ, and close to it while that is small against ``bits``. Sets of at most
    ``keep`` members are sampled whole: a count above the difference that the threshold allows then rules a
    pair out for certain. For larger sets the bound follows from the sizes of the pair and lies
    ``deviations`` standard deviations above the count expected at the threshold.
    """

    def __init__(self, keep: int = 1024, bits: int = 2048, deviations: float = 6.0):
        self.keep, self.bits, self.deviations = keep, bits, deviations

    def sketches(self, sets: list[np.ndarray]) -> np.ndarray:
        """(n, bits / 64) int64 from sorted hashes."""
        n = len(sets)
        if not n:
            return np.empty((0, self.bits // 64), np.int64)
        kept = [x[: self.keep] for x in sets]
        at = (mix(np.concatenate(kept)) % np.uint64(self.bits)).astype(np.int64)
        row = np.repeat(np.arange(n), [len(x) for x in kept])
        parity = (np.bincount(row * self.bits + at, minlength=n * self.bits) & 1).astype(np.uint8)
        return np.packbits(parity).view(np.int64).reshape(n, self.bits // 64)

    def flips(self) -> Column:
        """Population count of the XOR of the sketches oa and ob."""
        n = F.bit_count(F.col("oa")[0].bitwiseXOR(F.col("ob")[0]))
        for i in range(1, self.bits // 64):
            n = n + F.bit_count(F.col("oa")[i].bitwiseXOR(F.col("ob")[i]))
        return n

    def may_link(self, threshold: int) -> Column:
        """Whether (na, oa) and (nb, ob), sizes and sketches, can reach the similarity of threshold / 100."""
        n, most = F.col("na") + F.col("nb"), F.greatest("na", "nb")
        # A pair at the threshold has this share of the larger set in common; of its bottom ``keep`` as many.
        common = n * threshold / (100 + threshold) / most
        differ = F.least("na", F.lit(self.keep)) + F.least("nb", F.lit(self.keep)) - 2 * self.keep * common
        alone = F.exp(differ * (-2 / self.bits))
        spread = 4 * self.keep * common * (1 - common) * alone * alone
        folding = self.bits / 4 * (1 - alone * alone) - differ * alone * alone
        sampled = self.bits / 2 * (1 - alone) + self.deviations * F.sqrt(spread + F.greatest(folding, F.lit(0.0)))
        exact = n * (100 - threshold) / (100 + threshold)
        sizes = 100 * F.least("na", "nb") >= threshold * most
        return sizes & (self.flips() <= F.when(most <= self.keep, exact).otherwise(sampled) + 1e-6)


def list_array(matrix: np.ndarray) -> pa.Array:
    n, w = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * w, w, dtype=np.int32)), pa.array(matrix.ravel()))


class NodeIds:
    """Ids of nodes: 64 bits, as joins like them, told apart by 128.

    rows(own, alt, ...) name a set by two 64-bit hashes. Its id is ``own``; where rows of one id differ in own or
    alt, the callers report that id as mixed, and its rows get new ids from both hashes, until none is mixed.
    """

    def __init__(self):
        self.mixed: list[DataFrame] = []

    def of(self, rows: DataFrame) -> DataFrame:
        """rows with id."""
        rows = rows.withColumn("id", F.col("own"))
        for salt, ids in enumerate(self.mixed):
            rows = rows.join(ids.withColumn("_mixed", F.lit(True)), "id", "left")
            rows = rows.withColumn("id", F.when(F.col("_mixed"), F.xxhash64("own", "alt", F.lit(salt))).otherwise(F.col("id"))).drop("_mixed")
        return rows

    @staticmethod
    def differ() -> Column:
        """Aggregate over the rows of an id: whether it is mixed."""
        return (F.min("own") < F.max("own")) | (F.min("alt") < F.max("alt"))

    def settled(self, classes: DataFrame) -> bool:
        """classes(id, mixed, ...), a saved table: whether no id is mixed; those that are get new ids from now on."""
        ids = classes.where("mixed").select("id")
        if ids.isEmpty():
            return True
        self.mixed.append(ids)
        return False


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Keeps pairs (a, b) with 100 * |A and B| >= threshold * |A or B| on the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("sb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches, "sa"):
            keep = []
            for x, y in zip(t.column("sa"), t.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(check, pairs.select("a", "b").schema)


def _sketched(sets: DataFrame, sketcher: OddSketcher) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches, "items", 1 << 22):
            odd = sketcher.sketches([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("items")])
            yield pa.RecordBatch.from_arrays([t.column("id"), t.column("n"), t.column("items"), list_array(odd)], names=["id", "n", "items", "odd"])

    return sets.mapInArrow(make, "id long, n long, items binary, odd array<long>")


def _prefixes(sets: DataFrame, threshold: int) -> DataFrame:
    """(h, id): for each set its n - ceil(t n) + 1 rarest members, of which two linked sets share one."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches, "items", 1 << 22):
            ends = np.cumsum([0, *t.column("n").to_pylist()])
            joined = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in t.column("items")] or [np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([t.column("id"), t.column("n"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(joined))], names=["id", "n", "items"])

    flat = sets.select("id", "n", "items").mapInArrow(members, "id long, n long, items array<long>").select("id", "n", F.explode("items").alias("h"))
    common = flat.groupBy("h").agg(F.count("*").alias("df"))
    ranked = flat.join(common, "h").withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("df", "h")))
    return ranked.where(f"r <= n - ceil({threshold} * n / 100) + 1 and df > 1").select("h", "id")


def _across(at: DataFrame, sketcher: OddSketcher, threshold: int) -> DataFrame:
    """at(h, id, c, n, odd) -> pairs (a, b) that share an h, differ in c and may be linked by their sketches.

    The members of an h's largest c are not compared with each other, and the sketches are compared
    inside the join, so only pairs that may be linked come out of it.
    """
    mixed = at.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("h")
    held = at.join(mixed, "h")
    major = held.groupBy("h", "c").count().groupBy("h").agg(F.max_by("c", F.struct("count", "c")).alias("most"))
    held = held.join(major, "h")
    rare = held.where("c <> most").select("h", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("odd").alias("oa"))
    every = held.select(F.col("h").alias("h2"), F.col("id").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), F.col("odd").alias("ob"), (F.col("c") == F.col("most")).alias("big"))
    pairs = rare.join(every, F.expr("h = h2 and ca <> cb and (big or a < b)") & sketcher.may_link(threshold))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


#: The member of a bucket nearest to each mask by XOR is a pivot, beside the least and the greatest.
_MASKS = (0x5555555555555555, 0x3333333333333333)


def meeting(flat: DataFrame, sample: DataFrame, scratch: Scratch, hot: int = 256) -> DataFrame:
    """flat(h, id) -> its rows, repeats aside, whose h has two or more different ids.

    The keys are shuffled once. Those with ``hot`` rows or more in ``sample``, a small part of flat, go
    another way, by a join that Spark can split, so that no task holds a group that grows with
    the corpus; which way a key goes does not change the result.
    """
    often = scratch.save(sample.groupBy("h").count().where(f"count >= {hot}").select("h"))
    group = Window.partitionBy("h")
    one_pass = lambda rows: rows.withColumn("lo", F.min("id").over(group)).withColumn("hi", F.max("id").over(group)).where("lo < hi").select("h", "id").distinct()
    if often.isEmpty():
        return one_pass(flat)
    crowded = flat.join(often, "h", "left_semi")
    mixed = crowded.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
    return one_pass(flat.join(often, "h", "left_anti")).unionByName(crowded.join(mixed, "h").distinct())


def near_links(
    met: DataFrame, sets_of: Callable[[DataFrame], DataFrame], scratch: Scratch, threshold: int = 80,
    sketcher: OddSketcher | None = None, closest: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """met(h, id), a saved table of the band keys that nodes share -> (links(a, b), labels(id, root)).

    Nodes that share a band are candidates. ``sets_of(ids)`` returns their (id, n, items) with the sorted
    shingle hashes as bytes; each gets an odd sketch, and only pairs that the sketches leave possible
    are compared exactly.

    A large group of copies is joined in linear work: of a few pivots of each of its buckets, each node is
    compared with the ``closest`` by sketch. Nodes that still share a bucket but no
    component are then compared with those that share one of their rarest shingles, which any linked
    pair does; so no link between components is lost, and pairs already joined are not compared.
    """
    sketcher = sketcher or OddSketcher()
    i = F.col("id")
    picks = [F.min(i), F.max(i), *[F.min(i.bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)) for m in _MASKS]]
    pivots = met.groupBy("h").agg(F.array_distinct(F.array(*picks)).alias("pivots"))
    stars = scratch.save(met.join(pivots, "h").select(F.explode("pivots").alias("a"), F.col("id").alias("b")).where("a <> b").distinct())
    sets = scratch.save(_sketched(sets_of(met.select("id").distinct()), sketcher))
    end = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias("n" + x), F.col("odd").alias("o" + x))
    likely = stars.join(end("a"), "a").join(end("b"), "b").where(sketcher.may_link(threshold)).select("b", F.struct(sketcher.flips().alias("flips"), "a").alias("x"))
    best = F.slice(F.array_sort(F.collect_list("x")), 1, closest)  # of a few pivots a band
    likely = likely.groupBy("b").agg(best.alias("x")).select("b", F.explode("x").alias("x")).select("x.a", "b")
    links = scratch.save(_verified(likely, sets, threshold))
    scratch.free(stars)
    labels = components(links, scratch)
    labelled = lambda rows: rows.join(labels, "id", "left").withColumn("c", F.coalesce("root", "id")).drop("root")
    at = labelled(met)
    mixed = at.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("h")
    loose = scratch.save(at.join(mixed, "h").select("id").distinct())
    if not loose.isEmpty():
        rarest = _prefixes(sets.join(loose, "id", "left_semi"), threshold).join(sets.select("id", "n", "odd"), "id")
        rarest = scratch.save(labelled(rarest))
        pairs = scratch.save(_across(rarest, sketcher, threshold))
        found = scratch.save(_verified(pairs, sets, threshold))
        if not found.isEmpty():
            links = scratch.save(links.unionByName(found))
            labels = components(links, scratch)
        scratch.free(rarest, pairs)
    scratch.free(sets, loose)
    return links, labels


SETS = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("items", T.BinaryType())])
