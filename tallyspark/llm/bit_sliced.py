"""Exact top-k inner products over a bit-sliced index (operator 7).

The index holds blocks of rows; within a block, every attribute is kept as bit slices: slice j of an attribute
is a bitmap over the block's rows with bit j of their values. A query's weighted sum is built with
bitmap arithmetic for all rows at once, and the best rows are found from its most significant slice
downward.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

ROWS, QUERIES, INNER = 2048, 256, 16
#: Index blocks that a task holds while the queries stream past.
HELD = 16


@contextmanager
def _small_batches(spark: SparkSession, rows: int):
    """Rows here are whole blocks; a few at a time go through Arrow."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def quantised(vectors: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ids, integer vectors) of the rows that take part."""
    ids, out = [], []
    for i, v in zip(vectors.column("vec_id").to_pylist(), vectors.column("embedding"), strict=True):
        if i is None or not v.is_valid or v.values.null_count:
            continue
        x = np.floor(256 * np.asarray(v.values, np.float64))
        if np.isfinite(x).all():
            ids.append(i)
            out.append(x.astype(np.int64))
    return np.array(ids, np.int64), out


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values (rows, dims) -> (slices (bits, dims, words), least value of each dim); slices hold value - least."""
    low = values.min(axis=0)
    x = (values - low).astype(np.uint64)
    bits = max(1, int(x.max(initial=0)).bit_length())
    rows = -(-len(x) // 64) * 64
    out = np.empty((bits, x.shape[1], rows // 64), np.uint64)
    for j in range(bits):
        plane = np.zeros((x.shape[1], rows), np.uint8)
        plane[:, : len(x)] = ((x >> np.uint64(j)) & np.uint64(1)).T
        out[j] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return out, low


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two numbers of as many slices (first axis, least significant first), one slice longer."""
    out = np.empty((len(a) + 1, *np.broadcast_shapes(a.shape[1:], b.shape[1:])), np.uint64)
    np.bitwise_xor(a[0], b[0], out=out[0])
    carry = a[0] & b[0]
    for j in range(1, len(a)):
        x = a[j] ^ b[j]
        np.bitwise_xor(x, carry, out=out[j])
        carry &= x
        carry |= a[j] & b[j]
    out[-1] = carry
    return out


def _widened(a: np.ndarray, bits: int) -> np.ndarray:
    return np.concatenate([a, np.zeros((bits - len(a), *a.shape[1:]), np.uint64)]) if len(a) < bits else a


def weighted_sums(slices: np.ndarray, low: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slices (bits, queries, words), offset (queries,)): inner product = sliced number + offset.

    A negative weight takes the complement of an attribute's slices, so that all terms add up.
    """
    bits, dims, words = slices.shape
    size = np.abs(q)
    minus = np.where(q < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)).T  # (dims, queries)
    x = slices[:, :, None, :] ^ minus[None, :, :, None]
    total = None
    for t in range(max(1, int(size.max(initial=0)).bit_length()) - 1, -1, -1):
        mask = np.where((size >> t) & 1 == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)).T
        level = x & mask[None, :, :, None]
        while level.shape[1] > 1:
            if level.shape[1] % 2:
                level = np.concatenate([level, np.zeros_like(level[:, :1])], axis=1)
            level = _add(level[:, 0::2], level[:, 1::2])
        part = level[:, 0]
        if total is None:
            total = part
        else:
            total = np.concatenate([np.zeros_like(total[:1]), total])
            n = max(len(total), len(part))
            total = _add(_widened(total, n), _widened(part, n))
    offset = (q * low).sum(axis=1) - ((size * (q < 0)).sum(axis=1) * ((1 << bits) - 1))
    return total, offset


def top_rows(total: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied) bitmaps (queries, words): rows above the k-th value, and rows equal to it."""
    sure, tied = np.zeros_like(valid), valid.copy()
    count = lambda m: np.bitwise_count(m).sum(axis=1, dtype=np.int64)
    have = np.zeros(len(valid), np.int64)
    for plane in total[::-1]:
        x = tied & plane
        n = have + count(x)
        take, narrow = (n <= k), (n > k)
        sure = np.where(take[:, None], sure | x, sure)
        tied = np.where(narrow[:, None], x, tied & ~x)
        have = np.where(take, n, have)
    return sure, tied


def _bits(mask: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))


def search_block(ids: np.ndarray, slices: np.ndarray, low: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, row, score) of each query's best k rows of the block, its own left out; ids ascend, so ties go to the smaller."""
    words = slices.shape[2]
    full = np.packbits(np.arange(words * 64) < len(ids), bitorder="little").view(np.uint64)
    for at in range(0, len(q), INNER):
        total, offset = weighted_sums(slices, low, q[at : at + INNER])
        own = qids[at : at + INNER]
        valid = np.tile(full, (len(own), 1))
        for r, i in enumerate(np.searchsorted(ids, own)):
            while i < len(ids) and ids[i] == own[r]:
                valid[r, i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
                i += 1
        sure, tied = top_rows(total, valid, k)
        for r in range(len(own)):
            rows = _bits(sure[r])
            rows = np.concatenate([rows, _bits(tied[r])[: k - len(rows)]])
            got = (total[:, r, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
            score = (got.astype(np.int64) << np.arange(len(total))[:, None]).sum(axis=0) + offset[r]
            yield from zip([int(own[r])] * len(rows), ids[rows].tolist(), score.tolist(), strict=True)


def _blocks(every: int, sliced: bool):
    """Packs a partition's rows into blocks of up to ``every`` vectors of one dimension."""

    def pack(number: int, dim: int, rows: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        ids, x = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows]).reshape(len(rows), dim)
        s, low = slices_of(x) if sliced and dim else (x, np.zeros(dim, np.int64))
        part = (TaskContext.get().partitionId() << 32) + number // HELD
        cols = [pa.array([part], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(s) if sliced else 0], pa.int32())]
        cols += [pa.array([b.tobytes()], pa.binary()) for b in (ids, s, low)]
        return pa.RecordBatch.from_arrays(cols, names=["part", "dim", "bits", "ids", "data", "low"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        number = 0
        for b in batches:
            for i, v in zip(*quantised(b), strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((int(i), v))
                if len(rows) == every:
                    yield pack(number, len(v), held.pop(len(v)))
                    number += 1
        for dim, rows in held.items():
            yield pack(number, dim, rows)
            number += 1

    return make


_PACKED = "part long, dim int, bits int, ids binary, data binary, low binary"


def top_k(vectors: DataFrame, every_nth: int = 50, k: int = 5) -> DataFrame:
    """vectors(vec_id, embedding, ...) -> (query_id, rank, vec_id, score).

    Components become floor(256 * x). Queries are the rows whose vec_id is divisible by ``every_nth``; each gets
    the ``k`` rows with the largest integer inner product (all, if fewer), ties to the smaller vec_id,
    rows with its own id left out. Vectors that are null, hold a null or a non-finite component or have no id take
    no part; repeated rows (same id, same vector) count once; only vectors of one length are compared;
    values are taken to fit the score's 64 bits; other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = scratch.save(vectors.where("vec_id is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).distinct())
    index = scratch.save(rows.mapInArrow(_blocks(ROWS, True), _PACKED))
    asked = scratch.save(rows.where(F.col("vec_id") % every_nth == 0).coalesce(8).mapInArrow(_blocks(QUERIES, False), _PACKED))
    # A stated query set against all rows: each part of up to HELD index blocks sees every query block of its dimensions once.
    past = asked.drop("part").join(index.select("part", "dim").distinct(), "dim")
    stream = index.withColumn("asks", F.lit(False)).unionByName(past.withColumn("asks", F.lit(True)))
    stream = stream.repartition("part").sortWithinPartitions("part", "asks")

    def best_of(blocks: list[tuple], r: dict) -> list[tuple[int, int, int]]:
        """The best k of a part's rows for each query of a block."""
        dim, qids = r["dim"], np.frombuffer(r["ids"], np.int64)
        out = []
        for ids, s, low in (b[1:] for b in blocks if b[0] == dim):
            if not dim:  # vectors without components all score 0
                out += [(int(q), int(i), 0) for q in qids for i in ids[ids != q][:k]]
            else:
                out += search_block(ids, s, low, qids, np.frombuffer(r["data"], np.int64).reshape(-1, dim), k)
        out.sort(key=lambda x: (x[0], -x[2], x[1]))
        return [x for i, x in enumerate(out) if i < k or out[i - k][0] != x[0]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for b in batches:
            for r in b.to_pylist():
                if r["part"] != part:
                    part, blocks = r["part"], []
                if r["asks"]:
                    out = best_of(blocks, r)
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])
                else:
                    s = np.frombuffer(r["data"], np.uint64).reshape(r["bits"], r["dim"], -1) if r["dim"] else None
                    blocks.append((r["dim"], np.frombuffer(r["ids"], np.int64), s, np.frombuffer(r["low"], np.int64)))

    with _small_batches(spark, 16):
        best = scratch.save(stream.mapInArrow(search, "query_id long, vec_id long, score long"))
    first = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.distinct().withColumn("rank", first.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
