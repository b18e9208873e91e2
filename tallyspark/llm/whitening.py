"""Embedding whitening by blockwise TSQR and a one-sided Jacobi SVD (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
LONG = 2**63 - 1


def _rounds(d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of disjoint pairs (a round-robin tournament)."""
    ring = list(range(d + d % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[: half - 1 : -1], strict=True) if max(a, b) < d]
        if pairs:
            yield np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def jacobi(r: np.ndarray, tolerance: float = 1e-15, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as columns) of r, by falling value.

    Plane rotations make the columns of r orthogonal; their product holds the vectors. The pairs of a
    round are disjoint, so a round is one array operation.
    """
    a, v = r.astype(np.float64, copy=True), np.eye(r.shape[1])
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(a.shape[1]):
            alpha, beta, gamma = (np.einsum("ij,ij->j", a[:, x], a[:, y]) for x, y in ((p, p), (q, q), (p, q)))
            on = np.abs(gamma) > tolerance * np.sqrt(alpha * beta)
            if not on.any():
                continue
            turned, p, q = True, p[on], q[on]
            zeta = (beta[on] - alpha[on]) / (2 * gamma[on])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            for m in (a, v):
                m[:, p], m[:, q] = c * m[:, p] - s * m[:, q], s * m[:, p] + c * m[:, q]
        if not turned:
            break
    norms = np.linalg.norm(a, axis=0)
    order = np.argsort(-norms, kind="stable")
    v = v[:, order]
    return norms[order], v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)


def _integers(column: pa.Array, scale: float, offset: int) -> np.ndarray:
    """Equally long vectors as the rows of an integer matrix; numbers beyond 2**62 are held at that."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(flat * scale), -(2.0**62), 2.0**62).astype(np.int64) + offset
    return x.reshape(len(column), -1)


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, as 64-bit numbers where they hold it, else as Python's."""
    if len(x) and n * int(np.abs(x).max()) + max(map(abs, sums)) >= 2**62:
        return n * x.astype(object) - np.array(sums, dtype=object)
    return n * x - np.array(sums, dtype=np.int64)


def _deviations(z: np.ndarray) -> list[int | None]:
    """Row sums of squares; None where a long doesn't hold it."""
    if z.dtype != object and (np.square(z, dtype=np.float64).sum(axis=1) < 2.0**62).all():
        return np.square(z).sum(axis=1).tolist()
    return [t if t <= LONG else None for t in (sum(int(v) ** 2 for v in row) for row in z)]


def _added(partial: DataFrame, keys: tuple[str, ...] = ()) -> list:
    """Arrays in column v, added up by place: rows (keys..., pos, v)."""
    return partial.select(*keys, F.posexplode("v").alias("pos", "v")).groupBy(*keys, "pos").agg(F.sum("v").alias("v")).orderBy(*keys, "pos").collect()


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
    scale: float = 1024.0, offset: int = 100_000, fan: int = 16, rows: int = 4096,
) -> DataFrame:
    """vectors(vec_id, embedding, ...) -> (vec_id, component, n, deviation, whitened, explained, identity_error).

    Entries c become x = floor(scale * c) + offset. Rows whose vector is null, empty or holds null or
    non-finite entries take no part, nor do rows of another length than the most frequent one (the
    smaller of two as frequent). Each of the n rows that remain, repeated and id-less ones too, comes back once for each component
    up to ``components`` or the length. Components are numbered by falling variance; the largest entry
    of each is positive. explained is a component's share of all variance; identity_error is the largest
    entry of the whitened rows' covariance less the identity, over all rows. A component without variance
    has whitened null and explained 0 and is left out of identity_error; if none has any, both are null.
    deviation is null where a long can't hold it. An empty table gives an empty result; other columns are ignored.

    Every task folds its rows, ``rows`` at a time, into one triangle R; triangles are stacked ``fan`` at a time
    until at most ``fan`` remain, so the driver sees numbers by dimension only and no task more than fan triangles.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    held = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    held = held.where(F.expr("size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('Infinity'))"))

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            column = b.column("v")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                x = _integers(column.filter(pa.array(lengths == d)), scale, offset)
                totals[d] = totals.get(d, 0) + np.concatenate([[len(x)], x.sum(axis=0)])
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.int64()))], names=["d", "v"])

    found: dict[int, list[int]] = {}
    for r in _added(held.select("v").mapInArrow(sums_of, "d int, v array<long>"), ("d",)):
        found.setdefault(r["d"], []).append(r["v"])
    if not found:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    d = min(found, key=lambda x: (-found[x][0], x))
    n, *sums = found[d]
    held = held.where(F.size("v") == d)

    def centred(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        z = _exact(_integers(column, scale, offset), n, sums)
        return z, (z / n).astype(np.float64)

    def pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            for part in pieces(b):
                r = np.linalg.qr(np.concatenate([r, centred(part.column("v"))[1]]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["r"])

    def stacked(table: pa.Table) -> pa.Table:
        r = np.zeros((0, d))
        for x in table.column("r").to_pylist():
            r = np.linalg.qr(np.concatenate([r, np.array(x).reshape(-1, d)]), mode="r")
        return pa.table({"at": table.column("up").slice(0, 1), "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})

    level = scratch.save(held.select("v").mapInArrow(triangles, "r array<double>").select(F.spark_partition_id().cast("long").alias("at"), "r"))
    while level.agg(F.max("at")).first()[0] >= fan:
        level = scratch.save(level.select(F.floor(F.col("at") / fan).alias("up"), "r").groupBy("up").applyInArrow(stacked, "at long, r array<double>"))
    r = np.concatenate([np.array(x["r"]).reshape(-1, d) for x in level.orderBy("at").collect()])
    values, basis = jacobi(np.linalg.qr(r, mode="r"))
    k = min(components, d)
    total = float(np.square(values).sum())
    explained = [float(v * v / total) if total else None for v in values[:k]]
    real = values[:k] > values[0] * d * np.finfo(float).eps
    project = basis[:, :k] / np.where(real, values[:k] / np.sqrt(n), np.inf)

    def covariances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = int(real.sum())
        moved, spread = np.zeros(m), np.zeros((m, m))
        for b in batches:
            for part in pieces(b):
                w = (centred(part.column("v"))[1] @ project)[:, real]
                mean = w.mean(axis=0)
                moved += len(w) * mean
                spread += (w - mean).T @ (w - mean) + len(w) * np.outer(mean, mean)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([moved, spread.ravel()]).tolist()], pa.list_(pa.float64()))], names=["v"])

    error = None
    if real.any():
        c = np.array([x["v"] for x in _added(held.select("v").mapInArrow(covariances, "v array<double>"))]) / n
        m = int(real.sum())
        error = float(np.abs(c[m:].reshape(m, m) - np.outer(c[:m], c[:m]) - np.eye(m)).max())

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in pieces(b):
                z, c = centred(part.column("v"))
                size, w = len(z), c @ project
                every = np.repeat(np.arange(size), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, n, np.int64)),
                    pa.array(_deviations(z), pa.int64()).take(pa.array(every)), pa.array(w.ravel(), mask=np.tile(~real, size)),
                    pa.array(explained * size, pa.float64()), pa.array([error] * (size * k), pa.float64()),
                ], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return held.mapInArrow(result, SCHEMA)
