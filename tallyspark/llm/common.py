"""Shared helpers: durable intermediate tables, table loading, word and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import Scratch  # noqa: F401

_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts in turn, about ``most`` characters at a time."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield texts[at:i]
            at, size = i, 0
        size += len(t or "")
    if texts:
        yield texts[at:]


def parts(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 1 << 20, field: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in turn in slices of about ``most`` bytes of a column or of its ``field``, a row at least, so that few of its values are Python objects at once."""
    for b in batches:
        held = b.column(column) if field is None else b.column(column).flatten()[field]
        ends = np.cumsum(pc.fill_null(pc.binary_length(held), 0).to_numpy().astype(np.int64))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield b.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all whitespace-separated words, A-Z lower-cased, and how many each text has; whitespace is x20 and x09-x0D."""
    split = [(t or "").encode().lower().split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, int(counts.sum())), counts


def word_hashes(text: str | None) -> np.ndarray:
    return words_of([text])[0]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words make one shingle, no words none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        return mix(np.array([(words * _P[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
    h = words[: n - k + 1] * _P[0]
    for j in range(1, k):
        h = h + words[j : n - k + 1 + j] * _P[j]
    return np.unique(mix(h))
