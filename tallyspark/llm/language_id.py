"""Language identification by a byte convolutional network trained in numpy (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .sampling import bounded_sample

WINDOW = 96
#: What counts as a letter, in training and prediction alike.
LETTER = r"\p{L}"


class ByteCNN:
    """Filters of several widths over one-hot bytes, max pooling over the window, softmax.

    A filter of width w over one-hot bytes is a sum of w table rows, so ``tables[w][j]`` holds for every
    byte value what it adds at offset j to each filter.
    """

    def __init__(self, labels: list[str], widths: tuple[int, ...] = (2, 3, 4), filters: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, self.filters = labels, filters
        self.tables = {w: rng.normal(0, 0.5, (w, 256, filters)).astype(np.float32) for w in widths}
        self.dense = rng.normal(0, 0.2, (filters * len(widths), len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def _pooled(self, x: np.ndarray, at: bool = False):
        """x: (n, WINDOW) bytes -> pooled features (n, filters * widths), and where each maximum is."""
        out, where = [], []
        for w, t in self.tables.items():
            c = t[0][x[:, : WINDOW - w + 1]]
            for j in range(1, w):
                c += t[j][x[:, j : WINDOW - w + 1 + j]]
            if at:
                where.append(c.argmax(axis=1))
            out.append(c.max(axis=1))
        return np.concatenate(out, axis=1), where

    def probabilities(self, x: np.ndarray, step: int = 512) -> np.ndarray:
        out = np.empty((len(x), len(self.labels)), np.float32)
        for i in range(0, len(x), step):
            f, _ = self._pooled(x[i : i + step])
            out[i : i + step] = _softmax(np.maximum(f, 0) @ self.dense + self.bias)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, least_steps: int = 300, batch: int = 128, rate: float = 0.01, seed: int = 2) -> ByteCNN:
        """A small sample gets more epochs, for ``least_steps`` steps at least.

        In each batch one window in three is cut short and filled up with spaces, as the end of a text is.
        """
        rng, step = np.random.default_rng(seed), 0
        epochs = max(epochs, -(-least_steps // -(-len(x) // batch)))
        params = [*self.tables.values(), self.dense, self.bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                take = order[i : i + batch]
                seen = _cut_short(x[take], rng)
                f, where = self._pooled(seen, at=True)
                r = np.maximum(f, 0)
                g = _softmax(r @ self.dense + self.bias)
                g[np.arange(len(take)), y[take]] -= 1
                g /= len(take)
                gf = (g @ self.dense.T) * (f > 0)
                grads = []
                rows, cols = np.arange(len(take))[:, None], np.arange(self.filters)[None, :]
                for k, (w, t) in enumerate(self.tables.items()):
                    gk, gt = gf[:, k * self.filters : (k + 1) * self.filters], np.zeros_like(t)
                    for j in range(w):
                        np.add.at(gt[j], (seen[rows, where[k] + j], np.broadcast_to(cols, gk.shape)), gk)
                    grads.append(gt)
                grads += [r.T @ g, g.sum(axis=0)]
                step += 1
                for p, d, a, b in zip(params, grads, m, v, strict=True):
                    a += 0.1 * (d - a)
                    b += 0.001 * (d * d - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)
        return self


def _cut_short(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    ends = np.where(rng.random(len(x)) < 1 / 3, rng.integers(8, WINDOW, len(x)), WINDOW)
    return np.where(np.arange(WINDOW) < ends[:, None], x, np.uint8(32))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows(text: str) -> np.ndarray:
    """The whole text in rows of WINDOW bytes, A-Z lower-cased, the last row filled up with spaces."""
    raw = text.encode().lower()
    raw += b" " * (-len(raw) % WINDOW)
    return np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)


def train(docs: DataFrame, per_language: int = 800, windows_each: int = 4, seed: int = 9) -> ByteCNN | None:
    """Fits the network on at most ``per_language`` documents a language, ``windows_each`` windows of each."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", "text")
    sample = bounded_sample(rows.where(F.col("text").rlike(LETTER)), "lang", "doc_id", per_language, seed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, lang, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text")), strict=True):
                w = windows(t)
                pick = np.random.default_rng(abs(hash((int(d), seed))) % 2**32).permutation(len(w))[:windows_each]
                out += [(lang, w[i].tobytes()) for i in sorted(pick.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.binary())], names=["lang", "w"])

    got = sorted(tuple(r) for r in sample.mapInArrow(cut, "lang string, w binary").collect())
    if not got:
        return None
    labels = sorted({r[0] for r in got})
    x = np.frombuffer(b"".join(r[1] for r in got), np.uint8).reshape(-1, WINDOW)
    return ByteCNN(labels).fit(x, np.array([labels.index(r[0]) for r in got]))


def predict(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, lang_pred, score): the mean of the window probabilities over the whole text.

    ``und`` with score 0 if the text is null or has no letter, or if nothing could be learned.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, value = ["und"] * len(b), [0.0] * len(b)
            seen = np.flatnonzero(b.column("letters").to_numpy(zero_copy_only=False)) if model else np.empty(0, np.int64)
            texts, at = b.column("text").take(pa.array(seen)).to_pylist(), 0
            for some in slices(texts):
                parts = [windows(t) for t in some]
                p = model.probabilities(np.concatenate(parts)).astype(np.float64)
                starts = np.cumsum([0, *(len(x) for x in parts)])
                mean = np.add.reduceat(p, starts[:-1], axis=0) / np.diff(starts)[:, None]
                for i, k, s in zip(seen[at : at + len(some)].tolist(), mean.argmax(axis=1), mean.max(axis=1), strict=True):
                    lang[i], value[i] = model.labels[k], min(1.0, float(s))
                at += len(some)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang), pa.array(value, pa.float64())], names=["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    held = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.coalesce(text.rlike(LETTER), F.lit(False)).alias("letters"))
    return held.mapInArrow(score, "doc_id long, lang_pred string, score double")


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the doc_id as text leaves this remainder; false for a null doc_id, which is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def identify_languages(docs: DataFrame, per_language: int = 800) -> DataFrame:
    """docs(doc_id, text, lang, ...) -> (doc_id, held_out, lang_pred, score), one row per input row.

    Learns from rows with an id and a lang whose crc32(doc_id) mod 5 is not 0; predictions use the text
    alone. Null or letterless texts are ``und``; repeated rows each come back; other columns are ignored;
    an empty table gives an empty result.
    """
    model = train(docs.where(~held_out(5, 0)), per_language)
    return predict(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
