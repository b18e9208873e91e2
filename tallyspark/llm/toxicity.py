"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, parts
from .language_id import held_out
from .sampling import bounded_sample

WORDS, TRIGRAMS = 1 << 13, 1 << 13
LENGTH, STRIDE = 24, 16
#: So many bytes of text are turned into words at once.
PIECE = 1 << 17
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def _cut(raw: bytes, most: int) -> Iterator[bytes]:
    """A text in pieces of about ``most`` bytes, a window at least, whose windows together are those of the text."""
    inside = np.concatenate([[False], ~_SPACE[np.frombuffer(raw, np.uint8)], [False]])
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    n, at = len(start), 0
    while at + LENGTH < n:
        within = int(np.searchsorted(end, start[at] + most, side="right")) - at
        last = at + LENGTH + max(0, (within - LENGTH) // STRIDE) * STRIDE
        if last >= n:
            break
        yield raw[start[at] : end[last - 1]]
        at = last - LENGTH + STRIDE
    at = min(at, max(0, n - LENGTH))  # the last window is as long as the others
    yield raw[start[at] : end[-1]] if n else b""


def _pieces(texts: list[str | None], most: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """The texts in turn, about ``most`` bytes at a time, longer ones cut: (each one's number, the bytes)."""
    which, held, size = [], [], 0
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        for piece in _cut(raw, most) if len(raw) > most else [raw]:
            if held and size + len(piece) > most:
                yield which, held
                which, held, size = [], [], 0
            which.append(i)
            held.append(piece)
            size += len(piece)
    if held:
        yield which, held


class Words:
    """The words of some texts: hashed word and byte-trigram inputs, and the overlapping windows over each text.

    A text of n words has windows of LENGTH words that start every STRIDE words until its end is
    covered; an empty text has one window without words.
    """

    def __init__(self, texts: list[str | bytes | None]):
        raw = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
        b = _LOWER[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
        inside = ~_SPACE[b]
        b = np.where(inside, b, np.uint8(32))
        edge = np.diff(inside.astype(np.int8))
        self.start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        u = b.astype(np.uint64)
        tri = mix((u[:-2] << np.uint64(16)) | (u[1:-1] << np.uint64(8)) | u[2:]) % np.uint64(TRIGRAMS)
        self.tri = np.concatenate([[0], tri.astype(np.int64), [0]])  # at each byte, the trigram around it
        self.size = end - self.start
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(u + np.uint64(1)) * (np.arange(len(u), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))])
        # Position weights are odd numbers; relative to a word's start they are undone by the byte sum.
        plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(u + np.uint64(1)))])
        h = total[end] - total[self.start] - np.uint64(2) * self.start.astype(np.uint64) * (plain[end] - plain[self.start])
        self.word = (mix(h) % np.uint64(WORDS)).astype(np.int64)
        offsets = np.cumsum([1, *(len(r) + 1 for r in raw)])
        first = np.searchsorted(self.start, offsets)
        n = np.diff(first)
        per = np.where(n <= LENGTH, 1, -(-(n - LENGTH) // STRIDE) + 1)
        self.text = np.repeat(np.arange(len(raw)), per)
        self.first_window = np.cumsum([0, *per])
        k = np.arange(len(self.text)) - self.first_window[self.text]
        at = first[self.text] + np.where(k == per[self.text] - 1, np.maximum(0, n[self.text] - LENGTH), k * STRIDE)
        left = first[self.text + 1] - at
        self.index = np.where(np.arange(LENGTH) < left[:, None], at[:, None] + np.arange(LENGTH), -1)  # -1: no word

    def __len__(self):
        return len(self.index)


class ToxicityNet:
    """Word and character inputs, a GRU in each direction, attention over the states, one logit a window."""

    def __init__(self, width: int = 16, hidden: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        f = lambda s, *shape: rng.normal(0, s, shape).astype(np.float32)
        h = hidden
        self.h, self.d = h, width
        self.p = {"word": f(0.3, WORDS, width), "tri": f(0.3, TRIGRAMS, width), "a": f(0.3, 2 * h), "w": f(0.3, 2 * h), "c": np.zeros(1, np.float32)}
        for k in "fb":
            self.p |= {f"W{k}": f(0.25, 2 * width, 3 * h), f"U{k}": f(0.25, h, 3 * h), f"b{k}": np.zeros(3 * h, np.float32)}

    def inputs(self, t: Words) -> np.ndarray:
        """(words + 1, 2 * width): word vector and mean trigram vector; the last row, of zeros, is no word."""
        x = np.zeros((len(t.word) + 1, 2 * self.d), np.float32)
        if len(t.word):
            x[:-1, : self.d] = self.p["word"][t.word]
            spans = np.stack([t.start, t.start + t.size], axis=1).ravel()
            x[:-1, self.d :] = np.add.reduceat(self.p["tri"][t.tri], spans, axis=0)[::2] / np.sqrt(t.size)[:, None]
        return x

    def _gru(self, k: str, gates: np.ndarray, keep: list | None):
        """gates: (LENGTH, n, 3h) input parts, in the order of reading -> (LENGTH, n, 2h or h) states."""
        h, u = self.h, self.p[f"U{k}"]
        s = np.zeros((gates.shape[1], h), np.float32)
        out = np.empty((len(gates), gates.shape[1], h), np.float32)
        for i, g in enumerate(gates):
            v = s @ u
            zr = 1 / (1 + np.exp(-(g[:, : 2 * h] + v[:, : 2 * h])))
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(g[:, 2 * h :] + r * v[:, 2 * h :])
            new = n + z * (s - n)
            if keep is not None:
                keep.append((s, z, r, n, v[:, 2 * h :]))
            out[i] = s = new
        return out

    def logits(self, x: np.ndarray, index: np.ndarray, keep: dict | None = None) -> np.ndarray:
        at = index.T
        kept = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        gates = {k: x @ self.p[f"W{k}"] + self.p[f"b{k}"] for k in "fb"} if keep is None or "gates" not in keep else keep["gates"]
        f = self._gru("f", gates["f"][at], kept["f"])
        b = self._gru("b", gates["b"][at[::-1]], kept["b"])[::-1]
        s = np.concatenate([f, b], axis=2)
        e = np.where(at >= 0, s @ self.p["a"], -30.0).astype(np.float32)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        c = (e[:, :, None] * s).sum(axis=0)
        if keep is not None:
            keep |= {"s": s, "e": e, "c": c, "kept": kept, "at": at}
        return c @ self.p["w"] + self.p["c"][0]

    def scores(self, texts: list[str | None], step: int = 1024, most: int = PIECE) -> np.ndarray:
        """The largest window probability of each whole text; ``most`` bytes or a window are in work at once."""
        top = np.full(len(texts), -np.inf, np.float32)
        for which, raw in _pieces(texts, most):
            t = Words(raw)
            x = self.inputs(t)
            gates = {k: x @ self.p[f"W{k}"] + self.p[f"b{k}"] for k in "fb"}
            z = np.empty(len(t), np.float32)
            for i in range(0, len(t), step):
                z[i : i + step] = self._windows(gates, t.index[i : i + step])
            np.maximum.at(top, which, np.maximum.reduceat(z, t.first_window[:-1]))
        return 1 / (1 + np.exp(-top.astype(np.float64)))

    def _windows(self, gates: dict, index: np.ndarray) -> np.ndarray:
        at = index.T
        f, b = self._gru("f", gates["f"][at], None), self._gru("b", gates["b"][at[::-1]], None)[::-1]
        s = np.concatenate([f, b], axis=2)
        e = np.where(at >= 0, s @ self.p["a"], np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        return ((e / e.sum(axis=0))[:, :, None] * s).sum(axis=0) @ self.p["w"] + self.p["c"][0]

    def gradients(self, t: Words, x: np.ndarray, index: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the logistic loss of these windows with labels y, by back-propagation through time."""
        keep: dict = {}
        z = self.logits(x, index, keep)
        h, n = self.h, len(y)
        dz = (1 / (1 + np.exp(-z)) - y).astype(np.float32) / n
        g = {"w": keep["c"].T @ dz, "c": dz.sum(keepdims=True)}
        dc = dz[:, None] * self.p["w"]
        s, e = keep["s"], keep["e"]
        de = (s * dc).sum(axis=2)
        de = e * (de - (e * de).sum(axis=0))
        de[keep["at"] < 0] = 0
        g["a"] = (de[:, :, None] * s).sum(axis=(0, 1))
        ds = e[:, :, None] * dc + de[:, :, None] * self.p["a"]
        dx = np.zeros_like(x)
        for k, part in (("f", ds[:, :, :h]), ("b", ds[::-1, :, h:])):
            at = keep["at"] if k == "f" else keep["at"][::-1]
            u, w = self.p[f"U{k}"], self.p[f"W{k}"]
            gu, gw, gb, carry = np.zeros_like(u), np.zeros_like(w), np.zeros(3 * h, np.float32), np.zeros((n, h), np.float32)
            for i in range(len(at) - 1, -1, -1):
                s0, zt, r, nt, vn = keep["kept"][k][i]
                d = part[i] + carry
                dn = d * (1 - zt) * (1 - nt * nt)
                dzt = d * (s0 - nt) * zt * (1 - zt)
                dr = dn * vn * r * (1 - r)
                dg = np.concatenate([dzt, dr, dn], axis=1)
                dv = np.concatenate([dzt, dr, dn * r], axis=1)
                carry = d * zt + dv @ u.T
                gu += s0.T @ dv
                gw += x[at[i]].T @ dg
                gb += dg.sum(axis=0)
                np.add.at(dx, at[i], dg @ w.T)
            g |= {f"U{k}": gu, f"W{k}": gw, f"b{k}": gb}
        g["word"], g["tri"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["tri"])
        used = np.unique(index[index >= 0])
        np.add.at(g["word"], t.word[used], dx[used, : self.d])
        for i in range(int(t.size[used].max()) if len(used) else 0):
            u2 = used[t.size[used] > i]
            np.add.at(g["tri"], t.tri[t.start[u2] + i], dx[u2, self.d :] / np.sqrt(t.size[u2])[:, None])
        return g

    def fit(self, texts: list[str], y: np.ndarray, epochs: int = 5, batch: int = 64, least_steps: int = 190, rate: float = 0.01, seed: int = 5) -> ToxicityNet:
        """A text is as toxic as its worst window: each step trains the window of each text that now scores highest."""
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        for epoch in range(max(epochs, -(-least_steps * batch // max(1, len(texts))))):
            order = rng.permutation(len(texts))
            for i in range(0, len(texts), batch):
                take = order[i : i + batch]
                t = Words([texts[j] for j in take])
                x = self.inputs(t)
                gates = {k: x @ self.p[f"W{k}"] + self.p[f"b{k}"] for k in "fb"}
                z = np.concatenate([self._windows(gates, t.index[a : a + 1024]) for a in range(0, len(t), 1024)])
                if epoch == 0:  # nothing learned yet: any window may be the one
                    z = rng.random(len(z))
                pick = np.array([a + z[a:b].argmax() for a, b in zip(t.first_window[:-1], t.first_window[1:], strict=True)])
                index, goal = _amid_others(t, pick, y[take], rng)
                g = self.gradients(t, x, index, goal.astype(np.float32))
                step += 1
                for k, p in self.p.items():
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.001 * (g[k] * g[k] - v[k])
                    p -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
        return self


def _amid_others(t: Words, pick: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The picked windows and their labels; each short toxic one once more, at a random place of a clean window.

    So a few toxic words count wherever they stand in a window, not only on their own.
    """
    index = t.index[pick]
    n = (index >= 0).sum(axis=1)
    clean = np.flatnonzero(y == 0)
    short = np.flatnonzero((y == 1) & (n > 0) & (n <= LENGTH // 2)) if len(clean) else np.empty(0, np.int64)
    more = np.full((len(short), LENGTH), -1)
    for row, i in zip(more, short, strict=True):
        other = rng.choice(clean)
        around = np.resize(index[other, : n[other]], LENGTH - n[i]) if n[other] else np.empty(0, np.int64)
        at = rng.integers(0, len(around) + 1)
        row[: len(around) + n[i]] = np.concatenate([around[:at], index[i, : n[i]], around[at:]])
    return np.concatenate([index, more]), np.concatenate([y, np.ones(len(short), y.dtype)])


def train(rows: DataFrame, toxic: int = 900, clean: int = 1500, most_chars: int = 6000, seed: int = 21) -> ToxicityNet | None:
    """rows(doc_id, text, toxic) -> the network, fitted on at most so many texts of at most so many characters."""
    usable = rows.where(f"text is not null and doc_id is not null and toxic in (0, 1) and length(text) <= {most_chars}")
    sample = bounded_sample(usable.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")), "toxic", "doc_id", {1: toxic, 0: clean}, seed)
    got = sorted((r.doc_id, r.text, r.toxic) for r in sample.collect())
    if len({r[2] for r in got}) < 2:
        return None
    return ToxicityNet().fit([r[1] for r in got], np.array([r[2] for r in got]))


def score(docs: DataFrame, model: ToxicityNet | None) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, score): the largest window probability; 0 if nothing could be learned."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts = b.column("text").to_pylist()
            out = model.scores(texts).tolist() if model else [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, "doc_id long, score double")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows to learn from: one label a document, toxic if any of its labels says so, crc32(doc_id) mod 4 not 2."""
    own = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.where(~held_out(4, 2)).select("doc_id", "text").join(own, "doc_id")


def score_toxicity(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """docs(doc_id, text, ...), labels(doc_id, toxic, ...) -> (doc_id, held_out, score, predicted), one row per input row.

    The score is the network's largest probability over all overlapping windows of the whole text; the
    text is its only input. Null and empty texts are one empty window; repeated rows each come back;
    a row without doc_id is scored but never learned from; null labels are no labels; other columns are
    ignored; an empty table gives an empty result.
    """
    scored = score(docs, train(labelled(docs, labels)))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.3) -> DataFrame:
    """docs, all columns, without the rows whose text scores at the limit or above."""
    model = train(labelled(docs, labels))
    columns = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts = b.column("text").to_pylist()
            ok = (model.scores(texts) < limit).tolist() if model else [True] * len(texts)
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.select(columns).mapInArrow(keep, docs.schema)
