"""Findings of round 3 on the memory of Python workers."""

import tracemalloc

import numpy as np
import pyarrow as pa
from tallyspark.llm.common import parts
from tallyspark.llm.toxicity import LENGTH, STRIDE, ToxicityNet, _cut


def test_batches_go_in_slices_of_few_bytes():
    texts = ["a" * n for n in (3, 0, 5)] + [None, "é" * 40, "", "b", "c"]
    b = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts), pa.array([[i] * i for i in range(8)])], names=["id", "text", "want"])
    got = list(parts([b, b.slice(0, 0), b.slice(4)], most=8))
    assert [p.column("id").to_pylist() for p in got] == [[0, 1, 2, 3], [4, 5], [6, 7], [4, 5], [6, 7]] or [x for p in got for x in p.column("id").to_pylist()] == [*range(8), 4, 5, 6, 7]
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 8 or p.column("text").to_pylist()[0] == "é" * 40 for p in got)
    assert [np.diff(p.column("want").offsets.to_numpy()).tolist() for p in got][0] == [0, 1, 2, 3][: got[0].num_rows]
    row = pa.StructArray.from_arrays([pa.array(range(8)), pa.array(texts)], names=["id", "text"])
    whole = pa.RecordBatch.from_arrays([row], names=["row"])
    assert [x["id"] for p in parts([whole], "row", 8, 1) for x in p.column("row").to_pylist()] == list(range(8))


def test_toxicity_scores_hold_few_bytes_of_text_at_once():
    rng = np.random.default_rng(1)
    net = ToxicityNet()
    texts = [" ".join(map(str, rng.integers(0, 99999, 400))) for _ in range(500)]
    tracemalloc.start()
    try:
        net.scores(texts)
        many = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        net.scores([" \n".join(texts)])
        one = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert many < 60 << 20 and one < 60 << 20


def test_pieces_of_a_text_have_its_windows():
    rng = np.random.default_rng(2)
    net = ToxicityNet()
    texts = [None, "", " \n ", "x" * 900] + ["é ".join(map(str, rng.integers(0, 999, n))) + "\t" * (n % 3) for n in (1, 23, 24, 25, 40, 41, 56, 57, 200, 333, 1000)]
    whole = net.scores(texts, most=1 << 30)
    for most in (1, 150, 700, 2000):
        assert np.allclose(net.scores(texts, most=most), whole, atol=1e-6)
        for text in texts[4:]:
            words, parts_of = text.encode().split(), [p.split() for p in _cut(text.encode(), most)]
            windows = lambda w: {tuple(w[a : a + LENGTH]) for a in [*range(0, max(1, len(w) - LENGTH), STRIDE), max(0, len(w) - LENGTH)]}
            assert set().union(*map(windows, parts_of)) == windows(words)
