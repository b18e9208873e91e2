"""Whitening, token counts and turn repair against plain versions of themselves."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tallyspark.llm import queries, token_counts, turn_repair, whitening

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# whitening


def plain_whitening(ids, vectors, top=8):
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    z = np.array([[(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    e, basis = np.linalg.eigh(z.T @ z / n)
    e, basis = e[::-1], basis[:, ::-1]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, z @ basis[:, :top] / np.sqrt(e[:top]), e[:top] / e.sum()


def test_whitening_of_the_whole_table(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    n, deviation, white, explained = plain_whitening(t["vec_id"], t["embedding"])
    got = {(r.vec_id, r.component): r for r in queries.op11_whitening(spark, SF).collect()}
    assert len(got) == 8 * n == 8 * len(t["vec_id"])
    mine = np.array([[got[i, k].whitened for k in range(1, 9)] for i in t["vec_id"]])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-8
    assert [got[i, 3].deviation for i in t["vec_id"]] == deviation
    assert all(got[i, 2].n == n for i in t["vec_id"])
    assert np.abs([got[t["vec_id"][0], k].explained / explained[k - 1] - 1 for k in range(1, 9)]).max() < 1e-9
    assert max(r.identity_error for r in got.values()) < 1e-9


def test_whitening_in_many_blocks_and_levels(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=5) @ np.diag([9, 5, 3, 2, 1])).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(20)
    n, deviation, white, explained = plain_whitening(*zip(*rows, strict=True))
    got = {(r.vec_id, r.component): r for r in whitening.whiten(df, fan=2, rows=7).collect()}
    mine = np.array([[got[i, k].whitened for k in range(1, 6)] for i in range(300)])
    assert np.abs(mine * np.sign((mine * white).sum(axis=0)) - white).max() < 1e-9
    assert [got[i, 1].deviation for i in range(300)] == deviation
    assert np.abs([got[0, k].explained - explained[k - 1] for k in range(1, 6)]).max() < 1e-12


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<double>, x string, v string, n int"
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0]), (2, None), (3, [1.0, None]), (4, [inf, 1.0]), (5, [nan, 0.0]), (6, []), (7, [1.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, "a", "b", 1) for r in rows], schema)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    assert {(r.component, round(r.explained, 12)) for r in got} == {(1, 1.0), (2, 0.0)}
    assert max(r.identity_error for r in got) < 1e-9
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    huge = whitening.whiten(spark.createDataFrame([(1, [4e15]), (2, [-4e15])], "vec_id long, embedding array<double>")).collect()
    assert all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-9 for r in huge)


@pytest.mark.parametrize("d", [1, 2, 7, 20])
def test_jacobi_equals_the_plain_decomposition(d):
    a = np.random.default_rng(d).normal(size=(d + 3, d)) * 10.0 ** -np.arange(d)[::-1].clip(max=12)
    values, basis = whitening.jacobi(np.linalg.qr(a, mode="r"))
    assert np.allclose(values, np.linalg.svd(a, compute_uv=False), rtol=1e-12)
    assert np.abs(basis.T @ basis - np.eye(d)).max() < 1e-13
    product = a @ basis
    gram = product.T @ product
    assert np.abs(gram / np.outer(values, values) - np.eye(d)).max() < 1e-10


# token counts


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_token_counts_of_the_whole_table(spark, model):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = {r.doc_id: r for r in queries.op12_token_counts(spark, SF).collect()}
    for i, text in zip(t["doc_id"], t["text"], strict=True):
        n = len(model.encode(text or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 4096)
        kept = got[i].kept_chars
        assert kept == len(text or "") if n <= 4096 else len(model.encode(text[:kept])) <= 4096 < len(model.encode(text[: kept + 1]))


def test_every_prefix_counts_as_the_library_says(model):
    rng, of = random.Random(3), token_counts.PrefixCounter(MODEL, held=50)
    texts = pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()
    alphabet = ["a", "e", "t", "th", "in", " ", " ", "  ", "\n", "\t", "1", "23", ".", "\"", "é", "ß", "中", "文", "😀", "▁", "\x00", "ａ", "́", "﷽", "<s>", "</s>", "<0x0A>", "http://", "==", "--", "aa", "zz"]
    samples = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(400)]
    samples += [t[a : a + 60] for t in rng.sample([t for t in texts if t], 60) for a in [rng.randrange(len(t))]]
    samples += [" " * k + "the x" + " " * k for k in (1, 2, 14, 15, 16, 17, 31, 48, 63)] + ["a" * 70, "=" * 70, "the" * 20]
    for s in samples:
        steps = of.steps([s])[0]
        assert [token_counts.count_at(steps, i) for i in range(len(s) + 1)] == [len(model.encode(s[:i])) for i in range(len(s) + 1)], repr(s)
        for budget in (0, 1, 5):
            assert token_counts.longest_within(steps, budget) == max(i for i in range(len(s) + 1) if len(model.encode(s[:i])) <= budget)


def test_pieces_stay_apart_as_merging_says(model):
    of, rng = token_counts.PrefixCounter(MODEL), random.Random(4)
    pieces = list(of.halves)
    pairs = [rng.choices(pieces, k=2) for _ in range(20_000)]
    for t in rng.sample(pieces, 3000):  # neighbours that do merge, and such as nearly do
        pairs += [(t[:k], t[k:]) for k in range(1, len(t)) if t[:k] in of.halves and t[k:] in of.halves]
    assert all(of._stay_apart(a, b) == (of._merged(a + b)[0] == [a, b]) for a, b in pairs)


def test_token_count_edges(spark):
    schema = "doc_id long, text string, steps int, n_tokens string"
    df = spark.createDataFrame([(1, None, 1, "a"), (1, "", 1, "a"), (None, "the cat", 1, "a"), (2, "the " * 100_000, 1, "a"), (2, "x" * 200_000, 1, "a")], schema)
    out = token_counts.within_budget(token_counts.prefix_table(df, MODEL), 3).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens if r.n_bytes < 10 else 0, r.over_limit) for r in out) == [(0, 7, 2, False), (1, 0, 0, False), (1, 0, 0, False), (2, 200_000, 0, True), (2, 400_000, 0, True)]
    assert sorted(r.kept_chars for r in out if r.n_bytes == 400_000) == [11]
    assert token_counts.within_budget(token_counts.prefix_table(spark.createDataFrame([], schema), MODEL), 3).count() == 0


# turn repair

WHITE = " \t\n\x0b\x0c\r"
TO = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows):
    """By a search over (row, last initial) that carries cost and audit; rows: (role, text) in order."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], {}
    best = None
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if done.get((i, last, audit), 1 << 60) <= cost or len(audit) > 2 * len(rows) + 2:
            continue
        done[i, last, audit] = cost
        if i == len(rows) and last in ("", "a"):
            if best is None or (cost, audit) < best[:2]:
                best = cost, audit, out
        for new, name in (("u", "user"), ("a", "assistant")):
            if TO.get((last, new)):
                heapq.heappush(heap, (cost + 3, audit + "I", i, new, (*out, f"{name}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if faults[i] in ("", "truncated"):
                more = 3 * (faults[i] == "truncated")
                if TO.get((last, role[:1])):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                for new, name in (("u", "user"), ("a", "assistant")):
                    if TO.get((last, new)):
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, new, (*out, f"{name}:{text}")))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


def plain_damage(rows):
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if k:
            text = "" if k == 1 else text.translate(str.maketrans("", "", ".!?")) if k == 2 else text
            yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def test_turn_repair_of_the_whole_table(spark):
    t = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    by = defaultdict(list)
    for conv, turn, role, text in plain_damage([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in t]):
        by[conv].append((turn, role, text))
    want = set()
    for conv in {r["conv_id"] for r in t}:
        rows = sorted(by[conv], key=lambda r: r[0])
        turns = {r[0] for r in rows}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want.add((conv, gaps, *plain_repair([r[1:] for r in rows])))
    got = {tuple(r) for r in queries.op13_turn_repair(spark, SF).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == want and any(w[6] for w in want)


@pytest.mark.parametrize(("span", "fan"), [(1, 2), (2, 2), (3, 256), (64, 256)])
def test_turn_repair_in_pieces(spark, span, fan):
    rng = random.Random(span)
    rows = [(conv, turn, rng.choice(["user", "assistant", "assistant", "user", "system", "tool", ""]), rng.choice(["", " \n", "Yes.", "No!", f"A {turn}.", "so it", f"{turn} then"]))
            for conv in (1, 2, 3, None) for turn in range(rng.randint(3, 9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    repair = turn_repair.Repair(df, span, fan)
    digests = {r.conv_id: r for r in turn_repair.digests(repair.turns).collect()}
    totals = {r.conv_id: r for r in repair.totals.collect()}
    for conv in (1, 2, 3, None):
        t, d = totals[conv], digests[conv]
        assert (t.blank, t.duplicate, t.truncated, t.illegal, t.cost, d.audit, d.repaired_sha256) == plain_repair([r[2:] for r in rows if r[0] == conv]), conv


def test_turn_repair_edges(spark):
    schema = "conv_id long, turn long, role string, text string, p string, pos int, cost string"
    assert turn_repair.repair_damaged(spark.createDataFrame([], schema)).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, dropped, "user", "Hi."), (8, None, None, None), (None, None, "user", "x" * 300_000), (9, 5, "user", "Same."), (9, 5, "user", "Same.")]
    got = {r.conv_id: r for r in turn_repair.repair_damaged(spark.createDataFrame([(*r, "a", 1, "b") for r in rows], schema)).collect()}
    assert set(got) == {7, 8, 9, None}
    assert tuple(got[7])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    for conv, turns in ((8, [(8, " ", " ", " ")]), (9, [(9, 5, "user", "Same.")] * 2)):
        mine = tuple(got[conv])[2:]
        assert mine == plain_repair([r[2:] for r in plain_damage(turns)])
    repeated = turn_repair.Repair(spark.createDataFrame([(1, 2, "user", "Same.")] * 50, "conv_id long, turn long, role string, text string"), span=4).totals.first()
    assert (repeated.duplicate, repeated.gaps, repeated.cost) == (49, 0, 49 * 4 + 3)
