import random

import numpy as np
import pytest
from brute import classes, repeats, shingles, without
from tallyspark.llm.common import Scratch, shingle_set, word_hashes
from tallyspark.llm.components import components
from tallyspark.llm.minhash_dedup import near_duplicates
from tallyspark.llm.neardup import OddSketcher, meeting
from tallyspark.llm.paragraph_dedup import Paragraphs, repeated_paragraphs, without_repeats

SF = "/root/testdata/sf0.001/documents.parquet"


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice([[], ["z%d" % rng.randrange(30)], [out[i], out[i]]])
    return out


def corpus():
    rng = random.Random(8)
    new = lambda n: ["w%d" % rng.randrange(4000) for _ in range(n)]
    texts = [None, "", "  \t", "one two", "ONE two", "one two three four", "x" * 90_000]
    for size in (150, 150, 400):
        base = new(size)
        texts += [" ".join(edited(rng, base, rng.choice([0.005, 0.02, 0.04, 0.06, 0.1]))) for _ in range(60)]
        texts += [" ".join(base)] * 12
    texts += [" ".join(new(rng.randint(1, 80))) for _ in range(60)]
    return texts


@pytest.mark.parametrize("k", [4, 5])
def test_against_all_pairs(spark, k):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, i, "e") for i, t in enumerate(texts)], "doc_id long, text string, n long, component_id string").repartition(4)
    got = {r["doc_id"]: r for r in near_duplicates(docs, k).collect()}
    sets = {i: shingles(t, k) for i, t in enumerate(texts)}
    want = classes(sets)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_given_documents(spark):
    docs = spark.read.parquet(SF)
    sets = {r["doc_id"]: shingles(r["text"], 4) for r in docs.collect()}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 4).collect()} == classes(sets)


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (5, "a b c d e"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None, True), (None, None, True), (3, 3, True), (3, 3, True), (5, 3, False)], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [1, 6])
def test_sets_of_one_short_hash_stay_apart(spark, bits):
    """Ids cut to a few bits are mixed; the other hash tells their sets apart, and no result changes."""
    docs = spark.read.parquet(SF)
    sets = {r["doc_id"]: shingles(r["text"], 4) for r in docs.collect()}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 4, bits=bits).collect()} == classes(sets)
    rows, _ = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(repeated_paragraphs(docs, bits=bits)) == repeats(rows)


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:850], rng.integers(0, 2**63, 40, dtype=np.uint64)]))
    x, y = OddSketcher().sketches([a, b])
    flips, real = int(np.bitwise_count((x ^ y).view(np.uint64)).sum()), len(np.setxor1d(a, b))
    assert real - 20 <= flips <= real


def test_long_texts_cut_short_are_linked(spark):
    rng, texts = random.Random(4), []
    for size in (1_100, 1_400, 2_000, 4_000, 10_000):
        for ratio in (0.80, 0.82, 0.85):
            base = ["w%d" % rng.randrange(10**6) for _ in range(size)]
            texts += [" ".join(base), " ".join(base[: int(size * ratio) + 2])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = classes({i: shingles(t, 5) for i, t in enumerate(texts)})
    assert want == {i: i - i % 2 for i in range(len(texts))}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()} == want


def test_long_texts_that_overlap_are_linked(spark):
    rng, texts = random.Random(5), []
    for size in (1_025, 1_600, 4_003, 20_000):
        for similarity in (0.801, 0.81, 0.83):
            part = round(size * 2 * similarity / (1 + similarity)) + 1
            base = ["w%d" % rng.randrange(10**7) for _ in range(2 * size - part)]
            texts += [" ".join(base[:size]), " ".join(base[-size:])]
    texts += [" ".join(w := ["w%d" % rng.randrange(10**7) for _ in range(4_003)]), " ".join(w[:3_243])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = classes({i: shingles(t, 4) for i, t in enumerate(texts)})
    assert want == {i: i - i % 2 for i in range(len(texts))}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 4).collect()} == want


def test_two_texts_of_one_document(spark):
    rng = random.Random(5)
    a, b, c = (" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(3))
    docs = spark.createDataFrame([(5, a), (5, b), (3, a + " x"), (8, "y " + b), (9, c)], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in near_duplicates(docs).collect()} == {(5, 3), (3, 3), (8, 3), (9, 9)}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20, 60)] + [(3, 9), (9, 3), (9, 1), (7, 7), (None, 2)], "a long, b long")
    got = {r["id"]: r["root"] for r in components(links, Scratch(spark, "t")).collect()}
    assert got == {i: 20 for i in range(21, 61)} | {3: 1, 9: 1}


def as_rows(df):
    return {(r["doc_id"], r["start"]): (r["n_words"], r["run_words"], r["copies"], (r["first_doc_id"], r["first_start"]), r["kept"]) for r in df.collect()}


def wrap(words, n):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def passages(seed=6):
    """Texts that share passages inside and across lines, verbatim, in other case or slightly changed, and their places."""
    rng = random.Random(seed)
    new = lambda n: ["w%d" % rng.randrange(10**6) for _ in range(n)]
    rows, at = [], {}
    for p in range(12):
        passage = new(rng.randint(51, 120))
        for k in range(3):
            copy = edited(rng, passage, 0.01) if k == 2 and p % 2 else passage
            before, after = new(rng.randint(0, 300)), new(rng.randint(100, 300))
            at[len(rows)] = (len(before), len(passage))
            rows.append((len(rows), wrap([x.upper() if k == 1 else x for x in before + copy + after], (1000, 9, 38)[k])))
    for p in range(3):  # paragraphs that differ at their ends only
        base = new(300)
        rows += [(len(rows) + i, " ".join(edited(rng, base, 0.05))) for i in range(4)]
    rows += [(len(rows) + i, wrap(new(200), n)) for i, n in enumerate((1000, 9, 38))]
    rows += [(len(rows), " ".join(["ha"] * 400)), (len(rows) + 1, "é " * 90), (len(rows) + 2, "one two"), (len(rows) + 3, "ONE\ttwo")]
    rows += [(None, rows[0][1]), (900, None), (901, ""), (902, " \n"), (903, " ".join(new(10) * 30))]
    return rows, at


def test_passages_against_all_pairs(spark):
    rows, at = passages()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, start int, kept string").repartition(5)
    want = repeats(rows)
    assert as_rows(repeated_paragraphs(docs)) == want
    hit = {d for d, _ in want}
    assert set(at) <= hit and not hit & {d for d, _ in rows[48:51]}
    got = {r["doc_id"]: r["text"] for r in without_repeats(docs).collect()}
    for d, t in rows:
        assert got[d] == (t if t is None or d is None else without(t, [(p[1], v[0]) for p, v in want.items() if p[0] == d and not v[4]]))


def test_every_run_of_over_50_words_is_caught(spark):
    rng = random.Random(1)
    new = lambda n: ["w%d" % rng.randrange(10**6) for _ in range(n)]
    rows = []
    for _ in range(200):
        run = new(51)
        rows += [(len(rows) + i, " ".join(new(rng.randint(20, 200)) + run + new(rng.randint(20, 200)))) for i in range(2)]
    found = {r[0] for r in repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()}
    assert len(found) >= 0.95 * len(rows)


def test_passages_of_given_documents(spark):
    docs = spark.read.parquet(SF)
    assert as_rows(repeated_paragraphs(docs)) == repeats([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_passages_at_the_edges(spark):
    rng = random.Random(2)
    a, b = (" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(2))
    docs = spark.createDataFrame([(1, a, 5), (1, a, 5), (1, b, 5), (2, b, None), (None, a, 1)], "doc_id long, text string, n_chars long")
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in without_repeats(docs.where("doc_id is not null")).collect())
    assert got == sorted([(1, a, 5), (1, a, 5), (1, b, 5), (2, "", 0)])
    assert {r["copies"] for r in repeated_paragraphs(docs).collect()} == {2} and without_repeats(docs).count() == 5
    assert repeated_paragraphs(docs.limit(0)).count() == 0 and without_repeats(docs.limit(0)).count() == 0


def test_linked_sets_share_a_band():
    rng = np.random.default_rng(4)
    for n in [*range(3, 60), 100, 400]:
        for share in (1, 0.95, 0.9, 0.85):
            word = lambda n: ["v%d" % x for x in rng.integers(0, 10**9, n)]
            run = word(int(n * share) + 4)
            p = Paragraphs([" ".join(run + word(n - int(n * share))), " ".join(run)], 5, reach=10**6)
            sets = [set(p.items[p.unit == i].tolist()) for i in (0, 1)]
            unit, h = p.keys(np.arange(2), 80)
            if 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1]):
                assert set(h[unit == 0].tolist()) & set(h[unit == 1].tolist())


def test_linked_sets_in_one_bin_share_a_key():
    rng = np.random.default_rng(7)
    p = Paragraphs([], 5)
    for n in (4, 5, 9, 10, 15, 40):
        for top in (0, 5, 15):
            big = np.sort(rng.choice(2**40, n, replace=False).astype(np.uint64) + np.uint64(top << 60))
            for small in (big[n // 5 :], big[: n - n // 5]):
                p.items, p.unit = np.concatenate([big, small]), np.repeat([0, 1], [n, len(small)])
                p.at = np.array([0, n, n + len(small)])
                unit, h = p.keys(np.arange(2), 80)
                assert set(h[unit == 0].tolist()) & set(h[unit == 1].tolist())
    for _ in range(3000):  # sets of a few members at the threshold
        n = int(rng.integers(4, 16))
        big = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        small = np.sort(rng.permutation(big)[: n - n // 5])
        p.items, p.unit = np.concatenate([big, small]), np.repeat([0, 1], [n, len(small)])
        p.at = np.array([0, n, n + len(small)])
        unit, h = p.keys(np.arange(2), 80)
        assert set(h[unit == 0].tolist()) & set(h[unit == 1].tolist())


def test_hot_keys_go_another_way_to_the_same_result(spark):
    rng = random.Random(9)
    flat = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 3, *range(4, 400)]), rng.randrange(50)) for _ in range(2000)] + [(1000, 7)] * 300, "h long, id long")
    one, other = ({tuple(r) for r in meeting(flat, sample, Scratch(spark, "t"), 20).collect()} for sample in (flat, flat.limit(0)))
    seen = {}
    for h, i in {tuple(r) for r in flat.collect()}:
        seen.setdefault(h, set()).add(i)
    assert one == other == {(h, i) for h, ids in seen.items() if len(ids) > 1 for i in ids}


def test_hashes_follow_words():
    assert (word_hashes("A\tb\x0bC  é") == word_hashes(" a b c é\n")).all() and len(word_hashes("a\u00a0b\u2028c")) == 1
    assert len(shingle_set(word_hashes("a b a b a b"), 2)) == 2 and len(shingle_set(word_hashes("a b"), 5)) == 1
