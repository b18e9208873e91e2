import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tallyspark.llm.common import Scratch
from tallyspark.llm.suffix_dedup import maximal_repeats, repeated_spans, suffix_array, suffix_dedup


def brute(texts, length=400):
    raw = [(x or "").encode() for x in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def cases():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(70), text(130), text(300)]
    texts = [None, "", "short", "a" * 1500, "ab" * 700, text(2000), shared[1], shared[1]]
    for i in range(40):
        s = rng.choice(shared)
        a = rng.randint(0, 60)
        texts.append(text(rng.randint(0, 90)) + s[a : len(s) - rng.randint(0, 60)] + text(rng.randint(0, 90)))
    texts.append(texts[-1])
    return texts


def test_suffix_array_and_repeats():
    texts = [b"xabcabcy", b"zabcabcw", b"abc"]
    sa, common, before, starts = suffix_array(texts)
    joined = []
    for i, x in enumerate(texts):
        joined += [*x, 257 + i]
    assert [joined[i:] for i in sa] == sorted(joined[i:] for i in range(len(joined)))
    for i in range(1, len(sa)):
        a, b = joined[sa[i - 1] :], joined[sa[i] :]
        n = next(k for k, (p, q) in enumerate(zip(a, b)) if p != q)
        assert common[i] == n
    groups = {(length, tuple(sorted(sa[lo : hi + 1]))) for length, lo, hi in maximal_repeats(sa, common, before, 3)}
    assert groups == {(6, (1, 10)), (3, (1, 4, 10, 13, 18))}


@pytest.mark.parametrize("most", [1024, 3])
def test_against_brute_force(spark, most, monkeypatch):
    import tallyspark.llm.suffix_dedup as m

    texts = cases()
    if most == 3:
        monkeypatch.setattr(m, "repeated_spans", lambda docs, length, scratch: repeated_spans(docs, length, 3, Scratch(spark, "t")))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, d int").repartition(5)
    got = {r.doc_id: tuple(r)[1:5] for r in m.suffix_dedup(docs).collect()}
    want = brute(texts)
    assert [i for i, w in enumerate(want) if got[i] != w] == []


def test_null_ids_repeats_and_empty(spark):
    long = "q" * 200 + "r" * 400
    docs = spark.createDataFrame([(None, long), (1, long), (1, long), (2, None)], "doc_id long, text string")
    got = sorted((tuple(r)[:5] for r in suffix_dedup(docs).collect()), key=str)
    gone = hashlib.sha256(b"").hexdigest()
    assert got == sorted([(None, 600, 600, 1, gone), (1, 600, 600, 1, gone), (1, 600, 600, 1, gone), (2, 0, 0, 0, gone)], key=str)
    assert {(r["n_removed"], r["repeats"]) for r in suffix_dedup(docs).collect()} == {(600, True), (0, False)}
    assert suffix_dedup(docs.limit(0)).count() == 0


def test_rows_without_id_are_told_apart_by_their_text(spark):
    """Two texts with one 32-bit hash, one of them copied: the other one repeats nowhere."""
    texts = spark.range(200_000).select(F.concat(*[F.sha2(F.concat("id", F.lit(f" {i}")), 256) for i in range(8)]).alias("text"))
    one, other = next((r["a"], r["b"]) for r in texts.groupBy(F.hash("text").alias("h")).agg(F.min("text").alias("a"), F.max("text").alias("b"), F.count("*").alias("n")).where("n > 1").limit(1).collect())
    docs = spark.createDataFrame([(None, one), (None, other), (5, one)], "doc_id long, text string")
    assert sorted((r["kept_sha256"], r["n_removed"]) for r in suffix_dedup(docs).collect()) == sorted([(hashlib.sha256(b"").hexdigest(), 512)] * 2 + [(hashlib.sha256(other.encode()).hexdigest(), 0)])


def test_phrase_repeated_within_a_text(spark):
    """Contexts of one anchor overlap in the same text; its bytes are no repeat of themselves."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, passage = text(180), text(450)
    texts = [text(300) + phrase + text(rng.randint(5, 70)) + phrase + text(300) for _ in range(40)]
    texts += [text(50) + phrase + passage + phrase + text(40) for _ in range(5)] + [phrase + text(100) + phrase + text(7) + phrase + passage[:230]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup(docs).collect()}
    want = brute(texts)
    assert [i for i, w in enumerate(want) if got[i] != w] == [] and sum(w[1] for w in want) > 0


def common_passage(spark, n):
    """n texts with one passage each, between bytes that differ."""
    rng = random.Random(6)
    text = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    passage = text(460)
    return spark.createDataFrame([(i, text(300) + passage + text(300)) for i in range(n)], "doc_id long, text string")


class Kept(Scratch):
    def __init__(self, spark, label):
        super().__init__(spark, label)
        self.plans, self.blocks = [], 0

    def save(self, df):
        self.plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = super().save(df)
        if df.columns == ["d", "t", "pos", "a", "k", "core", "h", "x", "y"]:
            self.blocks += out.count()
        return out


def test_no_join_by_anchor_shares_its_stage_with_a_grouping_by_it(spark):
    """Else Spark can't split the rows of a frequent anchor over tasks."""
    kept = Kept(spark, "t")
    repeated_spans(common_passage(spark, 12), 400, 3, kept)
    joins = 0
    for plan in kept.plans:
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if re.search(r"Join \w+, .*\ba#\d+L? = a#", line):
                joins += 1
                keys, depth = set(re.findall(r"(\w+)#\d+L? = \1#", line)), re.search(r"[A-Z]", line).start()
                below = itertools.takewhile(lambda x: re.search(r"[A-Z]", x).start() > depth, filter(None, lines[i + 1 :]))
                grouped = [re.search(r"Aggregate \[(.*?)\]", x) for x in below]
                assert not [g for g in grouped if g and set(re.findall(r"(\w+)#", g[1])) <= keys], plan
    assert joins >= 8


def test_blocks_of_a_hot_anchor_grow_with_its_contexts(spark):
    made = []
    for n in (40, 160):
        kept = Kept(spark, "t")
        spans = repeated_spans(common_passage(spark, n), 400, 3, kept)
        assert spans.count() == n
        made.append(kept.blocks)
    assert made[0] and made[1] < 6 * made[0]
