"""Queries against SQL, defined results at the edges, and the pipeline against plain versions of its stages."""

import random
import re

import compare
import numpy as np
import pytest
from brute import classes, repeats, shingles, without
from pyspark.sql import functions as F
from tallyspark.llm.bit_sliced import search_block, slices_of, top_k
from tallyspark.llm.decontaminate import clean_documents, contained_items
from tallyspark.llm.host_reputation import judge_urls
from tallyspark.llm.mixing import mix, source_targets
from tallyspark.llm.queries import ORACLES, QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare.differences(spark, QUERIES[name], ORACLES[name], SF) == ""


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/7x?q#f", "x://example.com/en/8", "https://notexample.com/en/", "https://m.example.net/de/81", "https://m.example.net/de/7",
            "http://q.org?/es/", "http://q.org/es/1", "a://b://c/d", "http://co.uk/en/", "http://10.0.0.1/en"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://a.com/en/", "h"), (3, urls[3], "h")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(12, 1), (12, None), (None, 1)] + [(i, 0) for i in range(12)], "page_id long, bad int")
    got = {}
    for r in judge_urls(pages, labels, URL_RULES).collect():
        got.setdefault(r["page_id"], []).append((r["host"], r["path"], r["rule"], r["verdict"]))
    assert len(got[3]) == 2 and got[3][0] == ("a.example.com", "/en/7x", "example.com/en/7", "allow") and got[None][0][2:] == ("com/en/", "block")
    assert got[0][0] == got[1][0] == got[2][0] == ("", "", None, "allow")
    assert got[4][0][2:] == ("com/en/", "block") and got[5][0][2:] == ("com/en/", "block") and got[6][0][2:] == ("example.net/de/8", "block") and got[7][0][2:] == ("net/de/", "allow")
    assert got[8][0][:3] == ("q.org", "", None) and got[9][0][2:] == ("org/es/", "block") and got[10][0][:2] == ("b:", "//c/d")
    assert judge_urls(pages.limit(0), labels).count() == 0


def test_bad_hosts_are_blocked(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 8).cast("string"), F.lit(".site"), (F.col("id") % 2).cast("string"), F.lit(".com/")).alias("url"))
    labels = pages.select("page_id", (F.col("page_id") % 8 == 3).cast("int").alias("bad"))
    assert {r[0] for r in judge_urls(pages, labels).where("verdict = 'block'").select("host").distinct().collect()} == {"h3.site1.com"}


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "a", "b", "é", ""]), " ".join(["w"] * rng.randint(0, 30))) for i in range(300)] + [(None, "a", "x y"), (5, "a", None), (7, "b", "r r"), (7, "b", "r r")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("x"))
    got = mix(docs).collect()
    assert len(got) == 304 and sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(7)).collect()))
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert len(by) == 5 and all(abs(sum(v) - t) <= 1 for (_, t), v in by.items())
    assert abs(sum(t for _, t in by) - 1.5 * sum(s for s, _ in by)) < 1e-6
    assert mix(docs.limit(0)).count() == 0


def test_water_level_is_the_loop_fixed_point(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {f"0s{i:02d}": rng.choice([0, 1, 5, 40, 900, 10_000]) for i in range(9)}
        w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes))}
        total, capped, target = 1.5 * sum(sizes.values()), set(), {}
        while True:
            free = [k for k in sizes if k not in capped]
            rest = total - sum(2 * sizes[k] for k in capped)
            target = {k: rest * w[k] / sum(w[f] for f in free) for k in free} | {k: 2.0 * sizes[k] for k in capped}
            over = {k for k in free if target[k] > 2 * sizes[k]}
            if not over:
                break
            capped |= over
        got = {r["skey"]: r["target"] for r in source_targets(spark.createDataFrame(list(sizes.items()), "skey string, source_size long")).collect()}
        assert all(abs(got[k] - target[k]) < 1e-6 for k in sizes)


def test_contained(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = spark.createDataFrame([(1, item), (2, "tiny phrase"), (3, None), (4, "..."), (None, item), (1, item)], "item_id long, text string")
    near = item.replace("beta", "BETA,").replace("omicron", "other")
    docs = spark.createDataFrame([(1, "x " * 9000 + near + " y"), (2, item.replace("theta", "q")), (3, "a tiny  phrase"), (4, None), (5, ""), (None, item), (6, "clean text of no item at all"), (1, "again")], "doc_id long, text string").withColumn("item_id", F.lit("c"))
    got = {(r["doc_id"], r["item_id"]): (r["shared"], r["item_shingles"]) for r in contained_items(docs, items).collect()}
    assert got == {(1, 1): (10, 11), (3, 2): (1, 1)}
    assert sorted(r["doc_id"] or 0 for r in clean_documents(docs, items).collect()) == [0, 2, 4, 5, 6]
    assert contained_items(docs, items.limit(0)).count() == 0 and contained_items(docs.limit(0), items).count() == 0
    shuffled = contained_items(docs, items, broadcast_rows=0).collect()
    assert {(r["doc_id"], r["item_id"]) for r in shuffled} == set(got)


def test_items_of_every_width_in_one_scan(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "six one"), (3, "two three"), (4, "none of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "six"), (2, "two three"), (3, "two three four"), (4, "two three four five"), (5, "one two three four five six")], "item_id long, text string")
    found = contained_items(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (3, 2)}
    assert {(r["doc_id"], r["item_id"]) for r in contained_items(docs, items, broadcast_rows=0).collect()} == {(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (3, 2)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_bit_slices():
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (130, 7))
    v[5:60] = v[4]
    q = np.concatenate([rng.integers(-200, 200, (20, 7)), np.zeros((1, 7), np.int64)])
    s, low = slices_of(v)
    ids, qids = np.arange(130) * 3, np.arange(21) * 3
    got = {}
    for a, i, x in search_block(ids, s, low, qids, q, 5):
        got.setdefault(a, []).append((-x, i))
    for a, row in zip(qids.tolist(), q):
        want = sorted((-int(row @ x), int(i)) for i, x in zip(ids, v) if i != a)[:5]
        assert sorted(got[a]) == want


def test_top_k_edges(spark):
    rows = [(0, [0.1, -0.2]), (50, None), (100, [float("nan"), 1.0]), (1, [1.0, None]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.5, 0.5]), (None, [1.0, 1.0]), (150, [1.0])]
    v = spark.createDataFrame([(i, e, 1) for i, e in rows], "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in top_k(v).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 25 * 128 - 52 * 128), (0, 2, 3, 25 * 128 - 52 * 128)]
    assert top_k(v.limit(0)).count() == 0


def test_pipeline_against_plain_stages(spark, monkeypatch):
    """One run; what each stage makes of what the one before it left is compared with a plain version."""
    import corpus_pipeline as p

    kept = []

    class Kept(p.Scratch):
        def save(self, df):
            out = super().save(df)
            if "/pipeline-" in self.root:
                kept.append(out)
            return out

    monkeypatch.setattr(p, "Scratch", Kept)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    p.run(spark, SF)
    assert len(kept) == 5 and all(x.columns == docs.columns for x in kept[:4])
    every, mild, near, cut, clean, mixed = ({r["doc_id"]: r for r in x.collect()} for x in (docs, *kept))
    texts = lambda rows: {i: r["text"] for i, r in rows.items()}
    assert len(mild) > 150 and texts(mild) == {i: every[i]["text"] for i in mild}
    found = classes({i: shingles(t, 5) for i, t in texts(mild).items()})
    assert texts(near) == {i: t for i, t in texts(mild).items() if found[i] == i}
    again = repeats(sorted(texts(near).items()))
    assert texts(cut) == {i: without(t, [(q[1], v[0]) for q, v in again.items() if q[0] == i and not v[4]]) for i, t in texts(near).items()}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    runs = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    asked = [runs(w, min(5, len(w))) for w in (words(r["text"]) for r in items.collect()) if w]
    widths = {len(x) for a in asked for x in a}
    held = {i: set().union(*(runs(words(t), n) for n in widths)) for i, t in texts(cut).items()}
    assert texts(clean) == {i: t for i, t in texts(cut).items() if not any(len(a & held[i]) >= 0.8 * len(a) - 1e-9 for a in asked)}
    taken = {r["doc_id"]: r["taken"] for r in mix(kept[3]).collect()}
    assert {i: (r["text"], r["source"], r["taken"]) for i, r in mixed.items()} == {i: (r["text"], r["source"], taken[i]) for i, r in clean.items()}


def test_stages_of_two_pipelines_do_not_meet(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    near, cut, clean = (stage(spark, docs, SF) for stage in (p.near_dedup, p.substring_dedup, p.decontamination))
    both = p.mixing(spark, near, SF), p.mixing(spark, near, SF)
    assert 0 < near.count() < docs.count() == cut.count() > clean.count() > 0
    assert both[0].count() == both[1].count() == near.count()


def test_pipeline_with_rows_without_id_and_clashing_columns(spark):
    """Rows without an id are judged as those that have one; extra columns have the names of the stages' own."""
    import corpus_pipeline as p

    rng = random.Random(8)
    words = lambda n: " ".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + str(rng.randrange(90)) for _ in range(n))
    base, passage = words(120), words(60)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first()["text"]
    rows = [(None, base, 1), (None, base, 2), (7, base + " more", 3), (None, words(40) + " " + passage + " " + words(40), 4), (3, words(40) + " " + passage + " " + words(40), 5),
            (None, words(50) + " " + item, 6), (None, words(70), 7), (None, None, 8), (9, "twice", 9), (9, "twice", 10), (8, words(30), 11)]
    names = ["size", "Target", "taken", "mix_size", "row", "t", "key", "start", "gone", "n_words", "component_id", "shared", "h", "skey"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for c in names:
        docs = docs.withColumn(c, F.col("n"))
    docs = docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text"))
    columns = docs.columns
    for name, stage in p.STAGES[1:]:
        docs = stage(spark, docs, SF)
        assert docs.columns[: len(columns)] == columns, name
    got = {r["n"]: r for r in docs.collect()}
    assert docs.columns[len(columns) :] == ["mix_mix_size", "source_size", "mix_target", "mix_taken"]
    assert set(got) - {9, 10} == {3, 4, 5, 7, 8, 11} and len(set(got) & {9, 10}) == 1
    assert passage in got[5]["text"] and passage not in got[4]["text"] and got[4]["n_chars"] == len(got[4]["text"]) and got[4]["doc_id"] is None
    assert all(r["size"] == r["row"] == r["skey"] == n for n, r in got.items()) and got[3]["mix_mix_size"] == 121


def test_empty_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
