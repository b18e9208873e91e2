"""Streams with state, rank columns, catalogue tables and documents: what their SQL can't show."""

import csv
import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallyspark.operators import corpus, rank_columns, stats
from tallyspark.plans import documents
from tallyspark.plans.load import load_lists
from tallyspark.sources import markup, onefile, page_files, readers, tables
from tallyspark.streaming import breaker_stream, page_queue

AT = "port long, at timestamp, seq long, bad boolean"


def attempts(spark, rows):
    """rows of (port, second, seq, bad)"""
    return spark.createDataFrame(rows, "port long, s long, seq long, bad boolean").select("port", F.timestamp_seconds("s").alias("at"), "seq", "bad")


def test_breaker_stream_ends_quarantines_by_itself_and_goes_on_after_a_restart(spark, tmp_path):
    stream = lambda: spark.readStream.schema(AT).parquet(f"{tmp_path}/in")
    run = lambda: breaker_stream.follow(breaker_stream.standings(stream(), "port", "at", "seq", F.col("bad"), "10 seconds"), f"{tmp_path}/log", f"{tmp_path}/cp").awaitTermination()
    log = lambda: sorted(((r["port"], r["us"] // 1_000_000, r["seq"], r["failures"], r["state"]) for r in spark.read.schema(breaker_stream.LOG).parquet(f"{tmp_path}/log").collect()), key=str)
    first = [(1, 1000 + i, i, True) for i in range(5)] + [(2, 1003, 11, False), (2, 1001, 10, True), (2, 1005, 12, True), (2, 1004, 13, True)]
    attempts(spark, [*first, (None, 1020, None, None)]).write.parquet(f"{tmp_path}/in")
    run()
    port1 = [(1, 1000, 0, 1, "healthy"), (1, 1001, 1, 2, "degraded"), (1, 1002, 2, 3, "degraded"), (1, 1003, 3, 4, "degraded"), (1, 1004, 4, 5, "quarantined")]
    port2 = [(2, 1001, 10, 1, "healthy"), (2, 1003, 11, 0, "healthy"), (2, 1004, 13, 1, "healthy"), (2, 1005, 12, 2, "degraded")]
    assert log() == port1 + port2
    # Only the clock moves: the quarantine of 900 seconds ends without a further attempt, once.
    attempts(spark, [(None, 1903 + 10, None, None)]).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert log() == port1 + port2
    attempts(spark, [(None, 2500, None, None)]).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert log() == sorted([*port1, *port2, (1, 1904, None, 5, "degraded")], key=str)
    # A further failure counts on from where the port stood; one that comes too late is left out.
    attempts(spark, [(1, 2600, 20, True), (2, 1500, 21, True), (None, 2700, None, None)]).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert {tuple(r) for r in breaker_stream.latest(spark.read.schema(breaker_stream.LOG).parquet(f"{tmp_path}/log")).collect()} == {(1, 6, "quarantined"), (2, 2, "degraded")}


def test_rank_columns_keep_order_and_resolve_clashes(spark):
    seen = spark.createDataFrame([(1, "b c", 5, 3), (1, "b-c", 6, 4), (2, "B c", 7, 1), (2, "a", 8, 2), (2, "a", 9, 5), (3, " ", 1, 6), (3, None, 1, 7), (3, "?!", 2, 8), (3, "k", 3, 9), (3, "1x", 4, 10)], "k long, tag string, rank int, page int")
    hub = spark.createDataFrame([("a", 0), ("z", 1), ("a", 2), (" ", 3)], "tag string, place int")
    got = rank_columns.rank_table(seen, "k", "tag", "rank", ["page"], "lead", hub)
    assert got.columns == ["k", "lead", "a", "z", "B_c", "b_c_2", "b_c_3", "unknown", "k_", "t_1x"]
    assert {tuple(r) for r in got.collect()} == {(1, None, None, None, None, 5, 6, None, None, None), (2, None, 9, None, 7, None, None, None, None, None), (3, None, None, None, None, None, None, 2, 3, 4)}
    assert rank_columns.rank_table(seen.limit(0), "k", "tag", "rank", ["page"]).columns == ["k"]
    with pytest.raises(ValueError, match="over 3 tags"):
        rank_columns.rank_table(seen, "k", "tag", "rank", ["page"], most=3)


@pytest.fixture
def database(spark, tmp_path):
    made = []

    def make():
        name = f"test_{tmp_path.name.replace('-', '_')}_{len(made)}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{len(made)}'")
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_with_the_same_buckets_join_and_group_without_exchange(spark, database):
    db = database()
    a = tables.build(spark.range(1000).select(F.col("id").alias("mod_id"), (F.col("id") % 7).alias("x")), f"{db}.a", buckets=8)
    b = tables.build(spark.range(500, 1500).select(F.col("id").alias("mod_id"), F.lit(1).alias("y")), f"{db}.b", buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = a.join(b, "mod_id").groupBy("mod_id").agg(F.sum("x").alias("x"))
        assert both.count() == 500 and "Exchange" not in plan_of(both)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_tables_refuse_what_does_not_fit_and_stay(spark, database):
    db, rows = database(), spark.range(10).select(F.col("id").alias("mod_id"), F.lit("a").alias("v"))
    t = f"{db}.t"
    tables.build(rows, t, buckets=2)
    for bad in (rows.unionByName(rows.limit(1)), rows.unionByName(spark.createDataFrame([(None, "n")], "mod_id long, v string"))):
        with pytest.raises(ValueError, match="null or not unique"):
            tables.build(bad, t, buckets=2)
        with pytest.raises(ValueError, match="null or not unique"):
            tables.reload(bad, t, "mod_id")
    with pytest.raises(ValueError, match="has mod_id, v"):
        tables.reload(rows.drop("v"), t)
    assert spark.table(t).count() == 10
    assert tables.reload(rows.where("mod_id > 7").select("v", "mod_id"), t, "mod_id").count() == 2
    assert "2" in {r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {t}").collect() if r["col_name"] == "Num Buckets"}
    other = database()
    assert tables.copy_database(spark, db, other) == ["t"] == tables.copy_database(spark, db, other)
    assert spark.table(f"{other}.t").count() == 2 and "2" in {r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {other}.t").collect() if r["col_name"] == "Num Buckets"}
    for name, why in (("no_such_db", "no database"), (database(), "no table")):
        with pytest.raises(ValueError, match=why):
            tables.copy_database(spark, name, other)


# Documents of one file


def test_one_file_is_what_a_csv_writer_makes(spark, tmp_path):
    rows = [(3, 'say "hi"', 1.5), (1, "a,b", None), (2, "two\nlines", 2.0), (4, "", 0.0), (5, None, 1.0), (6, "  kept  ", 1.0), (7, "back\\slash", 2.0)]
    onefile.write_csv(spark.createDataFrame(rows, "id long, text string, x double").repartition(4), f"{tmp_path}/a.csv", ["id"], ["编号", "the, text", "x"])
    want = io.StringIO(newline="")
    out = csv.writer(want)
    out.writerow(["编号", "the, text", "x"])
    out.writerows([[i, t, x] for i, t, x in sorted(rows)])
    assert (tmp_path / "a.csv").read_bytes() == b"\xef\xbb\xbf" + want.getvalue().encode()
    assert [p.name for p in tmp_path.iterdir()] == ["a.csv"]


def test_an_aborted_write_leaves_what_was_there(spark, tmp_path):
    path = tmp_path / "a.txt"
    lines = spark.range(100).select("id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    onefile.write_lines(lines, str(path), ["id"], head="top\n", foot="end\n")
    whole = "top\n" + "".join(f"line {i}\n" for i in range(100)) + "end\n"
    assert path.read_text() == whole
    broken = lines.select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("line")).cast("string").alias("line"))
    for target in (path, tmp_path / "new.txt"):
        with pytest.raises(Exception, match="broken"):
            onefile.write_lines(broken, str(target), ["id"])
    assert path.read_text() == whole and [p.name for p in tmp_path.iterdir()] == ["a.txt"]
    with pytest.raises(Exception, match="FileExistsError"):
        onefile.write_lines(lines, str(path), ["id"], overwrite=False)
    onefile.write_lines(lines.limit(0), str(path), ["id"])
    assert path.read_text() == ""


def test_json_lists_of_any_length(spark, tmp_path):
    for n in (0, 1, 5):
        onefile.write_json_list(spark.range(n).select("id", F.concat(F.lit('a"\n'), F.col("id").cast("string")).alias("u")), "u", f"{tmp_path}/{n}.json", ["id"])
        assert json.loads((tmp_path / f"{n}.json").read_text()) == [f'a"\n{i}' for i in range(n)]


def test_reports_have_their_sections(spark):
    items = spark.createDataFrame([(v, "ab"[v % 2]) for v in (3, 50, 120, 800, 4000, 7000, 20_000)], "v long, g string")
    heads = lambda lines: [x for x in lines if x.startswith("#")]
    assert heads(documents.dashboard(items, "v", "T", "n")) == ["# T", "## Key figures", "## Percentiles", "## Concentration", "## Pareto", "## Thresholds", "## Buckets"]
    assert heads(documents.inequality(items, "v", "g", "T", "s")) == ["# T", "## 1. Data", "## 2. Shares of the total", "## 3. Percentile ratios", "## 4. Distribution", "## 5. Dagum's split of the Gini by group"]
    ratios = spark.createDataFrame([(0.5, 0), (1.0, 0), (2.0, 2)], "ratio double, tier int")
    lines = documents.ratio_report(ratios, "T", "s")
    assert [h for h in heads(lines) if h.startswith("## ")] == ["## 1. Data", "## 2. All items", "## 3. Tiers", *(f"## {4 + i}. Tier: {n}" for i, (n, _) in enumerate(documents.TIERS))]
    assert "| above 1 | 1 |" in lines and "| under 100 | 2 | 0.750000 | 0.750000 |" in lines and "| 100 to 1k | 0 | nan | nan |" in lines


# Page files


def test_pages_with_line_ends_and_broken_bytes_are_one_row_each(spark, tmp_path):
    (tmp_path / "00").mkdir()
    (tmp_path / "00" / "000007.html").write_bytes(b"<p>\xff\n\r\nsecond</p>\n")
    (tmp_path / "00" / "other.html").write_text("x\ny")
    (tmp_path / "00" / "000008.txt").write_text("not a page")
    got = {r["file"]: (r["row_id"], r["html"]) for r in readers.pages(spark, str(tmp_path)).collect()}
    assert got == {"000007.html": (7, "<p>�\n\r\nsecond</p>\n"), "other.html": (None, "x\ny")}


def test_page_stream_reads_each_file_once(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"<title>t{i}</title>\nrest") for i in range(6)] + [(None, "x"), (9, None), (10, "")], "page_id long, html string")
    runs = []

    def run():
        q = page_queue.follow(spark, f"{tmp_path}/html", lambda p: markup.plain_page(p, "row_id", "html").select("row_id", "title"), f"{tmp_path}/rows", f"{tmp_path}/cp", 2)
        q.awaitTermination()
        runs.append(sum(p["numInputRows"] for p in q.recentProgress))
        return {tuple(r) for r in spark.read.parquet(f"{tmp_path}/rows").collect()}

    assert page_files.write_pages(pages.where("page_id < 4 or page_id is null"), "page_id", "html", f"{tmp_path}/html") == 4
    assert run() == {(i, f"t{i}") for i in range(4)}
    assert page_files.write_pages(pages.where("page_id >= 4"), "page_id", "html", f"{tmp_path}/html") == 2
    assert run() == {(i, f"t{i}") for i in range(6)} == run()
    assert runs == [4, 2, 0]


def test_a_load_reads_the_pages_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    page = lambda tag, first, ids: (f'<script>var paramsGET = {{"requiredtags":["{tag}"]}};</script><div class="workshopBrowsePagingInfo">Showing {first}-9 of</div><div {markup.ITEMS_FROM}>'
                                    + "".join(f'<img class="fileRating" src="https://x/4-star.png"><a class="workshop_author_link" href="#">by A&amp;B</a><script>{markup.HOVER}(1, {{"id": "{i}", "title": "t{i} {{", "description": "p{first}"}})</script>' for i in ids)
                                    + f"</div><div {markup.ITEMS_TO}></div>")
    rows = [(1, page("Trade", 1, [5, 6])), (2, page("Trade", 4, [6, 7])), (3, page("", 1, [])), (4, page("New Ages", 1, [7, "x"])), (5, "nothing"), (6, page("trade", 9, [5])), (7, page("Trade", 4, [6]))]

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    pages = spark.createDataFrame(rows, "page long, html string").mapInArrow(counted, "page long, html string")
    got = load_lists(pages, "page", "html", "d?", "No_selected_tag")
    assert got.counters == {"files": 7, "skipped": 2, "rows": 7, "cells": 5, "overwrites": 1, "keys": 3, "tag_columns": 4}
    assert got.ranks.columns == ["item_id", "No_selected_tag", "Trade", "New_Ages", "trade_2"]
    assert {tuple(r) for r in got.ranks.collect()} == {("5", None, 1, None, 9), ("6", None, 4, None, None), ("7", None, 5, 1, None)}
    assert {(r["item_id"], r["title"], r["description"], r["author"]) for r in got.browse.collect()} == {("5", "t5 {", "p1", "A&B"), ("6", "t6 {", "p1", "A&B"), ("7", "t7 {", "p4", "A&B")}
    assert read.value == len(rows)


# Densities, near copies, neighbours, components


def test_binned_violins_keep_their_bound(spark):
    rng = np.random.default_rng(1)
    rows = [("n", float(x)) for x in rng.normal(5, 2, 3000)] + [("far", float(x)) for x in [*rng.lognormal(0, 2, 2000), 1e5]] + [("one", 3.0), ("flat", 1.0), ("flat", 1.0), ("none", None), (None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for tolerance in (1e-2, 1e-4):
        exact, binned = ({(r["g"], r["i"]): r for r in stats.violins(df, "v", ["g"], 50, tolerance=tolerance, exact=e).collect()} for e in (True, False))
        assert set(exact) == set(binned) == {(g, i) for g in ("n", "far", "one", "flat", None) for i in range(50)}
        for k, r in binned.items():
            if k[0] in ("one", "flat"):
                assert r["density"] is None and r["bound"] is None
                continue
            v = np.array([x for g, x in rows if g == k[0] and x is not None])
            h = v.std(ddof=1) * len(v) ** -0.2
            want = np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
            assert abs(exact[k]["density"] - want) <= 1e-9 * max(1, want) and abs(r["density"] - want) <= r["bound"] + 1e-12


def test_near_hashes_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**60, 60)
    h = np.concatenate([base] + [base ^ np.bitwise_or.reduce([1 << rng.integers(0, 60, 60) for _ in range(n)]) for n in (1, 2, 3, 4, 5)] + [base[:20]])
    rows = [(i, int(x)) for i, x in enumerate(h)] + [(900, None)]
    pairs, classes = corpus.near_hashes(spark.createDataFrame(rows, "id long, hash long"), "id")
    rep = {}
    for i, x in rows[:-1]:
        rep.setdefault(x, i)
    want = {(a, b, (x ^ y).bit_count()) for x, a in rep.items() for y, b in rep.items() if a < b and (x ^ y).bit_count() <= 3}
    got = [tuple(r) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want) > 100
    assert {tuple(r) for r in classes.collect()} == {(i, rep[x]) for i, x in rows[:-1]}


def test_cosine_index_finds_nine_of_ten(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = e.where("vec_id % 5 = 0")
    exact = {(r["query_id"], r["vec_id"]): r["cosine"] for r in corpus.exact_neighbours(e, q, "vec_id", "embedding", block=64).collect()}
    found = {(r["query_id"], r["vec_id"]): r["cosine"] for r in corpus.CosineIndex(e, "vec_id", "embedding").search(q).collect()}
    both = set(exact) & set(found)
    assert len(exact) == 5 * q.count() and len(both) >= 0.9 * len(exact) and all(abs(exact[k] - found[k]) < 1e-9 for k in both)
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [0.0, -1.0])], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in corpus.exact_neighbours(odd, odd, "vec_id", "embedding").collect()}
    assert got == {(1, 1, 2), (1, 2, 6), (2, 1, 1), (2, 2, 6), (6, 1, 1), (6, 2, 2)} == {(r["query_id"], r["rank"], r["vec_id"]) for r in corpus.CosineIndex(odd, "vec_id", "embedding").search(odd).collect()}
    assert corpus.CosineIndex(odd.limit(0), "vec_id", "embedding").search(odd).count() == 0


def test_components_equal_a_plain_decomposition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    values, x = corpus.truncated_svd(docs, "doc_id", "text", 4, rounds=12)
    w = corpus.weights(docs, "doc_id", "text").collect()
    rows, cols = ({v: i for i, v in enumerate(sorted({r[c] for r in w}))} for c in ("doc_id", "term"))
    a = np.zeros((len(rows), len(cols)))
    for r in w:
        a[rows[r["doc_id"]], cols[r["term"]]] = r["weight"]
    length = np.linalg.norm(a, axis=1, keepdims=True)
    a = a / np.where(length > 0, length, 1)
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(values, s[:4], rtol=1e-4)
    got = np.zeros((len(rows), 4))
    for r in x.collect():
        got[rows[r["doc_id"]]] = r["x"]
    plain = u[:, :4] * s[:4]
    assert np.abs(got @ got.T - plain @ plain.T).max() < 1e-2  # signs and near-equal values apart


def test_layout_puts_like_texts_together(spark):
    rng = np.random.default_rng(3)
    topics = [[f"{a}{b}" for b in "abcdefghijklmnop"] for a in ("ka", "mo", "ti")]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(topics[i % 3], 30))) for i in range(90)] + [(90, None), (91, "")], "doc_id long, text string")
    at = {r["doc_id"]: np.array([r["x"], r["y"]]) for r in corpus.layout(docs, "doc_id", "text").collect()}
    assert set(at) == set(range(90)) and all(np.isfinite(p).all() for p in at.values())
    apart = lambda same: np.mean([np.linalg.norm(at[i] - at[j]) for i in range(90) for j in range(i) if (i % 3 == j % 3) == same])
    assert apart(False) > 5 * apart(True)
