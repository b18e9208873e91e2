import os
import random
import time

import compare

from tallyspark.operators import corpus
from tallyspark.plans import builds, catalogue  # noqa: F401
from tallyspark.sources.staging import Scratch, settings


def test_ranking_file_keeps_empty_texts_and_rows_without_length_or_id(spark, tmp_path):
    texts = ["plain", "", None, '"', '""', "a,b", "cr\r\nlf", "end\r", "two\nlines", " ", "back\\slash", ""]
    rows = [(i, t, "en", "web", 7 - i // 2) for i, t in enumerate(texts)] + [(20, "no length", "en", "web", None), (21, "", "en", "web", None), (None, "no id", "en", "web", 7), (None, "", "en", "web", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert compare.differences(spark, catalogue.QUERIES["ranking_file"], catalogue.ORACLES["ranking_file"], str(tmp_path)) == ""


def _texts(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice("abcdefghijklmnop") + rnd.choice("abcdefgh") * (i % 5 + 1) for _ in range(30))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/texts")
    return spark.read.parquet(f"{tmp_path}/texts")


def _shuffled(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # Spark deletes them beside the next step
        left = _shuffled(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def _tables(scratch: Scratch) -> list[str]:
    return os.listdir(scratch.root.removeprefix("file://"))


def test_components_leave_no_tables_and_no_shuffle_files(spark, tmp_path):
    docs, scratch, before = _texts(spark, tmp_path), Scratch(spark, "svd"), _shuffled(spark)
    _, x = corpus.truncated_svd(docs, "doc_id", "text", 2, rounds=1, passes=2, scratch=scratch)
    assert len(_tables(scratch)) == 1 and not _left(spark, before)
    assert x.count() == 60


def test_a_layout_searches_its_neighbours_in_steps_and_leaves_one_table(spark, tmp_path, monkeypatch):
    docs, scratch, before = _texts(spark, tmp_path), Scratch(spark, "layout"), _shuffled(spark)
    start = corpus.truncated_svd(docs, "doc_id", "text", 3, rounds=1, passes=1)
    monkeypatch.setattr(corpus, "truncated_svd", lambda *a, **k: start)
    whole = corpus.layout(docs, "doc_id", "text", 3, rounds=2, scratch=scratch)
    assert len(_tables(scratch)) == 1 and not _left(spark, before)
    monkeypatch.setattr(corpus, "SEARCHED", 13)
    got = {r["doc_id"]: (round(r["x"], 9), round(r["y"], 9)) for r in corpus.layout(docs, "doc_id", "text", 3, rounds=2).collect()}
    assert got == {r["doc_id"]: (round(r["x"], 9), round(r["y"], 9)) for r in whole.collect()} and len(got) == 60


def test_pairs_of_text_and_term_stay_in_their_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus, "BLOCK", 64_000)  # some ten blocks
    c = corpus.Counts(_texts(spark, tmp_path), "doc_id", "text", Scratch(spark, "pairs"))
    with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
        joined = c.pairs.join(c.home(c.across({})).hint("shuffle_hash"), ["block", "term"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(term") == 1 == plan.count("Exchange hashpartitioning(block") and plan.count("Exchange ") == 2
