"""Benchmark decontamination by size-partitioned MinHash containment (operator 6), DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def words_of(text: str) -> Column:
    """Runs of letters and digits, lower-cased; none for a null text."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles_of(words: Column, k: int) -> Column:
    """Hashes of the k-word runs; an empty array if there are fewer words."""
    starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, k)))


def item_shingles(items: DataFrame, k: int) -> DataFrame:
    """items(item_id, text) -> (item_id, width, q, shingle): distinct shingles, one of all words if there are under k."""
    w = items.where("item_id is not null").select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    w = w.withColumn("width", F.least(F.lit(k), F.size("words")))
    options = [F.when(F.col("width") == n, F.array_distinct(shingles_of(F.col("words"), n))) for n in range(1, k + 1)]
    w = w.select("item_id", "width", F.coalesce(*options).alias("s"))
    return w.select("item_id", "width", F.size("s").alias("q"), F.explode("s").alias("shingle")).dropDuplicates(["item_id", "shingle"])


def item_sketches(shingles: DataFrame, threshold: float, seed: int = 5) -> DataFrame:
    """The bottom-k MinHash of each item, k set by its size partition: (item_id, width, shingle).

    Partition p holds the items of 2^p to 2^(p+1) - 1 shingles. An item of q shingles that is contained
    to the threshold lacks at most floor((1 - threshold) q) of them, so one more sample than the largest
    item of its partition may lack always leaves a shared one: no document is lost.
    """
    top = F.pow(F.lit(2.0), F.floor(F.log2("q")) + 1) - 1
    k = F.floor(F.lit(1 - threshold) * top + F.lit(1e-9)) + 1
    ranked = F.array_sort(F.collect_list(F.struct(F.xxhash64("shingle", F.lit(seed)).alias("m"), "shingle")))
    s = shingles.withColumn("k", k).groupBy("item_id", "width", "k").agg(ranked.alias("r"))
    return s.select("item_id", "width", F.explode(F.slice("r", 1, F.col("k").cast("int"))).alias("r")).select("item_id", "width", "r.shingle")


def contained_items(
    docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, broadcast_rows: int = 1_000_000, scratch: Scratch | None = None,
) -> DataFrame:
    """docs(doc_id, text, ...), items(item_id, text, ...) -> (doc_id, item_id, shared, item_shingles).

    A pair is returned if at least ``threshold`` of the item's k-word shingles occur in the document's
    whole text. Candidates share a MinHash sample of the item; exact containment decides. Items of
    fewer than k words are searched as one shingle of all their words. Items without words and rows
    without an id take no part; rows that share a doc_id count as one document; null or empty texts
    contain nothing; repeated items count once; other columns are ignored.
    The items' table is broadcast only if it has at most ``broadcast_rows`` rows, and joined by shuffle
    beyond.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    every = scratch.save(item_shingles(items, k))
    sketch = scratch.save(item_sketches(every, threshold))
    widths = sorted(r[0] for r in every.select("width").distinct().collect())  # k values at most
    small = every.count() <= broadcast_rows
    hint = (lambda d: F.broadcast(d)) if small else (lambda d: d)

    def runs(rows: DataFrame) -> DataFrame:
        w = rows.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), words_of("text").alias("words"))
        parts = F.array(*[F.struct(F.lit(n).alias("width"), shingles_of(F.col("words"), n).alias("s")) for n in widths])
        return w.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.width", F.explode("p.s").alias("shingle"))

    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, shared long, item_shingles int")
    candidates = scratch.save(runs(docs).join(hint(sketch), ["width", "shingle"]).select("doc_id", "item_id").distinct())
    held = docs.select(F.col("doc_id").cast("long"), "text").join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    shared = runs(held).join(hint(every), ["width", "shingle"]).select("doc_id", "item_id", "q", "shingle").distinct()
    counts = shared.groupBy("doc_id", "item_id", "q").agg(F.count("*").alias("shared"))
    fit = counts.where(F.col("shared") >= F.lit(threshold) * F.col("q") - 1e-9).join(candidates, ["doc_id", "item_id"], "left_semi")
    return fit.select("doc_id", "item_id", "shared", F.col("q").alias("item_shingles"))


def clean_documents(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8, scratch: Scratch | None = None) -> DataFrame:
    """The documents, all columns, that contain no item; a null doc_id can't be named and stays."""
    hits = contained_items(docs, items, k, threshold, scratch=scratch).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti")
