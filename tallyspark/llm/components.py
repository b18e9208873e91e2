"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links(a, b) -> (id, root): every linked node except the roots, with the smallest id it reaches.

    Null ends and self links are ignored; repeated links and either direction are fine; an empty table
    gives an empty table. Rounds grow with the logarithm of the longest chain, each writes one table.
    """
    e = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, seen, last = scratch.save(e), None, None
    while True:
        mark = tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.hash("v", "u").cast("long"))).first())
        if mark == seen or not mark[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = mark
        # A round has at most about twice as many links; small ones need not be written by many tasks.
        last, e = e, scratch.save(_small(_large(e)).coalesce(max(1, mark[0] // 100_000)))
        scratch.free(last)
