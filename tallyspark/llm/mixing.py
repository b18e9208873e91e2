"""Mixing sources to target weights by capped water-filling (operator 4), DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BUCKETS = 16**3


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """sources(skey, source_size) -> the same with target.

    Sources in order of skey weigh ``weights``, repeating. Together they get ``share`` of all sizes;
    a source is clamped at ``epochs`` times its size and its excess reshared by weight among the rest
    until none is above. That fixed point is a water level: sources fill up in order of size by weight,
    so one ordered pass finds who is clamped. The table has one row a source, so the pass is one task.
    """
    n = F.row_number().over(Window.orderBy("skey")) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (n % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w.cast("double")).withColumn("cap", epochs * F.col("source_size"))
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("full", level * F.col("w") >= F.col("cap"))
    rest = F.sum("source_size").over(every) * share - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    return s.select("skey", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(rest / free * F.col("w")).alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
    keep: Sequence[str] = (), scratch: Scratch | None = None,
) -> DataFrame:
    """docs(doc_id, text, source, ...) -> (doc_id, keep..., size, source_size, target, taken), one row per input row.

    size counts runs of non-whitespace. Each source repeats its documents whole as often as its target
    allows; the fraction that remains goes, in order of a seeded hash, to documents until the target's
    words are used up, the last of them in part. So a source takes its target to within a word and no
    document more than ``epochs`` times its size. Null texts have size 0, null sources form one source
    that comes last, a null doc_id hashes as ''; repeated rows each take their part; reruns agree.
    Columns named in ``keep`` (none of the other names) are returned as they are.
    The order is found over hash buckets first and by row only inside the one bucket where a source's
    fraction ends, so no task sorts a whole source.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(
        "doc_id", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"), hashed.alias("h"),
        F.struct(*keep, F.lit(0)).alias("kept")).withColumn("bucket", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    rows = scratch.save(sized.drop("kept"))
    sums = scratch.save(rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words")))
    t = source_targets(sums.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = scratch.save(t.withColumn("whole", whole.cast("long")).withColumn(
        "extra", F.round("target").cast("long") - F.col("whole") * F.col("source_size")))
    by = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("words").over(by), F.lit(0))).join(t, "skey")
    ends = ends.where("before <= extra and extra < before + words").select("skey", F.col("bucket").alias("last"), "before")
    plan = scratch.save(t.join(ends, "skey", "left"))
    scratch.free(sums, t, *[rows] * bool(keep))
    full = (sized if keep else rows).join(plan, "skey")  # kept columns come from docs, not from a second copy
    # No bucket holds the end when the fraction takes in the whole source.
    last = F.coalesce("last", F.lit(BUCKETS))
    out = full.where(F.col("bucket") != last).withColumn("part", F.when(F.col("bucket") < last, F.col("size")).otherwise(F.lit(0)))
    inside = Window.partitionBy("skey").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = full.where(F.col("bucket") == last).withColumn("sofar", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = at.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - F.col("before") - F.col("sofar")))).drop("sofar")
    return out.unionByName(at).select("doc_id", *[F.col("kept")[c].alias(c) for c in keep], "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))
