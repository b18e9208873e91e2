"""The work queue as a stream: results arrive, each batch steps the state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import work_queue


BUCKETS = 256


def _keep(state: DataFrame, root: str, version: int) -> None:
    """Writes rows as this version of their buckets; the same version again replaces itself."""
    rows = state.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")).withColumn("version", F.lit(version).cast("long"))
    rows.repartition("bucket").write.partitionBy("bucket", "version").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)


def _forget(spark: SparkSession, root: str, buckets: list[int], kept: int = 2) -> None:
    """Deletes all but the newest versions of some buckets: the last one, and the one that a batch run again starts from."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs = of(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for b in (b for b in buckets if fs.exists(of(f"{root}/bucket={b}"))):  # results of unknown ids can fall into an empty one
        versions = sorted((f.getPath() for f in fs.listStatus(of(f"{root}/bucket={b}")) if f.getPath().getName().startswith("version=")), key=lambda p: int(p.getName().split("=")[1]))
        for old in versions[:-kept]:
            fs.delete(old, True)


def begin(state: DataFrame, root: str) -> None:
    """Lays down the queue's start, version -1 of every bucket."""
    _keep(state, root, -1)


def current(spark: SparkSession, root: str, before: int = 2**62) -> DataFrame:
    """The state as of the newest version of each bucket below ``before``: (id, url, status, retry_count, bucket)."""
    every = spark.read.schema("id long, url string, status string, retry_count int, bucket int, version long").parquet(root)
    newest = every.where(F.col("version") < before).groupBy("bucket").agg(F.max("version").alias("version"))
    return every.join(F.broadcast(newest), ["bucket", "version"]).drop("version")  # BUCKETS rows


def follow(results: DataFrame, state_root: str, checkpoint: str, gap_phase: bool = False):
    """Starts a query that applies each micro-batch of results to the state that ``begin`` laid down.

    The state lies in buckets by a hash of id, each in versions numbered by batch: a batch reads and writes
    the buckets its ids fall into and no others, and a batch that is run again after a failure reads
    the versions before it and writes its own anew. Of each bucket two versions stay, so batches cost the same however many went before.
    """

    def apply(batch: DataFrame, number: int) -> None:
        latest = batch.groupBy("id").agg(F.max_by(F.struct("ok", "status_code"), "seq").alias("r")).select("id", "r.ok", "r.status_code")
        touched = latest.select(F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int").alias("bucket")).distinct()
        before = current(batch.sparkSession, state_root, number).join(F.broadcast(touched), "bucket", "left_semi")
        _keep(work_queue.step(before, latest, gap_phase), state_root, number)
        _forget(batch.sparkSession, state_root, [r["bucket"] for r in touched.collect()])  # BUCKETS at most

    return results.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def heartbeat(events: DataFrame, ts: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(from, to, n): progress by time window; works on streams and tables."""
    w = F.window(ts, window)
    return events.withWatermark(ts, late).groupBy(w).agg(F.count("*").alias("n")).select(F.col("window.start").alias("from"), F.col("window.end").alias("to"), "n")
