"""Bounded, reproducible samples of labelled rows for fitting a model on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bounded_sample(rows: DataFrame, label: str, id_col: str, per_label: dict | int, seed: int) -> DataFrame:
    """At most ``per_label`` rows of each label value (a number, or one by value): those with the least hashes of id and text.

    rows has the label, the id and the text. One pass counts the labels, one takes the sample, however many
    labels there are. A threshold from a label's count leaves few more rows than are taken, so the order
    that makes reruns agree costs a task no more than the sample of one label; repeated rows are counted,
    not listed, until they are taken. A label of null is never sampled.
    """
    u = F.pmod(F.xxhash64(F.col(id_col), F.col("text"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()  # one row a label value
    most = lambda value: per_label.get(value, 0) if isinstance(per_label, dict) else per_label
    limits = [(r[label], most(r[label]), (1.05 * most(r[label]) + 30) / r["count"]) for r in counts if most(r[label])]
    kind = T.StructType([T.StructField(label, rows.schema[label].dataType), T.StructField("_most", T.LongType()), T.StructField("_below", T.DoubleType())])
    limits = F.broadcast(rows.sparkSession.createDataFrame(limits, kind))  # one row a label value, just collected
    near = rows.join(limits, label).withColumn("_u", u).where("_u < _below")
    near = near.groupBy(label, "_most", "_u", id_col, "text").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_u", id_col, "text").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_left", F.col("_most") - F.coalesce(F.sum("_n").over(before), F.lit(0))).where("_left > 0")
    return near.withColumn("_", F.explode(F.sequence(F.lit(1), F.least("_n", "_left")))).select(rows.columns)
