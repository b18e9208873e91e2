"""Global running totals and ranks without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Scratch

#: Rows that one range bucket is meant to hold, and the most buckets made.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 512
#: Ranges of ``row_numbers``, if the session has fewer shuffle partitions.
RANGES = 64


def value_runs(df: DataFrame, value: str, group_cols: list[str] | None = None) -> DataFrame:
    """(groups, v, c): how often each non-null value occurs. Equal values fold before any ordering."""
    g = group_cols or []
    return df.where(F.col(value).isNotNull()).groupBy(*g, F.col(value).alias("v")).agg(F.count("*").alias("c"))


def bucket_of(df: DataFrame, value: str, rows: int) -> Column:
    """Range bucket of a numeric column of so many rows by approximate quantiles; at most ``MOST_BUCKETS`` bounds reach the driver."""
    buckets = min(MOST_BUCKETS, -(-rows // BUCKET_ROWS))
    if buckets < 2:
        return F.lit(0)
    bounds = sorted(set(df.stat.approxQuantile(value, [i / buckets for i in range(1, buckets)], 0.25 / buckets)))

    def among(lo: int, hi: int) -> Column:  # binary search
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(value) > bounds[mid], among(mid + 1, hi)).otherwise(among(lo, mid))

    return among(0, len(bounds))


def running_totals(df: DataFrame, value: str, sums: dict[str, Column], group_cols: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Adds, for each name in ``sums``, the total over rows ordered before (name_before) and in all (name_all).

    Rows are dealt into range buckets of ``value``; totals run inside each bucket and over the small table
    of bucket totals, so neither a global order nor one large group is sorted in one task; how many buckets
    follows from the number of rows. Values must be distinct within a group. The rows are saved first, as they are looked at three times.
    """
    g = group_cols or []
    df = Scratch(df.sparkSession, "totals").save(df)
    own = df.withColumn("_bucket", bucket_of(df, value, df.count())).withColumns({f"_{k}": c for k, c in sums.items()})
    order = lambda c: F.desc(c) if descending else F.asc(c)
    upto = (Window.unboundedPreceding, -1)
    per = own.groupBy(*g, "_bucket").agg(*[F.sum(f"_{k}").alias(f"_t_{k}") for k in sums])
    across = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    per = per.select(*g, "_bucket", *[F.coalesce(F.sum(f"_t_{k}").over(across.orderBy(order("_bucket")).rowsBetween(*upto)), F.lit(0)).alias(f"_p_{k}") for k in sums],
                     *[F.sum(f"_t_{k}").over(across).alias(f"{k}_all") for k in sums])
    keys = [own[c].eqNullSafe(per[c]) for c in [*g, "_bucket"]]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    joined = own.join(per, cond).drop(*[per[c] for c in [*g, "_bucket"]])
    inside = Window.partitionBy(*g, "_bucket").orderBy(order(value)).rowsBetween(*upto)
    out = joined.withColumns({f"{k}_before": F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) + F.col(f"_p_{k}") for k in sums})
    return out.drop("_bucket", *[f"_{k}" for k in sums], *[f"_p_{k}" for k in sums])


def rank_desc(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """RANK() OVER (ORDER BY value DESC NULLS LAST): ranks of distinct values, joined back."""
    runs = running_totals(df.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c")), "v", {"c": F.col("c")}, descending=True)
    return df.join(runs.select(F.col("v").alias("_v"), (F.col("c_before") + 1).alias(name)), F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def row_numbers(df: DataFrame, order: list[Column], name: str = "row") -> DataFrame:
    """Adds the 1-based place of each row in a total order, by range partitions and the counts before each.

    The ranges are saved before they are counted, so that a second look finds the same ones.
    """
    parts = Scratch(df.sparkSession, "ranges").save(df.repartitionByRange(max(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order).withColumn("_part", F.spark_partition_id()))
    upto = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(counts), "_part").withColumn(name, inside + F.col("_before")).drop("_part", "_before")
