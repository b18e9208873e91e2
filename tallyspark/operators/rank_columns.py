"""Rank columns whose number and names come from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import slug
from .relations import last_wins


def column_order(seen: DataFrame, tag: str, order: Sequence[str], lead: str | None = None, hub: DataFrame | None = None) -> DataFrame:
    """(place, tag, name, first): a row for each tag, in the order of the rank columns.

    ``lead`` comes first whether seen or not, then the tags of hub(tag, place) by place, seen or not, then the others in the order in which
    they are first seen. name is the tag's slug; of tags whose slugs are the same but for case, the first keeps it and the
    others get _2, _3 and so on, past names that are taken. Null and blank tags have no column. One row a tag, so the order is made in one task.
    """
    spark = seen.sparkSession
    named = lambda df: df.where(F.trim(F.col(tag)) != "")
    found = named(seen).groupBy(F.col(tag).alias("tag")).agg(F.min(F.struct(*order)).alias("first"))
    none = F.lit(None).cast("long")
    wanted = spark.createDataFrame([(lead,)] if lead else [], "tag string").select("tag", F.lit(0).alias("kind"), none.alias("at"))
    if hub is not None:
        wanted = wanted.unionByName(named(hub).select(F.col(tag).alias("tag"), F.lit(1).alias("kind"), F.col("place").cast("long").alias("at")))
    wanted = wanted.groupBy("tag").agg(F.min(F.struct("kind", "at")).alias("w"))
    every = found.join(wanted, "tag", "full").withColumn("kind", F.coalesce("w.kind", F.lit(2)))
    by = [F.col("kind"), F.col("w.at"), F.col("first"), F.col("tag")]
    every = every.select("tag", "first", F.row_number().over(Window.orderBy(*by)).alias("place"), F.coalesce(F.nullif(slug(F.trim("tag")), F.lit("")), F.lit("unknown")).alias("slug"))
    twin = F.row_number().over(Window.partitionBy(F.lower("slug")).orderBy("place"))
    return every.select("place", "tag", F.when(twin == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("_"), twin.cast("string"))).alias("name"), "first")


def rank_table(seen: DataFrame, key: str, tag: str, rank: str, order: Sequence[str], lead: str | None = None, hub: DataFrame | None = None, most: int = 2000) -> DataFrame:
    """One row a key, a nullable rank column for each tag of ``column_order``, in its order; a later sighting of (key, tag) replaces an earlier one.

    The names and order of the columns reach the driver, at most ``most`` of them, else an error. A name that is taken by the key or by
    an earlier column gets further underscores.
    """
    columns = column_order(seen, tag, order, lead, hub).orderBy("place").limit(most + 1).collect()
    if len(columns) > most:
        raise ValueError(f"over {most} tags in {tag}")
    taken, names = {key.lower()}, []
    for c in columns:
        name = c["name"]
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    cell: dict[str, Column] = {c["tag"]: F.max(F.when(F.col(tag) == c["tag"], F.col(rank))) for c in columns}
    last = last_wins(seen.select(key, tag, rank, *[o for o in order if o not in (key, tag, rank)]), [key, tag], list(order), [rank])
    return last.groupBy(key).agg(*[cell[c["tag"]].alias(n) for c, n in zip(columns, names, strict=True)]) if columns else seen.select(key).distinct()
