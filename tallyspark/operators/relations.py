"""Joins, keyed folds, pivots and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import rank_desc, row_numbers


def missing_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of left whose key right lacks."""
    return left.join(right.select(key), key, "left_anti")


def coverage(expected: DataFrame, present: DataFrame, key: str, ok: Column) -> DataFrame:
    """(key, status) of every key: ok, invalid, missing, or extra if nothing expected it."""
    a = expected.select(key).distinct().withColumn("_want", F.lit(True))
    b = present.select(key, ok.alias("_ok")).groupBy(key).agg(F.max("_ok").alias("_ok"))
    status = F.when(F.col("_want").isNull(), "extra").when(F.col("_ok").isNull(), "missing").when(F.col("_ok"), "ok").otherwise("invalid")
    return a.join(b, key, "full").select(key, status.alias("status"))


def first_wins(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def last_wins(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def rank_pivot(df: DataFrame, key: str, tag: str, rank: str, order: list[str], tags: list[str]) -> DataFrame:
    """One nullable rank column a tag, in the order given; a later sighting of (key, tag) replaces an earlier one."""
    return last_wins(df, [key, tag], order, [rank]).groupBy(key).pivot(tag, tags).agg(F.first(rank))


def rank_overwrites(df: DataFrame, key: str, tag: str, rank: str, order: list[str]) -> DataFrame:
    """(rows, keys, overwrites): how often a sighting changed the rank seen just before for its key and tag."""
    before = F.lag(rank).over(Window.partitionBy(key, tag).orderBy(*order))
    changed = F.coalesce(before != F.col(rank), F.lit(False))
    return df.select(key, changed.alias("x")).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.count_if("x").alias("overwrites"))


def best_rank(df: DataFrame, key: str, columns: list[str], absent: int = 1_000_000_000) -> DataFrame:
    return df.select(key, F.coalesce(F.least(*columns), F.lit(absent)).alias("best_rank"))


def ranked_subset(items: DataFrame, subset: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, rank_all, rank_subset) of the items in subset, ranked among all and among themselves."""
    within = rank_desc(items.join(subset.select(key).distinct(), key, "left_semi").select(key, value), value, "rank_subset")
    return rank_desc(items.select(key, value), value, "rank_all").join(within.select(key, "rank_subset"), key)


def positions(items: DataFrame, key: str, value: str) -> DataFrame:
    """(key, position): 0-based place by value descending, then key, found without ordering all rows, or all ties, in one task."""
    r = row_numbers(items.select(key, value), [F.desc(value), F.col(key)], "_r")
    return r.select(key, (F.col("_r") - 1).alias("position"))


def sorted_by_position(rows: DataFrame, places: DataFrame, key: str, default: int = 2**62) -> DataFrame:
    """Rows with a position, in its order, unknown keys last."""
    return rows.join(places, key, "left").withColumn("position", F.coalesce("position", F.lit(default))).orderBy("position", key)


def page_urls(tags: DataFrame, tag: str, count: str, base: str, per_page: int = 30, most: int = 1667) -> DataFrame:
    """(tag, page, url) of all pages of each tag; the tag key comes last."""
    from ..functions.text import form_encode

    pages = F.least(F.lit(most), F.ceil(F.col(count) / per_page)).cast("int")
    rows = tags.where(F.col(count) > 0).select(tag, F.explode(F.sequence(F.lit(1), pages)).alias("page"))
    return rows.select(tag, "page", F.concat(F.lit(base + "?p="), F.col("page").cast("string"), F.lit("&requiredtags%5B%5D="), form_encode(F.col(tag))).alias("url"))


def all_page_urls(tags: DataFrame, tag: str, count: str, total: DataFrame, items: str, base: str, per_page: int = 30, most: int = 1667) -> DataFrame:
    """(place, tag, page, url): the pages of each tag, then those without a tag (null) up to ``items`` of the one-row table total.

    Tags keep their order by the column ``place`` of tags; place orders the result.
    """
    tagged = page_urls(tags, tag, count, base, per_page, most).join(tags.select(tag, "place"), tag)
    pages = F.least(F.lit(most), F.ceil(F.col(items) / per_page)).cast("int")
    plain = total.where(F.col(items) > 0).select(F.explode(F.sequence(F.lit(1), pages)).alias("page"))
    plain = plain.select(F.lit(None).cast("string").alias(tag), "page", F.concat(F.lit(base + "?p="), F.col("page").cast("string")).alias("url"), F.lit(2**62).alias("place"))
    return tagged.select(tag, "page", "url", "place").unionByName(plain).select(F.struct("place", "page").alias("place"), tag, "page", "url")


def prefer(detail: DataFrame, browse: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """All keys of both; detail's values where it has them."""
    a = detail.select(key, *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = browse.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    return a.join(b, key, "full").select(key, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns])


def shares_by(df: DataFrame, col: str) -> DataFrame:
    """(col, items, pct) of every value."""
    g = df.groupBy(col).agg(F.count("*").alias("items"))
    total = g.agg(F.sum("items").alias("_t")).withColumn("_k", F.lit(1))
    return g.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").select(col, "items", (100.0 * F.col("items") / F.col("_t")).alias("pct"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, violations): rows for which each condition is not true, in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("violations")) for k in checks])))


def authors(browse: DataFrame, author: str, order: list[str]) -> DataFrame:
    """(username, has_han): each normalised, non-blank name once, with the flag of its last sighting."""
    from ..functions.text import has_han, username

    seen = browse.where(F.trim(author) != "").select(username(F.col(author)).alias("username"), *order).where("username <> ''")
    return last_wins(seen.withColumn("has_han", has_han(F.col("username"))), ["username"], order, ["has_han"])


def with_authors(items: DataFrame, browse: DataFrame, names: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """Items with their author's flag (0 if the author or its row is missing), without private-like ones and without null or negative use."""
    from .derive import in_scope

    able = in_scope(items, flags, key).where("subscribers is not null and subscribers >= 0")
    known = able.join(browse.select(key, "author"), key, "left").join(names.select(F.col("username").alias("author"), "has_han"), "author", "left")
    return known.select(key, "subscribers", F.coalesce("has_han", F.lit(0)).alias("has_han"))


def by_flagged_author(items: DataFrame, browse: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Items whose author's flag is 1, with the author."""
    flagged = names.where("has_han = 1").select(F.col("username").alias("author"))
    return items.join(browse.select(key, "author"), key).join(flagged, "author", "left_semi")


def missing_columns(spark, required: dict[str, list[str]]) -> DataFrame:
    """(table, column): what the session's catalogue lacks of the required tables and columns; column is null for a whole table."""
    lacks = []
    for table, columns in required.items():
        there = {c.name for c in spark.catalog.listColumns(table)} if spark.catalog.tableExists(table) else None
        lacks += [(table, None)] if there is None else [(table, c) for c in columns if c not in there]
    return spark.createDataFrame(lacks, "table string, column string")
