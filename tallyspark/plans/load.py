"""Loading list pages into tables, with figures of the load gathered in the passes that write them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..operators.rank_columns import rank_table
from ..operators.relations import first_wins
from ..sources.markup import list_entries
from ..sources.staging import Scratch


@dataclass
class Load:
    """details, browse and ranks, a row an item each, and the figures."""

    details: DataFrame
    browse: DataFrame
    ranks: DataFrame
    counters: dict[str, int]


def load_lists(pages: DataFrame, page_id: str, html: str, detail_base: str, lead: str | None = None, hub: DataFrame | None = None, scratch: Scratch | None = None) -> Load:
    """List pages in order of page_id -> the tables made of them.

    Of an item seen several times its first sighting gives title, author and so on, and its last under a tag the rank there.
    Pages without tag or items are skipped. The pages are read and parsed once: files, skipped pages and rows are observed as the rows are
    written, keys and overwritten ranks as the sightings of each item and tag are put together. A row overwrites if the item's rank under the
    tag was another one just before.
    """
    scratch = scratch or Scratch(pages.sparkSession, "load")
    used = F.col("tag").isNotNull() & (F.size("entries") > 0)
    read = Observation()
    entries = list_entries(pages, page_id, html, detail_base).observe(
        read, F.count(F.lit(1)).alias("files"), F.count_if(~used).alias("skipped"), F.coalesce(F.sum(F.when(used, F.size("entries"))), F.lit(0)).alias("rows"))
    rows = scratch.save(entries.where(used).select(F.col(page_id).alias("page"), "tag", F.posexplode("entries").alias("nth", "e")).select("page", "tag", "nth", "e.*"))
    order = ["page", "nth"]
    seen = Observation()
    before = F.lag("rank").over(Window.partitionBy("item_id", "tag").orderBy(*order))
    last = rows.select("item_id", "tag", "rank", *order, F.coalesce(before != F.col("rank"), F.lit(False)).alias("over"))
    last = last.groupBy("item_id", "tag").agg(F.max_by("rank", F.struct(*order)).alias("rank"), F.min(F.struct(*order)).alias("first"), F.count_if("over").alias("over"))
    last = scratch.save(last.observe(seen, F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum("over"), F.lit(0)).alias("overwrites")))
    ranks = rank_table(last, "item_id", "tag", "rank", ["first"], lead, hub)
    text = ["title", "description", "star_rating", "author", "detail_url"]
    kept = Observation()
    items = scratch.save(first_wins(rows, ["item_id"], order, text).observe(kept, F.count(F.lit(1)).alias("keys")))
    counters = {**read.get, **seen.get, **kept.get, "tag_columns": len(ranks.columns) - 1}
    return Load(items.select("item_id", "detail_url"), items.drop("detail_url"), ranks, counters)
