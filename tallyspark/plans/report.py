"""Long report tables, their text, and file sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import stats
from ..operators.scan import row_numbers
from ..sources.staging import Scratch


def _long(df: DataFrame, block: str, key: str | None = None) -> DataFrame:
    """A table's numbers as rows (block, key, metric, value)."""
    cols = [c for c in df.columns if c != key]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols]))
    k = F.col(key).cast("string") if key else F.lit("")
    return df.select(F.lit(block).alias("block"), k.alias("key"), rows.alias("r")).select("block", "key", "r.metric", "r.value")


def statistic_table(items: DataFrame, flags: DataFrame, ratios: DataFrame) -> DataFrame:
    """(ord, block, key, metric, value): scope, all items' use, inequality in scope, ratios and their tiers.

    The tables are saved once, narrowed to what the figures need, and so are the running totals that the order statistics
    are read from; ord numbers the blocks in the order of the report.
    """
    scratch = Scratch(items.sparkSession, "statistics")
    s, f = "subscribers", F.col("is_private_like")
    flags = scratch.save(items.select("mod_id", s).join(flags, "mod_id", "left"))
    items, inside, ratios = flags.select(s), flags.where(f != 1).select(s), scratch.save(ratios.select("ratio", "tier"))
    scope = flags.agg(F.count("*").alias("items"), F.count_if(f == 1).alias("private_like"), F.count_if(f == 0).alias("in_scope"), F.avg((f == 1).cast("double")).alias("private_share"))
    every, some = scratch.save(stats.totals(items, s)), scratch.save(stats.totals(inside, s))
    shares = stats.end_shares(inside, s, (0.01, 0.05, 0.10), (0.10, 0.20), some).select(F.concat_ws("_", "side", F.round(F.col("p") * 100).cast("int").cast("string")).alias("side"), "share")
    parts = [
        _long(scope, "scope"), _long(stats.overview(items, s, known=every), "all"), _long(stats.percentiles(items, s, known=every), "all"), _long(stats.top_concentration(items, s, known=every), "all_top", "key"),
        _long(stats.hhi(items, s), "all"), _long(stats.gini(items, s, known=every), "all"), _long(stats.pareto(items, s, known=every), "all_pareto", "target"), _long(stats.thresholds(items, s), "all_at_least", "threshold"),
        _long(stats.buckets(items, s), "all_bucket", "bucket"), _long(stats.overview(inside, s, known=some), "scope_use"), _long(stats.percentiles(inside, s, (0.01, 0.10, 0.50, 0.90, 0.99), known=some), "scope_use"),
        _long(shares, "scope_share", "side"), _long(stats.quantile_ratios(inside, s, known=some), "scope_use"), _long(stats.gini(inside, s, known=some), "scope_use"),
        _long(stats.descriptive(ratios, "ratio"), "ratio"), _long(ratio_tiers(ratios), "ratio_tier", "tier")]
    return reduce(DataFrame.unionByName, [p.select(F.lit(i).alias("ord"), "*") for i, p in enumerate(parts, 1)])


def ratio_tiers(ratios: DataFrame) -> DataFrame:
    """(tier, n, mean, median) of all four tiers; an empty one has n = 0 and nulls."""
    known = Scratch(ratios.sparkSession, "tiers").save(stats.totals(ratios, "ratio", ["tier"]))  # the source is read once
    g = known.groupBy("tier").agg(F.sum("c").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean")).join(
        stats.quantiles(ratios, "ratio", (0.5,), ["tier"], known).withColumnRenamed("p50", "median"), "tier", "left")
    every = ratios.sparkSession.range(4).select(F.col("id").cast("int").alias("tier"))
    return every.join(g, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"), "mean", "median")


def tier_figures(ratios: DataFrame) -> DataFrame:
    """All figures of the ratio by tier, one row a tier that has items."""
    return stats.descriptive(ratios, "ratio", ["tier"])


def metadata_table(items: DataFrame, listed: DataFrame, description: str, created: DataFrame | None = None, hub: DataFrame | None = None) -> DataFrame:
    """(field, value): description, time of creation, counts, hub figures, and a row for each id that is listed but has no item.

    created has one row with ``modified``; hub has app_id, tags (structs of name and count) and items.
    """
    count = lambda df, name: df.agg(F.lit(name).alias("field"), F.count("*").cast("string").alias("value"))
    gaps = listed.select("mod_id").join(items.select("mod_id"), "mod_id", "left_anti")
    parts = [items.sparkSession.createDataFrame([("description", description)], "field string, value string"), count(items, "items"), count(listed, "listed"), count(gaps, "missing"),
             gaps.select(F.lit("missing_id").alias("field"), F.col("mod_id").cast("string").alias("value"))]
    if created is not None:
        parts.append(created.select(F.lit("created").alias("field"), text.local_stamp(F.col("modified")).alias("value")))
    if hub is not None:
        fields = [("app_id", F.col("app_id").cast("string")), ("tag_counts", text.count_lines(F.col("tags"))), ("hub_items", F.col("items").cast("string"))]
        parts.append(hub.select(F.inline(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in fields]))))
    return reduce(DataFrame.unionByName, parts)


def as_text(table: DataFrame) -> DataFrame:
    """The report table with numbers as text and, for shares, a bar."""
    share = F.col("metric").startswith("share") | F.col("metric").endswith("share")
    return table.select("ord", "block", "key", "metric", F.when(share, text.percent_text(F.col("value"))).otherwise(text.number_text(F.col("value"))).alias("value"), F.when(share, text.bar(F.col("value"))).alias("bar"))


def markdown(table: DataFrame) -> str:
    """A report of a few hundred rows at most (one a statistic), read to the driver."""
    out, block = [], None
    for r in as_text(table).orderBy("ord", "key", "metric").collect():
        if r.block != block:
            block = r.block
            out += ["", f"## {block}", "", "| key | metric | value | |", "|---|---|---|---|"]
        out.append(f"| {r.key} | {r.metric} | {r.value} | {r.bar or ''} |")
    return "\n".join(out[1:]) + "\n"


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as Parquet, replacing what is there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_tiers(ratios: DataFrame, path: str) -> None:
    """Ratio rows by tier, each tier in files of its own, as many as its rows need: ranges of falling ratio, ordered inside a file."""
    order = ["tier", F.desc("ratio"), "mod_id"]
    ratios.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("tier").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def url_document(urls: DataFrame, id_col: str, url: str) -> DataFrame:
    """(place, json): the non-blank urls as JSON strings, one a row, placed in order of id: the lines of a list of any length."""
    some = row_numbers(urls.where(F.trim(url) != "").select(id_col, url), [F.col(id_col), F.col(url)], "place")
    return some.select("place", F.regexp_extract(F.to_json(F.array(url)), r"(?s)^\[(.*)\]$", 1).alias("json"))


def write_lines(document: DataFrame, path: str) -> None:
    """The rows' json as text files that follow one another in order of place."""
    document.repartitionByRange("place").sortWithinPartitions("place").select("json").write.mode("overwrite").text(path)


def gap_document(status: DataFrame, key: str) -> DataFrame:
    """(part, key, status): the counts, then each key that is not ok, and those that nothing expected."""
    s = F.col("status")
    one = status.agg(F.count_if(s != "extra").alias("url_count"), F.count_if(~s.isin("ok", "extra")).alias("gap_count"))
    counts = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("part"), F.col(c).alias("key"), F.lit(None).cast("string").alias("status")) for c in one.columns])))
    rows = status.where(s != "ok").select(F.when(s == "extra", "extra").otherwise("gap").alias("part"), F.col(key).cast("long").alias("key"), "status")
    return counts.unionByName(rows)
