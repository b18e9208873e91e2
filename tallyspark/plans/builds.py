"""Registered queries that build something: catalogue tables, documents of one file, streams with state; each is read back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, rank_columns, stats
from ..operators.scan import rank_desc, row_numbers
from ..sources import markup, onefile, page_files, readers, tables
from ..sources.staging import Scratch, mounted
from ..streaming import breaker_stream, page_queue, queue_stream
from . import adapter, catalogue, documents
from .adapter import load
from .catalogue import MF, MR, query, rounded
from .load import load_lists

# The breaker over a stream

_LATER = "(SELECT max(ts) FROM events) + INTERVAL 5 MINUTE"


@query(f"""WITH s AS (SELECT user_id AS port, event_id, ts, event_type = 'error' AS f, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS z FROM events),
n AS (SELECT port, event_id, ts, count(*) FILTER (f) OVER (PARTITION BY port, z ORDER BY ts, event_id) AS failures FROM s),
l AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY port ORDER BY ts DESC, event_id DESC) = 1)
SELECT port, failures, CASE WHEN failures >= 3 AND ts + INTERVAL 2 DAY > {_LATER} THEN 'quarantined' WHEN failures >= 2 THEN 'degraded' ELSE 'healthy' END AS state FROM l""")
def q_breaker_stream(spark: SparkSession, d: str) -> DataFrame:
    """Where each port stands five minutes after the last attempt, three failures setting it apart for two days.

    The attempts come as a stream in two halves; the query ends between them and goes on from its checkpoint.
    """
    root = Scratch(spark, "breaker").root
    e = load(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_type") == "error").alias("bad"))
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    middle, end = F.lit(lo + (hi - lo) / 2), F.lit(hi)
    tick = spark.range(1).select(F.lit(None).cast("long").alias("user_id"), (end + F.expr("INTERVAL 65 MINUTES")).alias("ts"), F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("boolean").alias("bad"))
    for half in (e.where(F.col("ts") < middle), e.where(F.col("ts") >= middle).unionByName(tick)):
        half.write.mode("append").parquet(f"{root}/attempts")
        attempts = spark.readStream.schema(e.schema).parquet(f"{root}/attempts")
        log = breaker_stream.standings(attempts, "user_id", "ts", "event_id", F.col("bad"), quarantine=3, quarantine_s=2 * 86400.0)
        breaker_stream.follow(log, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return breaker_stream.latest(spark.read.schema(breaker_stream.LOG).parquet(f"{root}/log"))


@query(catalogue.ORACLES["queue_step"])
def q_queue_stream(spark: SparkSession, d: str) -> DataFrame:
    """The queue after results that came as a stream in two runs of one query."""
    root, results = Scratch(spark, "queue").root, catalogue._results(spark, d).withColumn("seq", F.col("id"))
    queue_stream.begin(catalogue._state(spark, d), f"{root}/state")
    for half in (0, 1):
        results.where(F.col("id") % 2 == half).write.mode("append").parquet(f"{root}/results")
        stream = spark.readStream.schema("id long, ok boolean, status_code int, seq long").parquet(f"{root}/results")
        queue_stream.follow(stream, f"{root}/state", f"{root}/checkpoint", gap_phase=True).awaitTermination()
    return queue_stream.current(spark, f"{root}/state").drop("bucket")


# Rank columns from the data


def _brands(spark: SparkSession, d: str) -> DataFrame:
    """Parts under two spellings of their brand, so that slugs clash."""
    tag = F.when(F.col("p_partkey") % 3 == 0, F.replace("p_brand", F.lit("#"), F.lit(" "))).when(F.col("p_partkey") % 3 == 1, F.lower("p_brand")).otherwise(F.col("p_brand"))
    return load(spark, d, "part").select("p_size", tag.alias("tag"), "p_partkey", F.col("p_partkey").alias("rank"))


_TAG = "CASE p_partkey % 3 WHEN 0 THEN replace(p_brand, '#', ' ') WHEN 1 THEN lower(p_brand) ELSE p_brand END"
_HUB = ("Brand#33", "never seen", "Brand#22")


@query(f"""WITH s AS (SELECT {_TAG} AS tag, min(p_partkey) AS first FROM part GROUP BY 1), w AS (SELECT 'No_selected_tag' AS tag, 0 AS kind, 0 AS spot UNION ALL SELECT unnest({list(_HUB)}), 1, unnest([1, 2, 3])),
p AS (SELECT tag, row_number() OVER (ORDER BY coalesce(kind, 2), spot, first, tag) AS place, trim(regexp_replace(tag, '[^A-Za-z0-9_]+', '_', 'g'), '_') AS slug FROM s FULL JOIN w USING (tag))
SELECT place, tag, slug || CASE WHEN row_number() OVER (PARTITION BY lower(slug) ORDER BY place) > 1 THEN '_' || row_number() OVER (PARTITION BY lower(slug) ORDER BY place) ELSE '' END AS name FROM p""")
def q_rank_column_order(spark: SparkSession, d: str) -> DataFrame:
    hub = spark.createDataFrame([(t, i) for i, t in enumerate(_HUB)], "tag string, place int")
    return rank_columns.column_order(_brands(spark, d), "tag", ["p_partkey"], "No_selected_tag", hub).select(F.col("place").cast("long").alias("place"), "tag", "name")


@query("WITH s AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events) SELECT user_id, CAST(NULL AS BIGINT) AS No_selected_tag, CAST(NULL AS BIGINT) AS t_1st_of_all, "
       + ", ".join(f"arg_max(rank, event_id) FILTER (event_type = '{t}') AS {t}" for t in catalogue._TYPES) + " FROM s GROUP BY user_id")
def q_rank_table(spark: SparkSession, d: str) -> DataFrame:
    """A column for each type that events have, whatever they are, beside the leading one and one of the hub that nothing shows."""
    hub = spark.createDataFrame([("1st of all", 1), ("purchase", 0)], "event_type string, place int")
    return rank_columns.rank_table(catalogue._seen(spark, d), "user_id", "event_type", "rank", ["event_id"], "No_selected_tag", hub)


# Tables of the catalogue


def _database(spark: SparkSession, label: str) -> str:
    name = f"tally_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{Scratch(spark, label).root}'")
    return name


@query(f"{MF} SELECT mod_id, lang, subscribers, is_private_like FROM mods JOIN flags USING (mod_id)")
def q_catalogue_tables(spark: SparkSession, d: str) -> DataFrame:
    """Items and their flags as tables with the same buckets, read back and joined without an exchange."""
    db, m = _database(spark, "tables"), adapter.items(spark, d)
    items = tables.build(m.select("mod_id", "lang", "subscribers"), f"{db}.items", "mod_id", 16)
    flags = tables.build(adapter.flags(m), f"{db}.flags", "mod_id", 16)
    return items.join(flags.hint("shuffle_hash"), "mod_id")


@query(f"{MF} SELECT mod_id, is_private_like FROM flags WHERE is_private_like = 1")
def q_catalogue_reload(spark: SparkSession, d: str) -> DataFrame:
    """A table of all flags, reloaded with those that are set."""
    db, f = _database(spark, "reload"), adapter.flags(adapter.items(spark, d))
    tables.build(f, f"{db}.flags", "mod_id", 8)
    return tables.reload(f.where("is_private_like = 1").select("is_private_like", "mod_id"), f"{db}.flags", "mod_id")


@query(f"{MR} SELECT row_number() OVER (ORDER BY g, ratio DESC, mod_id) AS place, mod_id, ratio FROM (SELECT *, tier = 0 AS g FROM ratios)")
def q_catalogue_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Ratio rows inserted by falling ratio, those of the lowest tier after the others."""
    db, r = _database(spark, "ordered"), adapter.ratios(adapter.items(spark, d)).select("mod_id", "ratio", "tier")
    for part in (r.where("tier > 0"), r.where("tier = 0")):
        out = tables.insert_ordered(part.select("mod_id", "ratio"), f"{db}.ratios", [F.desc("ratio"), F.col("mod_id")])
    return out


@query("SELECT 'customer' AS source, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def q_catalogue_copy(spark: SparkSession, d: str) -> DataFrame:
    """All tables of one database copied over those of another, where one was there before, and read back."""
    one, two = _database(spark, "source"), _database(spark, "target")
    tables.build(load(spark, d, "customer"), f"{one}.customer", "c_custkey", 8)
    tables.build(load(spark, d, "supplier"), f"{one}.supplier", "s_suppkey", 8)
    tables.build(load(spark, d, "nation"), f"{two}.customer", "n_nationkey", 4)
    tables.copy_database(spark, one, two)
    rows = lambda t, k, n: spark.table(f"{two}.{t}").select(F.lit(t).alias("source"), F.col(k).alias("key"), F.col(n).alias("name"))
    return rows("customer", "c_custkey", "c_name").unionByName(rows("supplier", "s_suppkey", "s_name"))


# Documents of one file


@query("SELECT row_number() OVER (ORDER BY rank_all, mod_id) AS place, mod_id, mod_name, subscribers, rank_all FROM (SELECT doc_id AS mod_id, text AS mod_name, n_chars AS subscribers, rank() OVER (ORDER BY n_chars DESC) AS rank_all FROM documents)")
def q_ranking_file(spark: SparkSession, d: str) -> DataFrame:
    """The ranking as one CSV file with byte order mark, ordered, its texts with quotes and line ends; read back in its order."""
    path = f"{Scratch(spark, 'ranking').root}/ranking.csv"
    m = rank_desc(load(spark, d, "documents").select(F.col("doc_id").alias("mod_id"), F.col("text").alias("mod_name"), F.col("n_chars").alias("subscribers")), "subscribers", "rank_all")
    os.makedirs(os.path.dirname(mounted(path)))
    onefile.write_csv(m.select("mod_id", "mod_name", "subscribers", "rank_all"), path, ["rank_all", "mod_id"], empty='""')
    back = onefile.read_csv(spark, path, "mod_id long, mod_name string, subscribers long, rank_all long")
    return row_numbers(back, [F.col("rank_all"), F.asc_nulls_last("mod_id")], "place")


@query("SELECT row_number() OVER (ORDER BY page_id) - 1 AS place, url FROM pages WHERE trim(url) <> ''")
def q_url_list_file(spark: SparkSession, d: str) -> DataFrame:
    """Urls as one JSON array in one file, read back."""
    path = f"{Scratch(spark, 'url-list').root}/urls.json"
    os.makedirs(os.path.dirname(mounted(path)))
    onefile.write_json_list(load(spark, d, "pages").where(F.trim("url") != "").select("page_id", "url"), "url", path, ["page_id"])
    return onefile.read_text(spark, path).select(F.posexplode(F.from_json("value", "array<string>")).alias("place", "url")).withColumn("place", F.col("place").cast("long"))


def _report(spark: SparkSession, label: str, lines: list[str]) -> DataFrame:
    """(place, line) of a report written as one file and read back."""
    path = f"{Scratch(spark, label).root}/{label}.md"
    os.makedirs(os.path.dirname(mounted(path)))
    documents.write_report(spark, lines, path)
    return onefile.read_text(spark, path).select(documents.lines_of(F.col("value"))).where("line <> ''")


_BAR = "'`' || repeat('█', CAST(round_even(20 * s, 0) AS INT)) || repeat('░', 20 - CAST(round_even(20 * s, 0) AS INT)) || '`'"
_PCT = "format('{:.2f}%', 100 * s)"


@query(f"""{catalogue.M}, t AS (SELECT count(*) AS n FROM mods), a AS (SELECT unnest([100, 500, 1000, 5000, 10000]) AS b), x AS (SELECT b, count(*) FILTER (subscribers >= b) AS k, count(*) FILTER (subscribers >= b) / any_value(n) AS s FROM mods, a, t GROUP BY b),
u AS (SELECT unnest([0, 100, 1000, 5000, 10000, 50000]) AS lo, unnest([99, 999, 4999, 9999, 49999, NULL]) AS hi), y AS (SELECT lo, hi, count(*) FILTER (subscribers >= lo AND subscribers <= coalesce(hi, 1e18)) AS k, count(*) FILTER (subscribers >= lo AND subscribers <= coalesce(hi, 1e18)) / any_value(n) AS s FROM mods, u, t GROUP BY lo, hi)
SELECT '| >= ' || format('{{:,}}', b) || ' | ' || format('{{:,}}', k) || ' | ' || {_PCT} || ' | ' || {_BAR} || ' |' AS line FROM x
UNION ALL SELECT '| ' || format('{{:,}}', lo) || coalesce('-' || format('{{:,}}', hi), '+') || ' | ' || format('{{:,}}', k) || ' | ' || {_PCT} || ' | ' || {_BAR} || ' |' FROM y""")
def q_dashboard_file(spark: SparkSession, d: str) -> DataFrame:
    """The lines of thresholds and buckets of the dashboard of all items."""
    lines = _report(spark, "dashboard", documents.dashboard(adapter.items(spark, d), "subscribers", "Items", "all documents"))
    return lines.where(F.col("line").rlike(r"^\| (>= )?[0-9,+-]+ \|.*`")).select("line")


@query(f"""{catalogue.ORDERED}, p AS (SELECT unnest(['top', 'top', 'top', 'bottom', 'bottom']) AS side, CAST(unnest([0.01, 0.05, 0.1, 0.1, 0.2]) AS DOUBLE) AS p),
x AS (SELECT side, p, CAST(sum(v) FILTER (CASE WHEN side = 'top' THEN i ELSE a END <= greatest(1, ceil(n * p))) AS DOUBLE) / any_value(t) AS s FROM o, p GROUP BY side, p)
SELECT '| ' || side || ' ' || CAST(round(100 * p) AS INT) || ' % | ' || CASE side WHEN 'top' THEN format('{{:.2f}}%', 100 * s) ELSE format('{{:.4f}}%', 100 * s) END || ' |' AS line FROM x
UNION ALL SELECT '| Gini | ' || format('{{:.6f}}', 2.0 * sum(a * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*)) || ' |' FROM o""")
def q_inequality_file(spark: SparkSession, d: str) -> DataFrame:
    """The lines of shares and of the Gini in the report on inequality."""
    lines = _report(spark, "inequality", documents.inequality(adapter.items(spark, d), "subscribers", "lang", "Inequality", "all documents"))
    return lines.where(F.col("line").rlike(r"^\| (top|bottom) [0-9]+ % \||^\| Gini \|")).select("line")


@query(f"""{MR}, t AS (SELECT unnest([0, 1, 2, 3]) AS tier, unnest(['under 100', '100 to 1k', '1k to 10k', '10k and more']) AS name)
SELECT '| ' || any_value(name) || ' | ' || format('{{:,}}', count(ratio)) || ' | ' || coalesce(format('{{:.6f}}', avg(ratio)), 'nan') || ' | ' || coalesce(format('{{:.6f}}', median(ratio)), 'nan') || ' |' AS line FROM t LEFT JOIN ratios USING (tier) GROUP BY tier""")
def q_ratio_file(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the tiers' table in the report on ratios."""
    lines = _report(spark, "ratio", documents.ratio_report(adapter.ratios(adapter.items(spark, d)), "Ratios", "items in scope"))
    return lines.where(F.col("line").rlike(r"^\| [0-9a-z ]+ \| [0-9,]+ \| ([0-9.]+|nan) \|")).select("line")


# Page files

_TITLE = r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title"


def _page_files(spark: SparkSession, d: str, root: str, half: int | None = None) -> None:
    pages = load(spark, d, "pages")
    page_files.write_pages(pages if half is None else pages.where(F.col("page_id") % 2 == half), "page_id", "html", root)


@query("SELECT page_id AS row_id, printf('%06d.html', page_id) AS file, md5(html) AS digest FROM pages WHERE html <> ''")
def q_page_files(spark: SparkSession, d: str) -> DataFrame:
    """Pages written as a file each and read again."""
    root = f"{Scratch(spark, 'page-files').root}/html"
    _page_files(spark, d, root)
    return readers.written_pages(spark, root).select("row_id", "file", F.md5("html").alias("digest"))


@query(f"SELECT page_id, {_TITLE} FROM pages WHERE html <> ''")
def q_page_stream(spark: SparkSession, d: str) -> DataFrame:
    """Page files parsed as a stream in two runs of one query, the second reading only those that came since."""
    root = Scratch(spark, "page-stream").root
    parse = lambda p: markup.plain_page(p, "row_id", "html").select(F.col("row_id").alias("page_id"), "title")
    for half in (0, 1):
        _page_files(spark, d, f"{root}/html", half)
        page_queue.follow(spark, f"{root}/html", parse, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("page_id long, title string").parquet(f"{root}/rows")


# Figures of a load


def _sighted(spark: SparkSession, d: str) -> DataFrame:
    """List pages of five and of three documents under one tag, so that each is seen twice; every eleventh page has no items."""
    docs = load(spark, d, "documents").where("doc_id is not null")
    payload = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("title"), F.col("lang").alias("description")))
    row = F.concat(F.lit('<img class="fileRating" src="https://x.example/4-star.png?v=1"><a class="workshop_author_link" href="#">by '), F.coalesce("source", F.lit("")),
                   F.lit("</a><script>" + markup.HOVER + "(1, "), payload, F.lit(")</script>"))
    seen = docs.select("doc_id", row.alias("row"), F.explode(F.array(F.lit(5), F.lit(3))).alias("size"))
    seen = seen.select("doc_id", "row", "size", F.floor(F.col("doc_id") / F.col("size")).alias("at")).withColumn("page", F.when(F.col("size") == 5, F.col("at")).otherwise(F.col("at") + 1_000_000_000))
    page = seen.groupBy("page", "size", "at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "row"))), lambda z: z["row"]), "").alias("rows"))  # five at most
    rows = F.when(F.col("page") % 11 == 0, "").otherwise(F.col("rows"))
    html = F.concat(F.lit('<script>var paramsGET = {"requiredtags":["Trade"]};</script><div class="workshopBrowsePagingInfo">Showing '), (F.col("at") * F.col("size") + 1).cast("string"),
                    F.lit("-9 of</div><div " + markup.ITEMS_FROM + ">"), rows, F.lit("</div><div " + markup.ITEMS_TO + "></div>"))
    return page.select("page", html.alias("html"))


@query("""WITH s AS (SELECT doc_id, unnest([5, 3]) AS size FROM documents WHERE doc_id IS NOT NULL), p AS (SELECT doc_id, size, doc_id // size AS a, CASE size WHEN 5 THEN doc_id // size ELSE doc_id // size + 1000000000 END AS page FROM s),
r AS (SELECT doc_id, page, a * size + row_number() OVER (PARTITION BY page ORDER BY doc_id) AS rank FROM p), u AS (SELECT * FROM r WHERE page % 11 <> 0), o AS (SELECT doc_id, rank <> lag(rank) OVER (PARTITION BY doc_id ORDER BY page) AS c FROM u)
SELECT * FROM (SELECT count(DISTINCT page) AS files, count(DISTINCT page) FILTER (page % 11 = 0) AS skipped FROM p), (SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys FROM u), (SELECT count(*) FILTER (c) AS overwrites FROM o), (SELECT CAST(2 AS BIGINT) AS tag_columns)""")
def q_load_counters(spark: SparkSession, d: str) -> DataFrame:
    c = load_lists(_sighted(spark, d), "page", "html", "https://catalogue.example/item?id=", "No_selected_tag").counters
    return spark.createDataFrame([(c["files"], c["skipped"], c["rows"], c["keys"], c["overwrites"], c["tag_columns"])], "files long, skipped long, n_rows long, n_keys long, overwrites long, tag_columns long")


# Densities by group


@query(f"""{MR}, b AS (SELECT tier, min(ratio) AS lo, max(ratio) AS hi, count(*) AS n, stddev_samp(ratio) * pow(count(*), -0.2) AS h, avg(ratio) AS mean, median(ratio) AS median FROM ratios GROUP BY tier),
g AS (SELECT *, CAST(i AS INT) AS i, lo + i * ((hi - lo) / 39) AS x FROM b, range(40) t(i)),
e AS (SELECT tier, i, sum(exp(-0.5 * pow((x - ratio) / h, 2))) AS s FROM g JOIN ratios USING (tier) WHERE n > 1 AND h > 0 GROUP BY tier, i)
SELECT g.tier, g.i, round(x, 6) AS x, round(s / (n * h * sqrt(2 * pi())), 6) AS density, round(mean, 6) AS mean, round(median, 6) AS median, CASE WHEN s IS NOT NULL THEN true END AS within FROM g LEFT JOIN e ON g.tier = e.tier AND g.i = e.i""")
def q_tier_violins(spark: SparkSession, d: str) -> DataFrame:
    """Each tier's density with mean and median; ``within`` tells whether the binned estimate keeps its bound."""
    r = Scratch(spark, "violins").save(adapter.ratios(adapter.items(spark, d)).select("ratio", "tier"))
    exact, binned = (stats.violins(r, "ratio", ["tier"], 40, exact=e) for e in (True, False))
    both = exact.join(binned.select("tier", "i", F.col("density").alias("near"), F.col("bound").alias("most")), ["tier", "i"])
    both = both.select("tier", "i", "x", "density", (F.abs(F.col("density") - F.col("near")) <= F.col("most")).alias("within"))
    mean = r.groupBy("tier").agg(F.avg("ratio").alias("mean")).join(stats.quantiles(r, "ratio", (0.5,), ["tier"]).withColumnRenamed("p50", "median"), "tier")
    return rounded(both.join(mean, "tier"), "x", "density", "mean", "median")


# Near copies, neighbours and components

_SIMHASH = r"""t AS (SELECT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}]+')) AS term FROM documents WHERE doc_id IS NOT NULL), f AS (SELECT doc_id, CAST('0x' || substr(md5(term), 1, 15) AS BIGINT) AS b, count(*) AS tf FROM t WHERE term <> '' GROUP BY ALL),
v AS (SELECT doc_id, i, sum(CASE WHEN (b >> i) & 1 = 1 THEN tf ELSE -tf END) AS s FROM f, range(60) r(i) GROUP BY ALL), h AS (SELECT doc_id, CAST(sum(CASE WHEN s > 0 THEN CAST(1 AS BIGINT) << i ELSE 0 END) AS BIGINT) AS hash FROM v GROUP BY doc_id)"""


@query(f"WITH {_SIMHASH} SELECT doc_id, hash FROM h")
def q_simhash(spark: SparkSession, d: str) -> DataFrame:
    return corpus.simhash(load(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {_SIMHASH}, c AS (SELECT hash, min(doc_id) AS rep FROM h GROUP BY hash) SELECT x.rep AS a, y.rep AS b, CAST(bit_count(xor(x.hash, y.hash)) AS INT) AS distance FROM c x JOIN c y ON x.rep < y.rep AND bit_count(xor(x.hash, y.hash)) <= 3")
def q_near_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose hashes differ in at most three bits, one of each hash."""
    hashes = Scratch(spark, "hashes").save(corpus.simhash(load(spark, d, "documents"), "doc_id", "text"))
    return corpus.near_hashes(hashes, "doc_id")[0]


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL), s AS (SELECT q.vec_id AS query_id, c.vec_id, round(list_cosine_similarity(q.e, c.e), 9) AS cosine FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS INT) AS rank, vec_id, round(cosine, 6) AS cosine FROM s QUALIFY rank <= 5""")
def q_cosine_exact(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of every twentieth vector, from all of them."""
    e = load(spark, d, "embeddings")
    return rounded(corpus.exact_neighbours(e, e.where("vec_id % 20 = 0"), "vec_id", "embedding"), "cosine")


@query()
def q_cosine_index(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest of every fiftieth vector by the index; a test measures how many of them it finds."""
    e = load(spark, d, "embeddings")
    return rounded(corpus.CosineIndex(e, "vec_id", "embedding").search(e.where("vec_id % 50 = 0")), "cosine")


@query()
def q_term_components(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates of each text on the four largest components of its term weights; a test compares them with a plain decomposition."""
    _, x = corpus.truncated_svd(load(spark, d, "documents"), "doc_id", "text", 4)
    return x.select("doc_id", *[F.round(F.col("x")[i], 6).alias(f"x{i + 1}") for i in range(4)])
