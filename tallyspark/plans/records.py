"""Registered queries over authors, files, queues and figures, each with its SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import text
from ..operators import corpus, derive, rank_columns, relations, stats, work_queue
from ..operators.scan import row_numbers
from ..sources import markup, onefile, readers
from ..sources.staging import Scratch, mounted
from . import adapter, catalogue, report
from .adapter import load
from .catalogue import M, MF, MR, query, rounded

# Authors

_RAW_NAME = "c_mktsegment || '  &amp; ' || c_nationkey % 7 || CASE WHEN c_nationkey % 3 = 0 THEN ' 汉' ELSE '' END || ' '"


def _browse(spark, d):
    """Items as seen on list pages: (mod_id, author), some without one."""
    return load(spark, d, "documents").select(F.col("doc_id").alias("mod_id"), F.when(F.length("text") % 9 > 0, F.col("source")).alias("author"))


_BROWSE = "browse AS (SELECT doc_id AS mod_id, CASE WHEN length(text) % 9 > 0 THEN source END AS author FROM documents)"
_NAMES = "names AS (SELECT DISTINCT source AS username, CAST(length(source) = 5 AS INT) AS has_han FROM documents WHERE source IS NOT NULL)"


def _names(spark, d):
    return load(spark, d, "documents").where("source is not null").select(F.col("source").alias("username"), (F.length("source") == 5).cast("int").alias("has_han")).distinct()


@query(f"""WITH n AS (SELECT DISTINCT replace(trim(regexp_replace({_RAW_NAME}, '\\s+', ' ', 'g')), '&amp;', '&') AS username FROM customer)
SELECT username, CAST(regexp_matches(username, '[一-鿿]') AS INT) AS has_han FROM n""")
def q_authors(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.expr(f"concat({_RAW_NAME.replace(' || ', ', ').replace('c_nationkey % 7', 'cast(c_nationkey % 7 as string)')})").alias("author"))
    return relations.authors(c, "author", ["c_custkey"])


@query(f"""{MF}, {_BROWSE}, {_NAMES} SELECT m.mod_id, m.subscribers, coalesce(n.has_han, 0) AS has_han FROM mods m JOIN flags f ON f.mod_id = m.mod_id AND is_private_like = 0
LEFT JOIN browse b ON b.mod_id = m.mod_id LEFT JOIN names n ON n.username = b.author WHERE m.subscribers >= 0""")
def q_item_authors(spark, d):
    m = adapter.items(spark, d)
    return relations.with_authors(m, _browse(spark, d), _names(spark, d), adapter.flags(m), "mod_id")


@query(f"""{MF}, {_BROWSE}, {_NAMES} SELECT CASE WHEN n.has_han = 1 THEN 'domestic' ELSE 'international' END AS label, count(*) AS items, CAST(sum(m.subscribers) AS BIGINT) AS total
FROM mods m JOIN flags f ON f.mod_id = m.mod_id AND is_private_like = 0 LEFT JOIN browse b ON b.mod_id = m.mod_id LEFT JOIN names n ON n.username = b.author WHERE m.subscribers >= 0 GROUP BY 1""")
def q_author_groups(spark, d):
    return q_item_authors(spark, d).groupBy(derive.group_label(F.col("has_han")).alias("label")).agg(F.count("*").alias("items"), F.sum("subscribers").alias("total"))


@query(f"""{M}, {_BROWSE}, {_NAMES} SELECT m.mod_id, b.author, m.subscribers, row_number() OVER (ORDER BY m.subscribers DESC, m.mod_id) AS place
FROM mods m JOIN browse b ON b.mod_id = m.mod_id JOIN names n ON n.username = b.author AND n.has_han = 1""")
def q_author_ranking(spark, d):
    rows = relations.by_flagged_author(adapter.items(spark, d), _browse(spark, d), _names(spark, d), "mod_id").select("mod_id", "author", "subscribers")
    return row_numbers(rows, [F.desc("subscribers"), F.col("mod_id")], "place")


# Figures by tier and texts of figures

_PS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


@query(f"""{MR}, x AS (SELECT *, avg(ratio) OVER w AS m, stddev_samp(ratio) OVER w AS s, count(*) OVER w AS k FROM ratios WINDOW w AS (PARTITION BY tier))
SELECT tier, count(*) AS n, round(avg(ratio), 6) AS mean, round(coalesce(any_value(s), 0), 6) AS std, round(coalesce(any_value(s), 0) / avg(ratio), 6) AS cv, min(ratio) AS least, max(ratio) AS most, round(max(ratio) - min(ratio), 6) AS spread,
round(CASE WHEN any_value(k) < 3 THEN NULL WHEN any_value(s) = 0 THEN 0 ELSE avg(pow((ratio - m) / s, 3)) END, 6) AS skewness, round(CASE WHEN any_value(k) >= 4 AND any_value(s) > 0 THEN avg(pow((ratio - m) / s, 4)) - 3 END, 6) AS kurtosis,
count(*) FILTER (ratio > 1) AS above_one, count(*) FILTER (ratio = 1) AS at_one, """ + ", ".join(f"round(quantile_cont(ratio, {p}), 6) AS p{round(p * 100)}" for p in _PS)
       + ", round(quantile_cont(ratio, 0.75) - quantile_cont(ratio, 0.25), 6) AS iqr FROM x GROUP BY tier")
def q_tier_figures(spark, d):
    return rounded(report.tier_figures(adapter.ratios(adapter.items(spark, d))), "mean", "std", "cv", "spread", "skewness", "kurtosis", *[f"p{round(p * 100)}" for p in _PS], "iqr")


@query(f"""{MR}, b AS (SELECT min(ratio) - 0.02 * (max(ratio) - min(ratio)) - 1e-6 AS lo, max(ratio) + 0.02 * (max(ratio) - min(ratio)) + 1e-6 AS hi, count(*) AS n, 1.06 * stddev_samp(ratio) * pow(count(*), -0.2) AS w FROM ratios)
SELECT round(g, 6) AS x, round(sum(exp(-0.5 * pow((g - ratio) / w, 2))) / (any_value(n * w) * sqrt(2 * pi())), 6) AS density FROM (SELECT lo + i * ((hi - lo) / 399) AS g, w, n FROM b, range(400) t(i)), ratios GROUP BY g""")
def q_ratio_density(spark, d):
    return rounded(stats.kde(adapter.ratios(adapter.items(spark, d)), "ratio", 400, 0.02, 1e-6), "x", "density")


@query(f"""{MR}, b AS (SELECT min(ratio) AS lo, max(ratio) AS hi, count(*) AS n, CAST(least(60, greatest(5, round_even(sqrt(count(*)), 0))) AS INT) AS k FROM ratios),
c AS (SELECT CAST(least(floor((ratio - lo) / ((hi - lo) / k)), k - 1) AS INT) AS bin, count(*) AS c FROM ratios, b GROUP BY 1)
SELECT r.bin, round(lo + r.bin * ((hi - lo) / k), 6) AS lo, round(lo + (r.bin + 1) * ((hi - lo) / k), 6) AS hi, coalesce(c, 0) AS items, round(coalesce(c, 0) / (n * ((hi - lo) / k)), 6) AS density
FROM (SELECT CAST(unnest(range(60)) AS INT) AS bin) r LEFT JOIN c ON r.bin = c.bin, b WHERE r.bin < k""")
def q_ratio_histogram(spark, d):
    r = adapter.ratios(adapter.items(spark, d)).select("ratio")
    return rounded(stats.histogram(r, "ratio", stats.auto_bins(r.count())), "lo", "hi", "density")


@query("""WITH s AS (SELECT c_nationkey, sum(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1), x AS (SELECT ln(1 + v) AS v FROM s),
g AS (SELECT CASE WHEN count(*) < 100 THEN (sum(v) + 15.0 * (100 - count(*))) / 100 ELSE avg(v) END AS m FROM x)
SELECT rank, CASE WHEN a IS NULL THEN -1e308 ELSE round(m * a, 4) END AS cutoff FROM g, (VALUES ('super_power', 30.0), ('great_power', 5.0), ('major_power', 2.5), ('minor_power', 0.6), ('insignificant_power', NULL)) r(rank, a)""")
def q_rank_cutoffs_log(spark, d):
    """By the average of log1p values alone."""
    o, c = load(spark, d, "orders"), load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    v = o.join(c, "o_custkey").groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("v"))
    out = stats.rank_cutoffs(v, "v", transform="log1p", top_too=False)
    return out.select("rank", F.when(F.col("cutoff") == float("-inf"), -1e308).otherwise(F.round("cutoff", 4)).alias("cutoff"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal = 0 THEN '0' WHEN abs(c_acctbal) < 0.01 THEN format('{:,.6f}', c_acctbal) WHEN abs(c_acctbal) < 1 THEN format('{:,.4f}', c_acctbal) ELSE format('{:,.2f}', c_acctbal) END AS amount,
CASE WHEN c_nationkey = 0 THEN 'not computable (denominator 0)' ELSE printf('%.2f', c_nationkey / 4.0) END AS ratio, replace(c_name, '#', '') AS cell FROM customer""")
def q_figure_texts(spark, d):
    c = load(spark, d, "customer")
    ratio = F.when(F.col("c_nationkey") == 0, float("inf")).otherwise(F.col("c_nationkey") / 4)
    return c.select("c_custkey", text.amount(F.col("c_acctbal")).alias("amount"), text.ratio_text(ratio).alias("ratio"), text.cell(F.replace("c_name", F.lit("#"), F.lit("\x07"))).alias("cell"))


@query(r"""WITH c AS (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) > 32767 THEN left(t, 32764) || '...' ELSE t END AS cell FROM c""")
def q_cells(spark, d):
    """Whole texts as spreadsheet cells, whose size has a limit."""
    return load(spark, d, "documents").select("doc_id", text.cell(F.col("text")).alias("cell"))


@query("SELECT n_regionkey, string_agg(n_name || ': ' || n_nationkey, chr(10) ORDER BY n_name) AS lines FROM nation GROUP BY n_regionkey")
def q_count_lines(spark, d):
    n = load(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("count")))).alias("pairs"))
    return n.select("n_regionkey", text.count_lines(F.col("pairs")).alias("lines"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN greatest(1, event_id % 50) WHEN 1 THEN 90 ELSE greatest(1, least(120, 30 * pow(2, event_id % 5 - 1))) END::DOUBLE AS wait,
CASE WHEN event_id % 2 = 0 THEN least(1.5 * pow(2, event_id % 9 - 1), 60) + 0.5 ELSE 1.5 END::DOUBLE AS retry, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 2 END AS size FROM events""")
def q_waits(spark, d):
    e, i = load(spark, d, "events"), F.col("event_id")
    late = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    header = F.when(i % 3 == 0, (i % 50).cast("string")).when(i % 3 == 1, late).otherwise("soon")
    return e.select("event_id", text.retry_after(header, F.timestamp_seconds(F.unix_timestamp("ts") - 90), i % 5).alias("wait"), text.model_retry_delay(i % 9, 1.5, i % 2 == 0, F.lit(0.5)).alias("retry"),
                    text.json_int(F.col("props"), "$.k").alias("k"), text.json_array_size(F.when(i % 4 == 0, F.col("props")).otherwise(F.concat(F.lit("["), i.cast("string"), F.lit(", {}]")))).alias("size"))


@query("SELECT p_partkey, CAST(p_partkey AS BIGINT) * 1001 AS number, p_partkey AS file_id, p_size = 30 OR lower(p_type) LIKE '%steel%' AS listed FROM part")
def q_loose_fields(spark, d):
    p = load(spark, d, "part")
    dotted = F.translate(F.format_number(F.col("p_partkey") * 1001, 0), ",", ".")
    kinds = F.array(F.struct(F.col("p_size").alias("id"), F.lit(None).cast("string").alias("description")), F.struct(F.lit(1).alias("id"), F.col("p_type").alias("description")))
    return p.select("p_partkey", text.strict_int(dotted).alias("number"), text.file_item_id(F.concat(F.lit("mod_"), F.col("p_partkey").cast("string"), F.lit(".html"))).alias("file_id"), derive.has_category(kinds, 30, "steel").alias("listed"))


# Queue, sweeps and health


@query(catalogue.ORACLES["port_grades"].replace("SELECT port, attempts,", "SELECT grade, ports, round(100.0 * ports / sum(ports) OVER (), 6) AS pct FROM (SELECT g.grade, count(port) AS ports FROM (SELECT unnest(['A', 'B', 'C', 'F']) AS grade) g LEFT JOIN (SELECT port, attempts,", 1) + ") x ON x.grade = g.grade GROUP BY g.grade)")
def q_grade_counts(spark, d):
    return rounded(work_queue.grade_counts(catalogue.q_port_grades(spark, d)), "pct")


@query(catalogue.ORACLES["port_grades"].replace("SELECT port, attempts,", "SELECT port, grade, row_number() OVER (ORDER BY CASE grade WHEN 'F' THEN 0 WHEN 'C' THEN 1 WHEN 'B' THEN 2 ELSE 3 END, port) AS place FROM (SELECT port, attempts,", 1) + ")")
def q_worst_ports(spark, d):
    return work_queue.worst_first(catalogue.q_port_grades(spark, d).select("port", "grade"), "port")


@query(catalogue.ORACLES["breaker"].replace("SELECT port, event_id, failures,", "SELECT port, failures, CASE WHEN state = 'quarantined' AND port % 3 >= 2 THEN 'degraded' ELSE state END AS state FROM (SELECT port, event_id, failures,", 1) + ") QUALIFY row_number() OVER (PARTITION BY port ORDER BY event_id DESC) = 1")
def q_breaker_standing(spark, d):
    """Each port 0, 600 or 1200 seconds after its last attempt; a quarantine lasts 900."""
    e = load(spark, d, "events").select(F.col("user_id").alias("port"), "event_id", "ts", (F.col("event_type") == "error").alias("bad"))
    later = F.timestamp_seconds(F.col("ts").cast("timestamp").cast("double") + (F.col("port") % 3) * 600)
    return work_queue.standing(e, "port", "event_id", "ts", F.col("bad"), later, 900.0)


@query("SELECT port, longest FROM (" + catalogue.ORACLES["max_run"] + ") WHERE longest >= 2")
def q_stopped_ports(spark, d):
    """Ports with as many failures in a row as stop a run."""
    return catalogue.q_max_run(spark, d).where("longest >= 2")


@query("""WITH a AS (SELECT user_id AS page_id, event_type = 'purchase' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
m AS (SELECT page_id, max(n) AS made, min(n) FILTER (ok) AS good FROM a WHERE n <= 3 GROUP BY page_id)
SELECT p.page_id, CAST(coalesce(good, made, 0) AS INT) AS used, CASE WHEN good IS NOT NULL THEN 'filled' WHEN coalesce(made, 0) >= 3 THEN 'exhausted' ELSE 'open' END AS state FROM pages p LEFT JOIN m ON p.page_id = m.page_id""")
def q_gap_sweeps(spark, d):
    tries = load(spark, d, "events").select(F.col("user_id").alias("page_id"), F.col("event_id").alias("seq"), (F.col("event_type") == "purchase").alias("ok"))
    return work_queue.gap_sweeps(load(spark, d, "pages").select("page_id"), tries, "page_id", 3)


@query("SELECT (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS thousand, event_id FROM events")
def q_progress(spark, d):
    """Which thousand of the run each event falls into."""
    return row_numbers(load(spark, d, "events").select("event_id"), [F.col("event_id")]).select(F.floor((F.col("row") - 1) / 1000).alias("thousand"), "event_id")


@query("SELECT doc_id, quality FROM labels WHERE doc_id IN (SELECT page_id FROM pages)")
def q_checkpoint_valid(spark, d):
    done = load(spark, d, "labels").select(F.col("doc_id").alias("page_id"), "quality")
    return work_queue.valid_done(done, load(spark, d, "pages"), "page_id").withColumnRenamed("page_id", "doc_id")


@query("SELECT doc_id, CAST(quality AS INT) AS quality FROM labels")
def q_checkpoint_files(spark, d):
    """A checkpoint written and read again."""
    path = f"{Scratch(spark, 'checkpoint').root}/done"
    work_queue.write_checkpoint(load(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality", path)
    return spark.read.schema("doc_id long, quality int").json(path)


# Pages and files


@query("""SELECT CAST(77 AS BIGINT) AS app_id, (SELECT count(*) FROM part) AS items, p_brand AS name, count(*) AS count FROM part GROUP BY p_brand""")
def q_hub_page(spark, d):
    return markup.hub_row(catalogue.hub_page(spark, d), "html", "url").select("app_id", "items", F.inline("tags"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Trade' WHEN 1 THEN 'No_selected_tag' END AS tag, p_partkey % 3 = 1 AS unfiltered, CASE WHEN p_size > 9 THEN CAST(p_size AS VARCHAR) END AS item_id FROM part""")
def q_page_kinds(spark, d):
    p, k = load(spark, d, "part"), F.col("p_partkey") % 3
    page = F.when(k == 0, 'var paramsGET = {"requiredtags":["Trade"]};').when(k == 1, 'var paramsGET = {"requiredtags":[]};').otherwise("<p>")
    page = F.concat(page, F.when(F.col("p_size") > 9, F.concat(F.lit("var publishedfileid = '"), F.col("p_size").cast("string"), F.lit("';"))).otherwise(""))
    return p.select("p_partkey", markup.page_tag(page).alias("tag"), markup.unfiltered(page).alias("unfiltered"), markup.item_id(page).alias("item_id"))


@query(catalogue.ORACLES["page_urls"].replace("SELECT tag, CAST(p AS INT)", "SELECT dense_rank() OVER (ORDER BY tag NULLS LAST) * 10000 + page AS place, tag, page, url FROM (SELECT tag, CAST(p AS INT)", 1)
       + " UNION ALL SELECT NULL, CAST(p AS INT), 'https://catalogue.example/browse?p=' || p FROM (SELECT count(*) AS c FROM part), range(1, 1668) t(p) WHERE p <= least(1667, ceil(c / 30.0)))")
def q_all_page_urls(spark, d):
    """The urls of all brands in order, then those of pages without one."""
    brands = row_numbers(load(spark, d, "part").groupBy(F.col("p_brand").alias("tag")).agg(F.count("*").alias("c")), [F.col("tag")], "place")
    out = relations.all_page_urls(brands.withColumn("place", F.col("place").cast("long")), "tag", "c", load(spark, d, "part").agg(F.count("*").alias("items")), "items", "https://catalogue.example/browse")
    last = brands.agg(F.max("place").alias("_n")).withColumn("_k", F.lit(1))
    out = out.withColumn("_k", F.lit(1)).join(F.broadcast(last), "_k")
    return out.select((F.least(F.col("place.place"), F.col("_n") + 1) * 10000 + F.col("page")).cast("long").alias("place"), "tag", "page", "url")


@query("""WITH f AS (SELECT user_id AS row_id, 'f' || event_id AS file, event_id % 3 AS size, ts AS modified FROM events)
SELECT file, modified FROM f WHERE size > 0 ORDER BY CASE WHEN row_id BETWEEN 1 AND 9 THEN row_id ELSE 10 END, CASE WHEN row_id BETWEEN 1 AND 9 THEN NULL ELSE modified END, file LIMIT 1""")
def q_created_time(spark, d):
    e = load(spark, d, "events")
    return derive.created_time(e.select(F.col("user_id").alias("row_id"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("file"), (F.col("event_id") % 3).alias("size"), F.col("ts").alias("modified")))


@query("SELECT CAST(p_retailprice AS DOUBLE) AS value FROM part UNION ALL SELECT CAST(s_acctbal AS DOUBLE) FROM supplier")
def q_series_files(spark, d):
    """A number series written as lines and as cells, and read again."""
    root = Scratch(spark, "series").root
    load(spark, d, "part").select(F.col("p_retailprice").cast("string")).write.text(f"{root}/a.txt")
    load(spark, d, "supplier").select("s_name", "s_acctbal").write.csv(f"{root}/b.csv")
    return readers.series(spark, f"{root}/a.txt").unionByName(readers.series(spark, f"{root}/b.csv"))


@query("SELECT row_number() OVER (ORDER BY n_nationkey) AS row_id, 'https://x.example/' || n_nationkey AS url FROM nation")
def q_url_files(spark, d):
    """A list of urls written as one JSON array and read again."""
    path = f"{Scratch(spark, 'urls').root}/urls"
    urls = load(spark, d, "nation").agg(F.to_json(F.transform(F.array_sort(F.collect_list("n_nationkey")), lambda n: F.concat(F.lit("https://x.example/"), n.cast("string")))).alias("value"))  # 25 rows
    urls.coalesce(1).write.text(path)
    return readers.url_list(spark, path).select(F.col("row_id").cast("long").alias("row_id"), "url")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, 'https://x.example/?id=' || n_nationkey AS url FROM nation")
def q_id_files(spark, d):
    path = f"{Scratch(spark, 'ids').root}/ids"
    ids = load(spark, d, "nation").agg(F.concat_ws(",", F.collect_list(F.concat(F.lit('"'), F.col("n_nationkey").cast("string"), F.lit('"')))).alias("v"))  # 25 rows
    ids.select(F.concat(F.lit('{"ids": ["no", '), "v", F.lit("]}")).alias("value")).coalesce(1).write.text(path)
    return readers.id_list(spark, path, "https://x.example/?id=")


@query("SELECT n_name AS author, r_name AS mod_titles FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_record_files(spark, d):
    """Records of an author and titles in one JSON array, written and read again."""
    path = f"{Scratch(spark, 'records').root}/records.json"
    os.makedirs(os.path.dirname(mounted(path)))
    n = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.select("n_nationkey", F.struct(F.col("n_name").alias("author"), F.array("r_name").alias("mod_titles")).alias("r"))
    onefile.write_json_list(n, "r", path, ["n_nationkey"])
    return readers.author_items(spark, path).select("author", F.array_join("mod_titles", "|").alias("mod_titles"))


@query("SELECT CAST(77 AS INT) AS APPID, CAST(count(*) AS INT) AS workshop_item_count, CAST(count(DISTINCT p_brand) AS INT) AS tag_count FROM part")
def q_hub_snapshot(spark, d):
    """A hub's figures written as one JSON object and read again."""
    path = f"{Scratch(spark, 'hub').root}/hub"
    p = load(spark, d, "part").agg(F.count("*").alias("workshop_item_count"), F.count_distinct("p_brand").alias("tag_count"))
    p.select(F.lit(77).alias("APPID"), F.array(F.struct(F.lit("x").alias("name"), F.lit(1).alias("count"))).alias("tags"), "tag_count", "workshop_item_count", F.lit("u").alias("source_url")).coalesce(1).write.json(path)
    return readers.hub_snapshot(spark, path).select("APPID", "workshop_item_count", "tag_count")


@query(f"{MR} SELECT mod_id, ratio, tier FROM ratios")
def q_tier_files(spark, d):
    """Ratio rows written by tier and read again."""
    path = f"{Scratch(spark, 'tiers').root}/tiers"
    report.write_tiers(adapter.ratios(adapter.items(spark, d)), path)
    return spark.read.parquet(path).select("mod_id", "ratio", F.col("tier").cast("int").alias("tier"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_csv_files(spark, d):
    path = f"{Scratch(spark, 'csv').root}/customer"
    report.write_csv(load(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), path)
    return spark.read.option("header", True).schema("c_custkey long, c_name string, c_nationkey int").csv(path)


@query("SELECT replace(p_brand, '#', '_') AS column FROM part GROUP BY p_brand HAVING count(*) FILTER (p_size < 3) = 0")
def q_missing_columns(spark, d):
    """Rank columns that all parts would need and a table made of the smallest parts lacks."""
    p = load(spark, d, "part")
    p.where("p_size < 3").groupBy("p_partkey").pivot("p_brand").agg(F.first("p_size")).transform(lambda t: t.toDF(*[c.replace("#", "_") for c in t.columns])).createOrReplaceTempView("catalogue_ranks")
    needed = [r["name"] for r in rank_columns.column_order(p, "p_brand", ["p_partkey"]).collect()]  # one a brand
    return relations.missing_columns(spark, {"catalogue_ranks": needed}).select("column")


@query("SELECT c_acctbal AS value FROM customer WHERE c_custkey % 3 <> 0")
def q_column_values(spark, d):
    """A column of a table, without its nulls."""
    c = F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("value")
    load(spark, d, "customer").select(c).createOrReplaceTempView("catalogue_balances")
    return readers.column_values(spark, "catalogue_balances", "value")


@query("""SELECT user_id, event_type AS described_in, rank FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank, event_id) = 1""")
def q_best_description(spark, d):
    """Where each user stands best, which is what its description is taken from."""
    s = catalogue._seen(spark, d)
    return relations.first_wins(s, ["user_id"], ["rank", "event_id"], ["event_type", "rank"]).select("user_id", F.col("event_type").alias("described_in"), "rank")


@query("SELECT n_nationkey, n_name FROM nation")
def q_required_table(spark, d):
    load(spark, d, "nation").createOrReplaceTempView("catalogue_nation")
    return readers.required_table(spark, "catalogue_nation", ["n_nationkey", "n_name"]).select("n_nationkey", "n_name")


@query("""WITH p AS (SELECT user_id, min(r) AS best FROM (SELECT user_id, event_type, arg_max(rank, event_id) AS r FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events) GROUP BY 1, 2) GROUP BY 1)
SELECT user_id, row_number() OVER (ORDER BY best, CAST(user_id AS VARCHAR)) AS place FROM p""")
def q_best_rank_order(spark, d):
    return row_numbers(catalogue.q_best_rank(spark, d), [F.col("best_rank"), F.col("user_id").cast("string")], "place").select("user_id", "place")


# Corpus map


@query(r"""SELECT doc_id, concat_ws(chr(10) || chr(10), nullif(trim(source), ''), nullif(trim(text), ''), CASE WHEN doc_id % 2 = 0 THEN 'Requires: ' || lang || ', base' END) AS text FROM documents""")
def q_corpus_view(spark, d):
    needs = F.when(F.col("doc_id") % 2 == 0, F.array("lang", F.lit("base"))).otherwise(F.array().cast("array<string>"))
    return derive.corpus_view(load(spark, d, "documents").withColumn("needs", needs), "doc_id", "source", "text", "needs")


@query(r"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS term FROM documents), t AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term), x AS (SELECT doc_id, term, tf, df, tf * ln((1.0 + (SELECT count(DISTINCT doc_id) FROM documents)) / (1.0 + df)) AS weight FROM t JOIN f USING (term))
SELECT doc_id, term, tf, df, round(weight, 6) AS weight FROM x QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) <= 10""")
def q_top_terms(spark, d):
    """The ten weightiest terms of each text."""
    return rounded(corpus.top_terms(load(spark, d, "documents"), "doc_id", "text", 10), "weight")


@query()
def q_corpus_layout(spark, d):
    """Two coordinates a text: the first principal components of its term weights."""
    return rounded(corpus.layout(load(spark, d, "documents"), "doc_id", "text"), "x", "y")
