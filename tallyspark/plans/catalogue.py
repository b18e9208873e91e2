"""The registered queries over the driver tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import derive, relations, stats, work_queue
from ..operators.scan import running_totals
from ..sources import markup
from . import adapter, report
from .adapter import FLAGS_SQL, ITEMS_SQL, RATIOS_SQL, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        name = f.__name__.removeprefix("q_")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in cols})


M = f"WITH {ITEMS_SQL}"
MF = f"{M}, {FLAGS_SQL}"
MR = f"{MF}, {RATIOS_SQL}"
#: (v, n, t, i): values descending with their rank; ascending as `a`.
ORDERED = f"""{M}, o AS (SELECT subscribers AS v, row_number() OVER (ORDER BY subscribers DESC) AS i, row_number() OVER (ORDER BY subscribers) AS a,
  count(*) OVER () AS n, sum(subscribers) OVER () AS t, sum(subscribers) OVER (ORDER BY subscribers DESC ROWS UNBOUNDED PRECEDING) AS s FROM mods)"""


# Summaries of one measure

@query("SELECT lang, count(n_chars) AS n, CAST(sum(n_chars) AS BIGINT) AS total, round(avg(n_chars), 6) AS mean, round(median(n_chars), 6) AS median, "
       "round(stddev_pop(n_chars), 6) AS std, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY lang")
def q_overview(spark, d):
    return rounded(stats.overview(load(spark, d, "documents"), "n_chars", ["lang"]), "mean", "median", "std")


@query("SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS p{round(p * 100)}" for p in stats.PERCENTS) + " FROM lineitem GROUP BY l_returnflag")
def q_percentiles_by_group(spark, d):
    return rounded(stats.percentiles(load(spark, d, "lineitem"), "l_extendedprice", group_cols=["l_returnflag"]), *[f"p{round(p * 100)}" for p in stats.PERCENTS])


@query("""WITH x AS (SELECT o_orderpriority, o_totalprice AS v, avg(o_totalprice) OVER w AS m, stddev_samp(o_totalprice) OVER w AS s FROM orders WINDOW w AS (PARTITION BY o_orderpriority))
SELECT o_orderpriority, count(*) AS n, round(any_value(m), 6) AS mean, round(any_value(s), 6) AS std, round(any_value(s / m), 6) AS cv,
round(avg(pow((v - m) / s, 3)), 6) AS skewness, round(avg(pow((v - m) / s, 4)) - 3, 6) AS kurtosis FROM x GROUP BY o_orderpriority""")
def q_shape_moments(spark, d):
    return rounded(stats.moments(load(spark, d, "orders"), "o_totalprice", ["o_orderpriority"]), "mean", "std", "cv", "skewness", "kurtosis")


_GINI = "round(2.0 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*), 6) AS gini"


@query(f"WITH x AS (SELECT n_chars AS v, row_number() OVER (ORDER BY n_chars) AS i FROM documents) SELECT {_GINI} FROM x")
def q_gini(spark, d):
    return rounded(stats.gini(load(spark, d, "documents"), "n_chars"), "gini")


@query(f"WITH x AS (SELECT o_orderpriority, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS i FROM orders) SELECT o_orderpriority, {_GINI} FROM x GROUP BY o_orderpriority")
def q_gini_by_group(spark, d):
    return rounded(stats.gini(load(spark, d, "orders"), "o_totalprice", ["o_orderpriority"]), "gini")


def _spend(spark, d):
    o, c = load(spark, d, "orders"), load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent")).join(c, "o_custkey")


_SPEND = "spend AS (SELECT o_custkey, any_value(c_mktsegment) AS c_mktsegment, any_value(c_nationkey) AS c_nationkey, sum(o_totalprice) AS spent FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey)"


@query(f"WITH {_SPEND} SELECT c_mktsegment, round(sum(spent * spent) / pow(sum(spent), 2), 9) AS hhi FROM spend GROUP BY c_mktsegment")
def q_hhi_by_group(spark, d):
    return rounded(stats.hhi(_spend(spark, d), "spent", ["c_mktsegment"]), "hhi", places=9)


@query(f"""{ORDERED}, k AS (SELECT unnest(['top_10', 'top_50', 'top_100', 'top_1pct', 'top_5pct', 'top_10pct']) AS key,
  unnest([10, 50, 100, greatest(1, round_even(n * CAST(0.01 AS DOUBLE), 0)), greatest(1, round_even(n * CAST(0.05 AS DOUBLE), 0)), greatest(1, round_even(n * CAST(0.1 AS DOUBLE), 0))]) AS c FROM (SELECT any_value(n) AS n FROM o))
SELECT key, CAST(least(c, any_value(n)) AS BIGINT) AS count, round(least(c, any_value(n)) / any_value(n), 6) AS share_items,
CAST(sum(v) FILTER (i <= c) AS BIGINT) AS sum, round(sum(v) FILTER (i <= c) / any_value(t), 6) AS share_total FROM o, k GROUP BY key, c""")
def q_top_concentration(spark, d):
    return rounded(stats.top_concentration(adapter.items(spark, d), "subscribers"), "share_items", "share_total")


@query(f"""{ORDERED} SELECT target, min(i) AS needed, round(CAST(min(i) AS DOUBLE) / any_value(n), 6) AS share FROM o, (SELECT CAST(unnest([0.5, 0.8, 0.9]) AS DOUBLE) AS target)
WHERE CAST(s AS DOUBLE) / t >= target - 1e-12 GROUP BY target""")
def q_pareto(spark, d):
    return rounded(stats.pareto(adapter.items(spark, d), "subscribers"), "share")


@query(f"""{ORDERED}, p AS (SELECT unnest(['top', 'top', 'top', 'bottom', 'bottom', 'bottom']) AS side, CAST(unnest([0.01, 0.05, 0.1, 0.1, 0.2, 0.4]) AS DOUBLE) AS p)
SELECT side, p, round(CAST(sum(v) FILTER (CASE WHEN side = 'top' THEN i ELSE a END <= greatest(1, ceil(n * p))) AS DOUBLE) / any_value(t), 6) AS share FROM o, p GROUP BY side, p""")
def q_top_bottom_share(spark, d):
    return rounded(stats.end_shares(adapter.items(spark, d), "subscribers"), "share")


@query(f"""{ORDERED} SELECT round(quantile_cont(v, 0.9) / quantile_cont(v, 0.1), 6) AS p90_p10, round(quantile_cont(v, 0.99) / quantile_cont(v, 0.01), 6) AS p99_p1,
round(CAST(sum(v) FILTER (i <= greatest(1, ceil(n * CAST(0.1 AS DOUBLE)))) AS DOUBLE) / sum(v) FILTER (a <= greatest(1, ceil(n * CAST(0.4 AS DOUBLE)))), 6) AS palma FROM o""")
def q_quantile_ratios(spark, d):
    return rounded(stats.quantile_ratios(adapter.items(spark, d), "subscribers"), "p90_p10", "p99_p1", "palma")


@query(f"""{M}, g AS (SELECT subscribers AS v, count(*) AS c FROM mods GROUP BY 1), x AS (SELECT sum(c) OVER w AS c, sum(v * c) OVER w AS s, sum(c) OVER () AS n, sum(v * c) OVER () AS t FROM g WINDOW w AS (ORDER BY v))
SELECT round(CAST(c AS DOUBLE) / n, 9) AS x, round(CAST(s AS DOUBLE) / t, 9) AS y FROM x UNION ALL SELECT 0.0, 0.0""")
def q_lorenz(spark, d):
    return rounded(stats.lorenz(adapter.items(spark, d), "subscribers"), "x", "y", places=9)


def _dagum_sql(reference: bool) -> str:
    scale = "2 * (SELECT m FROM t)" if reference else "(a.m + b.m)"
    rest = "gini - within - net - trans"
    extra = f" + CASE WHEN abs({rest}) > 1e-6 THEN {rest} ELSE 0 END" if reference else ""
    return f"""WITH x AS (SELECT lang AS g, CAST(n_chars AS DOUBLE) AS v, row_number() OVER (ORDER BY n_chars) AS i, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS j FROM documents WHERE lang IS NOT NULL),
t AS (SELECT count(*) AS n, avg(v) AS m, 2 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*) AS gini FROM x),
s AS (SELECT g, count(*) AS n, avg(v) AS m, 2 * sum(j * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*) AS gini, count(*) / (SELECT n FROM t) AS p, count(*) * avg(v) / ((SELECT n FROM t) * (SELECT m FROM t)) AS s FROM x GROUP BY g),
d AS (SELECT a.g AS h, b.g AS k, avg(greatest(y.v - x.v, 0)) AS up, avg(greatest(x.v - y.v, 0)) AS dn FROM s a JOIN s b ON a.m < b.m OR (a.m = b.m AND a.g < b.g) JOIN x ON x.g = a.g JOIN x y ON y.g = b.g GROUP BY 1, 2),
q AS (SELECT (up + dn) / ({scale}) AS g, CASE WHEN up + dn > 0 THEN (up - dn) / (up + dn) ELSE 0 END AS e, b.p * a.s + a.p * b.s AS w FROM d JOIN s a ON a.g = h JOIN s b ON b.g = k),
r AS (SELECT (SELECT gini FROM t) AS gini, (SELECT sum(gini * p * s) FROM s) AS within, sum(g * w * e) AS net, sum(g * w * (1 - e)) AS trans FROM q)
SELECT round(gini, 6) AS gini, round(within, 6) AS within, round(net, 6) AS net, round(trans{extra}, 6) AS transvariation FROM r"""


@query(_dagum_sql(True))
def q_dagum(spark, d):
    return rounded(stats.dagum(load(spark, d, "documents"), "n_chars", "lang"), "gini", "within", "net", "transvariation")


@query(_dagum_sql(False))
def q_dagum_textbook(spark, d):
    return rounded(stats.dagum(load(spark, d, "documents"), "n_chars", "lang", "textbook"), "gini", "within", "net", "transvariation")


@query(f"{M} SELECT threshold, count(*) FILTER (subscribers >= threshold) AS items, round(count(*) FILTER (subscribers >= threshold) / count(*), 6) AS share FROM mods, (SELECT unnest([100, 500, 1000, 5000, 10000]) AS threshold) GROUP BY threshold")
def q_thresholds(spark, d):
    return rounded(stats.thresholds(adapter.items(spark, d), "subscribers"), "share")


@query(f"""{M}, b(lo, hi, bucket) AS (VALUES (0, 99, '0_99'), (100, 999, '100_999'), (1000, 4999, '1000_4999'), (5000, 9999, '5000_9999'), (10000, 49999, '10000_49999'), (50000, 9000000000, '50000_plus'))
SELECT bucket, count(*) FILTER (subscribers BETWEEN lo AND hi) AS items, round(count(*) FILTER (subscribers BETWEEN lo AND hi) / count(*), 6) AS share FROM mods, b GROUP BY bucket""")
def q_buckets(spark, d):
    return rounded(stats.buckets(adapter.items(spark, d), "subscribers"), "share")


@query(f"""{M}, x AS (SELECT log10(subscribers + 1) AS v FROM mods), b AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM x),
c AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS c FROM x, b GROUP BY 1)
SELECT r.bin, round(lo + r.bin * ((hi - lo) / 50), 6) AS lo, round(lo + (r.bin + 1) * ((hi - lo) / 50), 6) AS hi, coalesce(c, 0) AS items, round(coalesce(c, 0) / (n * ((hi - lo) / 50)), 6) AS density
FROM (SELECT CAST(unnest(range(50)) AS INT) AS bin) r LEFT JOIN c ON r.bin = c.bin, b""")
def q_histogram(spark, d):
    m = adapter.items(spark, d).select(F.log10(F.col("subscribers") + 1).alias("v"))
    return rounded(stats.histogram(m, "v"), "lo", "hi", "density")


@query(f"""{M}, x AS (SELECT log10(subscribers + 1) AS v FROM mods), b AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, 1.06 * stddev_samp(v) * pow(count(*), -0.2) AS w FROM x)
SELECT round(g, 6) AS x, round(sum(exp(-0.5 * pow((g - v) / w, 2))) / (any_value(n * w) * sqrt(2 * pi())), 6) AS density FROM (SELECT lo + i * ((hi - lo) / 199) AS g, w, n FROM b, range(200) t(i)), x GROUP BY g""")
def q_kde(spark, d):
    m = adapter.items(spark, d).select(F.log10(F.col("subscribers") + 1).alias("v"))
    return rounded(stats.kde(m, "v"), "x", "density")


@query(f"""{MR}, q AS (SELECT tier, quantile_cont(ratio, 0.25) AS q1, quantile_cont(ratio, 0.5) AS median, quantile_cont(ratio, 0.75) AS q3 FROM ratios GROUP BY tier)
SELECT tier, count(*) AS n, round(avg(ratio), 6) AS mean, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
min(ratio) FILTER (ratio BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_lo, max(ratio) FILTER (ratio BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_hi,
count(*) FILTER (NOT (ratio BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers FROM ratios JOIN q USING (tier) GROUP BY tier""")
def q_box_stats(spark, d):
    return rounded(stats.box_stats(adapter.ratios(adapter.items(spark, d)), "ratio", ["tier"]), "mean", "q1", "median", "q3")


def _rules(extra: str) -> str:
    return f"""WITH {_SPEND}, {extra}, s AS (SELECT count(*) AS n, sum(v) AS t, max(v) AS top FROM x), g AS (SELECT CASE WHEN n < 100 THEN (t + 15.0 * (100 - n)) / 100 ELSE t / n END AS m, top FROM s)
SELECT rank, CASE WHEN a IS NULL THEN -1e308 ELSE round(greatest(m * a, top * b), 4) END AS cutoff FROM g, (VALUES ('super_power', 30.0, 0.98), ('great_power', 5.0, 0.75), ('major_power', 2.5, 0.5), ('minor_power', 0.6, 0.15), ('insignificant_power', NULL, NULL)) r(rank, a, b)"""


def _cutoffs(df):
    return stats.rank_cutoffs(df, "v").select("rank", F.when(F.col("cutoff") == float("-inf"), -1e308).otherwise(F.round("cutoff", 4)).alias("cutoff"))


@query(_rules("x AS (SELECT c_nationkey, sum(spent) AS v FROM spend GROUP BY 1)"))
def q_rank_cutoffs(spark, d):
    return _cutoffs(_spend(spark, d).groupBy("c_nationkey").agg(F.sum("spent").alias("v")))


@query(_rules("x AS (SELECT spent AS v FROM spend)"))
def q_rank_cutoffs_customers(spark, d):
    return _cutoffs(_spend(spark, d).select(F.col("spent").alias("v")))


# Derived tables

@query(f"{MF} SELECT mod_id, is_private_like FROM flags")
def q_private_flags(spark, d):
    return adapter.flags(adapter.items(spark, d))


@query(f"{MR} SELECT mod_id, mod_name, subscribers, ratio, tier FROM ratios")
def q_ratio(spark, d):
    return adapter.ratios(adapter.items(spark, d))


@query(f"""{MR} SELECT CAST(t AS INT) AS tier, count(ratio) AS n, round(avg(ratio), 6) AS mean, round(median(ratio), 6) AS median FROM range(4) r(t) LEFT JOIN ratios ON tier = t GROUP BY t""")
def q_ratio_tiers(spark, d):
    return rounded(report.ratio_tiers(adapter.ratios(adapter.items(spark, d))), "mean", "median")


_DESC = ["mean", "std", "cv", "spread", "skewness", "kurtosis", "p1", "p5", "p10", "p25", "p50", "p75", "p90", "p95", "p99", "iqr"]


@query(f"""{MR}, x AS (SELECT *, avg(ratio) OVER () AS m, stddev_samp(ratio) OVER () AS s FROM ratios)
SELECT count(*) AS n, round(avg(ratio), 6) AS mean, round(any_value(s), 6) AS std, round(any_value(s / m), 6) AS cv, min(ratio) AS least, max(ratio) AS most, round(max(ratio) - min(ratio), 6) AS spread,
round(avg(pow((ratio - m) / s, 3)), 6) AS skewness, round(avg(pow((ratio - m) / s, 4)) - 3, 6) AS kurtosis, count(*) FILTER (ratio > 1) AS above_one, count(*) FILTER (ratio = 1) AS at_one, """
       + ", ".join(f"round(quantile_cont(ratio, {p}), 6) AS p{round(p * 100)}" for p in (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) + ", round(quantile_cont(ratio, 0.75) - quantile_cont(ratio, 0.25), 6) AS iqr FROM x")
def q_ratio_descriptive(spark, d):
    return rounded(stats.descriptive(adapter.ratios(adapter.items(spark, d)), "ratio"), *_DESC)


@query(f"{MF} SELECT count(*) AS items, count(*) FILTER (is_private_like = 1) AS private_like, count(*) FILTER (is_private_like = 0) AS in_scope FROM flags")
def q_scope_counts(spark, d):
    f = F.col("is_private_like")
    return adapter.flags(adapter.items(spark, d)).agg(F.count("*").alias("items"), F.count_if(f == 1).alias("private_like"), F.count_if(f == 0).alias("in_scope"))


@query(f"""WITH {_SPEND}, a AS (SELECT *, rank() OVER (ORDER BY round(spent, 2) DESC) AS rank_all FROM spend)
SELECT o_custkey, round(spent, 2) AS spent, rank_all, rank() OVER (ORDER BY round(spent, 2) DESC) AS rank_subset FROM a WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""")
def q_rank_all_vs_subset(spark, d):
    asia = load(spark, d, "nation").join(load(spark, d, "region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    s = _spend(spark, d).withColumn("spent", F.round("spent", 2))
    return relations.ranked_subset(s, s.join(asia, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"), "o_custkey", "spent")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS position FROM part")
def q_popularity_position(spark, d):
    return relations.positions(load(spark, d, "part"), "p_partkey", "p_retailprice")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_anti_gap(spark, d):
    return relations.missing_in(load(spark, d, "documents"), load(spark, d, "labels"), "doc_id").select("doc_id")


_COVERAGE = """c AS (SELECT coalesce(p.page_id, l.doc_id) AS page_id, CASE WHEN p.page_id IS NULL THEN 'extra' WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 1 THEN 'ok' ELSE 'invalid' END AS status
FROM pages p FULL JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON p.page_id = l.doc_id)"""


@query(f"WITH {_COVERAGE} SELECT page_id, status FROM c")
def q_coverage(spark, d):
    """Pages against labels: which are labelled, well or badly, which aren't, and labels of no page."""
    there = load(spark, d, "labels").select(F.col("doc_id").alias("page_id"), "quality")
    return relations.coverage(load(spark, d, "pages"), there, "page_id", F.col("quality") == 1)


_SEEN = "seen AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events)"


def _seen(spark, d):
    e = running_totals(load(spark, d, "events").select("user_id", "event_type", "event_id"), "event_id", {"c": F.lit(1)}, ["event_type"])
    return e.select("user_id", "event_type", "event_id", (F.col("c_before") + 1).cast("long").alias("rank"))


@query(f"WITH {_SEEN} SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM seen GROUP BY user_id")
def q_first_last_wins(spark, d):
    s = load(spark, d, "events")
    a = relations.first_wins(s, ["user_id"], ["event_id"], ["event_type"]).withColumnRenamed("event_type", "first_type")
    return a.join(relations.last_wins(s, ["user_id"], ["event_id"], ["event_type"]).withColumnRenamed("event_type", "last_type"), "user_id")


_TYPES = ("click", "error", "purchase", "signup", "view")


@query(f"WITH {_SEEN} SELECT user_id, " + ", ".join(f"arg_max(rank, event_id) FILTER (event_type = '{t}') AS {t}" for t in _TYPES) + " FROM seen GROUP BY user_id")
def q_rank_pivot(spark, d):
    return relations.rank_pivot(_seen(spark, d), "user_id", "event_type", "rank", ["event_id"], list(_TYPES))


@query(f"WITH {_SEEN}, x AS (SELECT user_id, rank <> lag(rank) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS c FROM seen) SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, count(*) FILTER (c) AS overwrites FROM x")
def q_rank_overwrites(spark, d):
    return relations.rank_overwrites(_seen(spark, d), "user_id", "event_type", "rank", ["event_id"])


@query(f"WITH {_SEEN}, p AS (SELECT user_id, event_type, arg_max(rank, event_id) AS r FROM seen GROUP BY 1, 2) SELECT user_id, min(r) AS best_rank FROM p GROUP BY user_id")
def q_best_rank(spark, d):
    return relations.best_rank(q_rank_pivot(spark, d), "user_id", list(_TYPES))


@query("SELECT user_id, " + ", ".join(f"CAST(max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS INT) AS has_{t}" for t in _TYPES) + " FROM events GROUP BY user_id")
def q_tag_flags(spark, d):
    tags = load(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("tags"))
    return derive.tag_flags(tags, "user_id", "tags", _TYPES)


@query("SELECT o_orderstatus, count(*) AS items, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM orders GROUP BY o_orderstatus")
def q_status_counts(spark, d):
    return rounded(relations.shares_by(load(spark, d, "orders"), "o_orderstatus"), "pct")


@query("""WITH b AS (SELECT p_brand AS tag, count(*) AS c FROM part GROUP BY 1) SELECT tag, CAST(p AS INT) AS page, 'https://catalogue.example/browse?p=' || p || '&requiredtags%5B%5D=' || replace(tag, '#', '%23') AS url
FROM b, range(1, 1668) t(p) WHERE p <= least(1667, ceil(c / 30.0))""")
def q_page_urls(spark, d):
    brands = load(spark, d, "part").groupBy(F.col("p_brand").alias("tag")).agg(F.count("*").alias("c"))
    return relations.page_urls(brands, "tag", "c", "https://catalogue.example/browse")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def q_key_violations(spark, d):
    return relations.key_violations(load(spark, d, "orders"), ["o_custkey"])


@query("SELECT 'discount' AS check, count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.05)) AS violations FROM lineitem UNION ALL SELECT 'flag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem")
def q_check_violations(spark, d):
    return relations.check_violations(load(spark, d, "lineitem"), {"discount": F.col("l_discount").between(0, 0.05), "flag": F.col("l_returnflag").isin("A", "N")})


@query("SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, coalesce(l.quality, CAST(d.n_chars % 2 AS INT)) AS quality FROM labels l FULL JOIN documents d USING (doc_id)")
def q_detail_or_list(spark, d):
    docs = load(spark, d, "documents").select("doc_id", (F.col("n_chars") % 2).cast("int").alias("quality"))
    return relations.prefer(load(spark, d, "labels"), docs, "doc_id", ["quality"])


# Text and numbers

@query(r"""SELECT c_custkey, CAST(replace(replace(printf('%,d', CAST(floor(abs(c_acctbal)) AS BIGINT)), ',', ''), ' ', '') AS INT) AS loose, lower(regexp_replace(c_mktsegment, '\W+', '_', 'g')) AS slug,
CASE WHEN length(c_name) > 8 THEN left(c_name, 8) || '...' ELSE c_name END AS short, CASE WHEN regexp_matches(c_name, '[一-鿿]') THEN 1 ELSE 0 END AS han, c_name AS author FROM customer""")
def q_text_functions(spark, d):
    c = load(spark, d, "customer")
    return c.select("c_custkey", text.loose_int(F.format_number(F.floor(F.abs("c_acctbal")), 0)).alias("loose"), F.lower(text.slug(F.col("c_mktsegment"))).alias("slug"),
                    text.shorten(F.col("c_name"), 8).alias("short"), text.has_han(F.col("c_name")).alias("han"), text.author_name(F.concat(F.lit("By  "), "c_name")).alias("author"))


@query("""SELECT event_id, least(60.0, greatest(2.0, 2.0 * pow(2, event_id % 8))) AS transport, least(120.0, 30.0 * pow(2, event_id % 5 - 1)) AS limited, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp,
CASE WHEN event_id % 10 > 0 THEN 100.0 * (event_id % 3) / (event_id % 10) ELSE 0 END AS pct FROM events""")
def q_backoff(spark, d):
    e, i = load(spark, d, "events"), F.col("event_id")
    return e.select("event_id", text.transport_backoff(i % 8).alias("transport"), text.limit_backoff(i % 5).alias("limited"), text.local_stamp(F.col("ts")).alias("stamp"), text.percent_of(i % 3, i % 10).alias("pct"))


@query("""WITH t AS (SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_name END AS s FROM customer), k AS (SELECT c_nationkey, list(left(s, 10) ORDER BY c_custkey) FILTER (trim(s) <> '') AS l, count(*) AS n FROM t GROUP BY 1)
SELECT c_nationkey, array_to_string(list_slice(l, 1, 12), '|') AS titles, n FROM k""")
def q_compact_items(spark, d):
    c = load(spark, d, "customer").select("c_nationkey", "c_custkey", F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_name")).alias("s"))
    g = c.groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "s"))), lambda z: z["s"]).alias("l"))
    return g.select("c_nationkey", F.array_join(derive.compact_titles(F.col("l"), chars=10), "|").alias("titles"), F.size("l").cast("long").alias("n"))


@query("SELECT p_brand, CASE WHEN p_brand LIKE '%1' THEN 'Economy and Buildings' WHEN p_brand LIKE '%2' THEN 'Military' END AS tag FROM (SELECT DISTINCT p_brand FROM part)")
def q_canonical_tags(spark, d):
    b = load(spark, d, "part").select("p_brand").distinct()
    raw = F.when(F.col("p_brand").endswith("1"), " ECONOMY ").when(F.col("p_brand").endswith("2"), "warefare").otherwise("no such")
    return b.select("p_brand", derive.canonical_tag(raw).alias("tag"))


# Queue and health

_BAD = "event_type = 'error'"


def _attempts(spark, d):
    e = load(spark, d, "events")
    return e.select(F.col("user_id").alias("port"), "event_id", (F.col("event_type") != "error").alias("ok"), (F.col("event_type") == "error").alias("transport"),
                    (F.col("event_type") == "signup").alias("limited"), "value")


_RUNS = f"""w AS (SELECT user_id AS port, event_id, {_BAD} AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, {_BAD} ORDER BY event_id) AS g FROM events),
runs AS (SELECT port, coalesce(max(n) FILTER (bad), 0) AS longest FROM (SELECT port, bad, g, count(*) AS n FROM w GROUP BY ALL) GROUP BY port)"""


@query(f"WITH {_RUNS} SELECT port, longest FROM runs")
def q_max_run(spark, d):
    return work_queue.runs(_attempts(spark, d), "port", "event_id", F.col("transport"))


@query(f"""WITH {_RUNS}, x AS (SELECT user_id AS port, count(*) AS attempts, avg(CASE WHEN {_BAD} THEN 0.0 ELSE 1 END) AS o, avg(CASE WHEN {_BAD} THEN 1.0 ELSE 0 END) AS t, avg(CASE WHEN event_type = 'signup' THEN 1.0 ELSE 0 END) AS l,
quantile_cont(value, 0.95) FILTER (NOT {_BAD}) AS p95 FROM events GROUP BY 1), f AS (SELECT *, CASE WHEN o = 0 THEN 'F' WHEN o >= 0.8 AND t <= 0.2 AND l <= 0.2 THEN CASE WHEN coalesce(p95 <= 30, true) THEN 'A' ELSE 'B' END WHEN o >= 0.4 AND longest < 5 THEN 'B' ELSE 'C' END AS g FROM x JOIN runs USING (port))
SELECT port, attempts, round(o, 6) AS ok_rate, round(t, 6) AS transport_rate, round(l, 6) AS limited_rate, round(p95, 6) AS p95, longest, CASE WHEN g = 'B' AND o < 0.8 AND (t >= 0.6 OR longest >= 3) THEN 'C' ELSE g END AS grade FROM f""")
def q_port_grades(spark, d):
    g = work_queue.grades(_attempts(spark, d), "port", "event_id", F.col("ok"), F.col("transport"), F.col("limited"), F.col("value"))
    return rounded(g, "ok_rate", "transport_rate", "limited_rate", "p95")


@query(f"""WITH s AS (SELECT user_id AS port, event_id, {_BAD} AS f, count(*) FILTER (NOT ({_BAD})) OVER (PARTITION BY user_id ORDER BY event_id) AS z FROM events),
n AS (SELECT port, event_id, count(*) FILTER (f) OVER (PARTITION BY port, z ORDER BY event_id) AS failures FROM s)
SELECT port, event_id, failures, CASE WHEN failures >= 5 THEN 'quarantined' WHEN failures >= 2 THEN 'degraded' ELSE 'healthy' END AS state FROM n""")
def q_breaker(spark, d):
    return work_queue.breaker(_attempts(spark, d), "port", "event_id", ~F.col("ok"))


#: A page's state by its length, as if a run had been broken off.
_STATE = """state AS (SELECT page_id AS id, url, CASE length(html) % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'fail' WHEN 2 THEN 'invalid' ELSE 'pending' END AS status,
CAST(CASE WHEN length(html) % 5 = 1 THEN length(url) % 4 ELSE 0 END AS INT) AS retry_count FROM pages)"""


def _state(spark, d):
    i = F.length("html") % 5
    status = F.when(i == 0, "success").when(i == 1, "fail").when(i == 2, "invalid").otherwise("pending")
    return load(spark, d, "pages").select(F.col("page_id").alias("id"), "url", status.alias("status"), F.when(i == 1, F.length("url") % 4).otherwise(0).cast("int").alias("retry_count"))


def _results(spark, d):
    """A labelled page has been tried: good, gone or failed."""
    own = load(spark, d, "labels").groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") == 1).alias("ok"), F.max("toxic").alias("_t"))
    return own.select("id", "ok", F.when(F.col("_t") == 1, 404).otherwise(500).alias("status_code"))


@query(f"""WITH {_STATE}, r AS (SELECT doc_id AS id, max(quality) = 1 AS ok, max(toxic) = 1 AS gone FROM labels GROUP BY doc_id)
SELECT s.id, url, CASE WHEN ok IS NULL THEN status WHEN ok THEN 'success' WHEN gone THEN 'invalid' ELSE 'fail' END AS status,
CASE WHEN NOT ok AND NOT gone THEN retry_count + 1 ELSE retry_count END AS retry_count FROM state s LEFT JOIN r ON s.id = r.id""")
def q_queue_step(spark, d):
    return work_queue.step(_state(spark, d), _results(spark, d), True)


@query(f"""WITH {_STATE}, r AS (SELECT doc_id AS id, max(quality) = 1 AS ok, max(toxic) = 1 AS gone FROM labels GROUP BY doc_id)
SELECT s.id, url, CASE WHEN ok IS NULL THEN status WHEN ok THEN 'success' WHEN gone THEN 'invalid' ELSE 'fail' END AS status,
CASE WHEN NOT ok AND NOT gone THEN 0 ELSE retry_count END AS retry_count FROM state s LEFT JOIN r ON s.id = r.id""")
def q_queue_step_full(spark, d):
    return work_queue.step(_state(spark, d), _results(spark, d), False)


@query("SELECT page_id AS id, url, 'pending' AS status, CAST(0 AS INT) AS retry_count FROM pages")
def q_queue_start(spark, d):
    return work_queue.start(load(spark, d, "pages"), "page_id", "url")


@query(f"WITH {_STATE} SELECT 'full' AS phase, count(*) FILTER (status = 'pending') AS todo, CAST(NULL AS INT) AS least_retry FROM state")
def q_queue_phase(spark, d):
    return work_queue.phase(_state(spark, d), 3)


@query(f"WITH {_STATE} SELECT * FROM state WHERE status = 'pending' ORDER BY id LIMIT 15")
def q_queue_pick(spark, d):
    return work_queue.pick(_state(spark, d), 3, 15)


@query(f"WITH {_STATE} SELECT id, url, 'fail' AS status, retry_count FROM state WHERE status IN ('fail', 'pending') AND retry_count < 3 ORDER BY retry_count, id LIMIT 15")
def q_queue_pick_retry(spark, d):
    """All that was pending has failed once."""
    failed = F.when(F.col("status") == "pending", "fail").otherwise(F.col("status"))
    return work_queue.pick(_state(spark, d).withColumn("status", failed), 3, 15)


@query(f"WITH {_STATE} SELECT s.id, url, CASE WHEN g.id IS NOT NULL AND status IN ('pending', 'fail') THEN 'success' ELSE status END AS status, retry_count FROM state s LEFT JOIN (SELECT DISTINCT doc_id AS id FROM labels WHERE quality = 1) g ON s.id = g.id")
def q_queue_sync(spark, d):
    return work_queue.sync_saved(_state(spark, d), load(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("id")))


@query(f"WITH {_STATE} SELECT * FROM state")
def q_queue_checked(spark, d):
    """The state passes as long as as many pages are saved as are done."""
    state = _state(spark, d)
    return work_queue.checked_count(state, state.where("status = 'success'").count())


@query(f"WITH {_STATE} SELECT CASE WHEN status = 'fail' THEN 'exhausted' ELSE 'invalid' END AS why, id FROM state WHERE status = 'invalid' OR (status = 'fail' AND retry_count >= 2)")
def q_queue_review(spark, d):
    return work_queue.to_review(_state(spark, d), 2)


@query("""WITH v AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 2 ELSE quality END AS a, CASE WHEN doc_id % 7 = 0 THEN 2 ELSE toxic END AS b FROM labels)
SELECT doc_id, CAST(CASE WHEN a = b THEN a WHEN a = 2 THEN b WHEN b = 2 THEN a ELSE 2 END AS INT) AS vote FROM v""")
def q_consensus(spark, d):
    i = F.col("doc_id")
    return load(spark, d, "labels").select("doc_id", work_queue.consensus(F.when(i % 5 == 0, 2).otherwise(F.col("quality")), F.when(i % 7 == 0, 2).otherwise(F.col("toxic"))).cast("int").alias("vote"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def q_checkpoint_rest(spark, d):
    return work_queue.unfinished(load(spark, d, "documents"), load(spark, d, "labels").where("quality = 1"), "doc_id").select("doc_id")


@query("""SELECT c_custkey AS port, CAST(row_number() OVER (ORDER BY c_nationkey % 3, c_custkey % 2 = 1, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END NULLS FIRST, c_custkey) AS INT) AS choice
FROM customer WHERE c_nationkey % 3 < 2""")
def q_egress_choice(spark, d):
    """Ports to use next: healthy before degraded, idle ones, those unused longest; quarantined ones not at all."""
    k, n = F.col("c_custkey"), F.col("c_nationkey") % 3
    ports = load(spark, d, "customer").select(k.alias("port"), F.when(n == 0, "healthy").when(n == 1, "degraded").otherwise("quarantined").alias("state"),
                                              (k % 2 == 1).alias("busy"), F.when(k % 5 > 0, F.col("c_acctbal")).alias("last_used"))
    return work_queue.choose_egress(ports).select("port", F.col("choice").cast("int").alias("choice"))


@query("SELECT event_id, CAST(CASE WHEN props = '' THEN NULL ELSE nullif(regexp_extract(props, '[012]'), '') END AS INT) AS answer FROM events")
def q_answer_class(spark, d):
    return load(spark, d, "events").select("event_id", work_queue.answer_class(F.col("props")).alias("answer"))


@query("""WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS position FROM part)
SELECT l_partkey AS p_partkey, sum(l_quantity) AS quantity, coalesce(any_value(position), 4611686018427387904) AS position FROM lineitem LEFT JOIN p ON l_partkey = p.p_partkey GROUP BY l_partkey""")
def q_sheet_order(spark, d):
    """Rows of one table in the order of another's popularity."""
    places = relations.positions(load(spark, d, "part"), "p_partkey", "p_retailprice")
    rows = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("quantity"))
    return relations.sorted_by_position(rows, places, "p_partkey").select("p_partkey", "quantity", "position")


@query("SELECT page_id, regexp_extract(url, '[?&]page=(\\d+)', 1) = '2' AS second, left(lpad(CAST(page_id AS VARCHAR), 6, '0'), 2) AS folder FROM pages")
def q_page_folders(spark, d):
    p = load(spark, d, "pages")
    return p.select("page_id", F.coalesce(text.query_id(F.replace("url", F.lit("page="), F.lit("id="))) == "2", F.lit(False)).alias("second"), derive.id_folder(F.col("page_id"), 6).alias("folder"))


# Pages

_LINK = r"""'(?i)<a\s[^>]*href="([^"]*)"'"""


@query(rf"""SELECT page_id, regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1) AS lang, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h1, len(regexp_extract_all(html, {_LINK})) AS links FROM pages""")
def q_page_parse(spark, d):
    return markup.plain_page(load(spark, d, "pages"), "page_id", "html")


@query(f"SELECT page_id, CAST(i AS INT) AS position, l[i + 1] AS href FROM (SELECT page_id, regexp_extract_all(html, {_LINK}, 1) AS l FROM pages), range(0, 1000) t(i) WHERE i < len(l)")
def q_page_links(spark, d):
    return markup.page_links(load(spark, d, "pages"), "page_id", "html")


@query("SELECT page_id, CASE WHEN html IS NULL THEN 'missing' WHEN html = '' THEN 'empty' WHEN strpos(left(html, 200000), '<nav>') > 0 THEN 'ok' ELSE 'invalid' END AS status, length(html) < 2000 AS is_invalid FROM pages")
def q_page_status(spark, d):
    p = load(spark, d, "pages")
    return p.select("page_id", markup.page_status(F.col("html"), "<nav>").alias("status"), markup.is_invalid(F.col("html")).alias("is_invalid"))


@query(r"""WITH x AS (SELECT doc_id // 5 AS page, doc_id, source, trim(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS t FROM documents)
SELECT page, 'Trade' AS tag, page * 5 + row_number() OVER (PARTITION BY page ORDER BY doc_id) AS rank, CAST(doc_id AS VARCHAR) AS item_id, t AS title, t AS description, '4-star' AS star_rating,
source AS author, 'https://catalogue.example/item?id=' || doc_id AS detail_url FROM x""")
def q_list_pages(spark, d):
    """Five items to a list page made of documents, parsed back."""
    docs = load(spark, d, "documents").where("doc_id is not null")
    payload = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("title"), F.col("text").alias("description")))
    row = F.concat(F.lit('<img class="fileRating" src="https://x.example/4-star.png?v=1"><a class="workshop_author_link" href="#">by '), F.coalesce("source", F.lit("")),
                   F.lit("</a><script>" + markup.HOVER + "(1, "), payload, F.lit(")</script>"))
    rows = docs.select(F.floor(F.col("doc_id") / 5).alias("page"), "doc_id", row.alias("row"))
    page = rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "row"))), lambda z: z["row"]), "").alias("rows"))
    html = F.concat(F.lit('<script>var paramsGET = {"requiredtags":["Trade"]};</script><div class="workshopBrowsePagingInfo">Showing '), (F.col("page") * 5 + 1).cast("string"),
                    F.lit("-9 of</div><div " + markup.ITEMS_FROM + ">"), "rows", F.lit("</div><div " + markup.ITEMS_TO + "></div>"))
    out = markup.list_rows(page.select("page", html.alias("html")), "page", "html", "https://catalogue.example/item?id=")
    return out.withColumn("rank", F.col("rank").cast("long"))


@query(rf"""{M} SELECT CAST(mod_id AS VARCHAR) AS item_id, trim(regexp_replace(mod_name, '\s+', ' ', 'g')) AS name, CAST(exposure AS INT) AS exposure, CAST(subscribers AS INT) AS subscribers,
CAST(favorites AS INT) AS favorites, ['Economy and Buildings', 'Map'] AS tags FROM mods WHERE trim(regexp_replace(mod_name, '\s+', ' ', 'g')) <> ''""")
def q_detail_pages(spark, d):
    """Item pages made of documents, parsed back."""
    m = adapter.items(spark, d)
    cell = lambda n, label: F.concat(F.lit("<tr><td>"), F.format_number(n, 0), F.lit(f"</td><td>{label}</td></tr>"))
    html = F.concat(F.lit("<script>var publishedfileid = '"), F.col("mod_id").cast("string"), F.lit("';</script><div class=\"workshopItemTitle\">"), "mod_name", F.lit("</div><table>"), cell(F.col("exposure"), "Unique Visitors"),
                    cell(F.col("subscribers"), "Current Subscribers"), cell(F.col("favorites"), "Current Favorites"), F.lit('</table><a href="?requiredtags%5B%5D=x">economy</a><a href="?requiredtags%5B%5D=y">Map</a>'))
    return markup.detail_rows(m.select(html.alias("html")), "html")


# Corpus map

_CORPUS = r"""c AS (SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x,
  '(?i)^\s*(https?://\S+|(version|v)\s*[\d.]+|(license|licence|copyright|all rights reserved|terms of|subscribe|please)\b.*|\W*)\s*$'))) = 0 AS bare, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS content_hash, CAST(length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS INT) AS n_chars FROM documents)"""


@query(f"""WITH {_CORPUS} SELECT doc_id, content_hash, n_chars, CASE WHEN n_chars < 100 THEN 'too_short' WHEN doc_id <> min(doc_id) OVER (PARTITION BY content_hash) THEN 'duplicate' WHEN bare THEN 'boilerplate_only' END AS excluded,
CASE WHEN n_chars >= 2000 THEN 'A' WHEN n_chars >= 500 THEN 'B' ELSE 'C' END AS tier FROM c""")
def q_corpus_tiers(spark, d):
    return derive.corpus_rows(load(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {_CORPUS} SELECT content_hash, min(doc_id) AS kept, count(*) AS copies FROM c GROUP BY content_hash HAVING count(*) > 1")
def q_doc_dedup(spark, d):
    c = derive.corpus_rows(load(spark, d, "documents"), "doc_id", "text")
    return c.groupBy("content_hash").agg(F.min("doc_id").alias("kept"), F.count("*").alias("copies")).where("copies > 1")


#: Han letters in place of a to z, and of e alone, so that every kind of text occurs.
_HAN = "".join(chr(0x4E00 + i) for i in range(26))


@query(f"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN translate(text, 'abcdefghijklmnopqrstuvwxyz', '{_HAN}') ELSE translate(text, 'e', '{_HAN[0]}') END AS t FROM documents),
c AS (SELECT doc_id, length(regexp_replace(t, '[^一-鿿]', '', 'g')) AS h, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS l FROM t)
SELECT doc_id, CASE WHEN coalesce(h + l, 0) = 0 THEN 'unknown' WHEN h >= 0.9 * (h + l) THEN 'zh' WHEN l >= 0.9 * (h + l) THEN 'en' ELSE 'mixed' END AS script FROM c""")
def q_script_mix(spark, d):
    docs, n = load(spark, d, "documents"), F.col("doc_id") % 3
    t = F.when(n == 0, F.col("text")).when(n == 1, F.translate("text", "abcdefghijklmnopqrstuvwxyz", _HAN)).otherwise(F.translate("text", "e", _HAN[0]))
    return docs.select("doc_id", derive.script_mix(t).alias("script"))


@query("""WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM u GROUP BY 1, 2),
e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), q AS (SELECT vec_id, label, sqrt(sum(pow(x - m, 2))) AS r FROM e JOIN c USING (label, i) GROUP BY 1, 2)
SELECT label, count(*) AS n, round(avg(r), 6) AS spread FROM q GROUP BY label""")
def q_label_spread(spark, d):
    """How far the vectors of each label lie from their centre."""
    e = load(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "x"))
    centre = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    far = e.join(centre, ["label", "i"]).groupBy("vec_id", "label").agg(F.sqrt(F.sum(F.pow(F.col("x") - F.col("m"), 2))).alias("r"))
    return rounded(far.groupBy("label").agg(F.count("*").alias("n"), F.avg("r").alias("spread")), "spread")


# Reports

def _figures(ord_: int, block: str, relation: str, figures: dict[str, str], key: str = "") -> str:
    """SQL rows (ord, block, key, metric, value) of a relation's aggregates, by key if one is given."""
    cols = ", ".join(f"CAST({x} AS DOUBLE) AS m{i}" for i, x in enumerate(figures.values()))
    rows = ", ".join(f"{{'metric': '{k}', 'value': m{i}}}" for i, k in enumerate(figures))
    one = f"SELECT CAST({key or chr(39) * 2} AS VARCHAR) AS key, {cols} FROM {relation}" + (f" GROUP BY {key}" if key else "")
    return f"SELECT {ord_} AS ord, '{block}' AS block, key, r.metric AS metric, round(r.value, 6) AS value FROM (SELECT key, unnest([{rows}]) AS r FROM ({one}))"


def _statistic_sql() -> str:
    over = lambda p: {"n": "count(v)", "total": "coalesce(sum(v), 0)", "mean": "avg(v)", "median": "median(v)", "std": "stddev_pop(v)", "least": "min(v)", "most": "max(v)"}
    pct = lambda ps: {f"p{round(100 * p)}": f"quantile_cont(v, {p})" for p in ps}
    gini = {"gini": "2.0 * sum(a * v) / (count(*) * sum(v)) - (count(*) + 1.0) / count(*)"}
    share = lambda c: f"CAST(sum(v) FILTER ({c}) AS DOUBLE) / any_value(t)"
    top = "(SELECT k.key AS kk, k.c AS c, o.* FROM o, k)"
    desc = {"n": "count(*)", "mean": "avg(ratio)", "std": "stddev_samp(ratio)", "cv": "stddev_samp(ratio) / avg(ratio)", "least": "min(ratio)", "most": "max(ratio)", "spread": "max(ratio) - min(ratio)",
            "skewness": "avg(pow((ratio - m) / s, 3))", "kurtosis": "avg(pow((ratio - m) / s, 4)) - 3", "above_one": "count(*) FILTER (ratio > 1)", "at_one": "count(*) FILTER (ratio = 1)",
            **{f"p{round(100 * p)}": f"quantile_cont(ratio, {p})" for p in (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)}, "iqr": "quantile_cont(ratio, 0.75) - quantile_cont(ratio, 0.25)"}
    blocks = [
        _figures(1, "scope", "flags", {"items": "count(*)", "private_like": "count(*) FILTER (is_private_like = 1)", "in_scope": "count(*) FILTER (is_private_like = 0)", "private_share": "avg(CASE WHEN is_private_like = 1 THEN 1.0 ELSE 0 END)"}),
        _figures(2, "all", "o", over(0)), _figures(3, "all", "o", pct(stats.PERCENTS)),
        _figures(4, "all_top", top, {"count": "least(any_value(c), any_value(n))", "share_items": "least(any_value(c), any_value(n)) / any_value(n)", "sum": "sum(v) FILTER (i <= c)", "share_total": share("i <= c")}, "kk"),
        _figures(5, "all", "o", {"hhi": "sum(CAST(v AS DOUBLE) * v) / pow(sum(v), 2)"}), _figures(6, "all", "o", gini),
        _figures(7, "all_pareto", "(SELECT target AS kk, o.* FROM o, (SELECT CAST(unnest([0.5, 0.8, 0.9]) AS DOUBLE) AS target) WHERE CAST(s AS DOUBLE) / t >= target - 1e-12)", {"needed": "min(i)", "share": "CAST(min(i) AS DOUBLE) / any_value(n)"}, "kk"),
        _figures(8, "all_at_least", "(SELECT unnest([100, 500, 1000, 5000, 10000]) AS kk), o", {"items": "count(*) FILTER (v >= kk)", "share": "count(*) FILTER (v >= kk) / count(*)"}, "kk"),
        _figures(9, "all_bucket", "(VALUES (0, 99, '0_99'), (100, 999, '100_999'), (1000, 4999, '1000_4999'), (5000, 9999, '5000_9999'), (10000, 49999, '10000_49999'), (50000, 9000000000, '50000_plus')) b(lo, hi, kk), o",
                 {"items": "count(*) FILTER (v BETWEEN lo AND hi)", "share": "count(*) FILTER (v BETWEEN lo AND hi) / count(*)"}, "kk"),
        _figures(10, "scope_use", "oi", over(0)), _figures(11, "scope_use", "oi", pct((0.01, 0.1, 0.5, 0.9, 0.99))),
        _figures(12, "scope_share", "(VALUES ('top_1', 0.01), ('top_5', 0.05), ('top_10', 0.1), ('bottom_10', 0.1), ('bottom_20', 0.2)) b(kk, p), oi",
                 {"share": share("CASE WHEN kk LIKE 'top%' THEN i ELSE a END <= greatest(1, ceil(n * CAST(p AS DOUBLE)))")}, "kk"),
        _figures(13, "scope_use", "oi", {"p90_p10": "quantile_cont(v, 0.9) / quantile_cont(v, 0.1)", "p99_p1": "quantile_cont(v, 0.99) / quantile_cont(v, 0.01)",
                                          "palma": "CAST(sum(v) FILTER (i <= greatest(1, ceil(n * CAST(0.1 AS DOUBLE)))) AS DOUBLE) / sum(v) FILTER (a <= greatest(1, ceil(n * CAST(0.4 AS DOUBLE))))"}),
        _figures(14, "scope_use", "oi", gini),
        _figures(15, "ratio", "(SELECT *, avg(ratio) OVER () AS m, stddev_samp(ratio) OVER () AS s FROM ratios)", desc),
        _figures(16, "ratio_tier", "(SELECT t AS kk, ratio FROM range(4) r(t) LEFT JOIN ratios ON tier = t)", {"n": "count(ratio)", "mean": "avg(ratio)", "median": "median(ratio)"}, "kk")]
    ordered = lambda rel: f"""SELECT subscribers AS v, row_number() OVER (ORDER BY subscribers DESC) AS i, row_number() OVER (ORDER BY subscribers) AS a,
  count(*) OVER () AS n, sum(subscribers) OVER () AS t, sum(subscribers) OVER (ORDER BY subscribers DESC ROWS UNBOUNDED PRECEDING) AS s FROM {rel}"""  # noqa: E731
    return f"""{MR}, o AS ({ordered('mods')}), oi AS ({ordered('mods JOIN flags USING (mod_id) WHERE is_private_like = 0')}),
k AS (SELECT unnest(['top_10', 'top_50', 'top_100', 'top_1pct', 'top_5pct', 'top_10pct']) AS key,
  unnest([10, 50, 100, greatest(1, round_even(n * CAST(0.01 AS DOUBLE), 0)), greatest(1, round_even(n * CAST(0.05 AS DOUBLE), 0)), greatest(1, round_even(n * CAST(0.1 AS DOUBLE), 0))]) AS c FROM (SELECT any_value(n) AS n FROM o))
""" + "\nUNION ALL ".join(blocks)


@query(_statistic_sql())
def q_statistic_table(spark, d):
    m = adapter.items(spark, d)
    return rounded(report.statistic_table(m, adapter.flags(m), adapter.ratios(m)), "value")


_NUMBER = r"""CASE WHEN isnan(v) THEN 'NaN' WHEN isinf(v) THEN CASE WHEN v > 0 THEN 'Inf' ELSE '-Inf' END WHEN abs(v) >= 1000 THEN format('{:,.2f}', v)
WHEN abs(v) >= 1 THEN regexp_replace(format('{:,.4f}', v), '\.?0+$', '') ELSE regexp_replace(format('{:,.6f}', v), '\.?0+$', '') END"""
_SHARE = "(starts_with(metric, 'share') OR ends_with(metric, 'share'))"


@query(f"""SELECT ord, block, key, metric, CASE WHEN v IS NULL THEN NULL WHEN {_SHARE} THEN format('{{:.2f}}%', 100 * v) ELSE {_NUMBER} END AS value,
CASE WHEN v IS NOT NULL AND {_SHARE} THEN repeat('█', k) || repeat('░', 20 - k) END AS bar
FROM (SELECT *, CAST(value AS DOUBLE) AS v, CAST(round_even(least(1, greatest(0, CAST(value AS DOUBLE))) * 20, 0) AS INT) AS k FROM ({_statistic_sql()}))""")
def q_statistic_text(spark, d):
    m = adapter.items(spark, d)
    return report.as_text(rounded(report.statistic_table(m, adapter.flags(m), adapter.ratios(m)), "value"))


@query("""WITH g AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT 'description' AS field, 'labelled documents' AS value UNION ALL SELECT 'items', CAST(count(*) AS VARCHAR) FROM labels UNION ALL SELECT 'listed', CAST(count(*) AS VARCHAR) FROM documents
UNION ALL SELECT 'missing', CAST(count(*) AS VARCHAR) FROM g UNION ALL SELECT 'missing_id', CAST(doc_id AS VARCHAR) FROM g
UNION ALL SELECT 'created', strftime(min(ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') FROM events
UNION ALL SELECT 'app_id', '77' UNION ALL SELECT 'hub_items', CAST(count(*) AS VARCHAR) FROM part
UNION ALL SELECT 'tag_counts', string_agg(p_brand || ': ' || n, chr(10) ORDER BY p_brand) FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)""")
def q_metadata_table(spark, d):
    ids = lambda t: load(spark, d, t).select(F.col("doc_id").alias("mod_id"))
    created = load(spark, d, "events").agg(F.min("ts").alias("modified"))
    return report.metadata_table(ids("labels"), ids("documents"), "labelled documents", created, markup.hub_row(hub_page(spark, d), "html", "url"))


def hub_page(spark, d):
    """One hub page (html, url) made of the brands and the number of parts."""
    brands = load(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    block = F.concat(F.lit('<div class="filterOption"><input name="requiredtags[]" value="'), F.url_encode("p_brand"), F.lit('"><label class="tag_label">'), "p_brand",
                     F.lit('&nbsp;<span class="tag_count">('), F.format_number("n", 0), F.lit(")</span></label></div>"))
    one = brands.agg(F.sum("n").alias("t"), F.array_join(F.array_sort(F.collect_list(block)), "").alias("b"))  # a row a brand
    return one.select(F.concat(F.lit('<input type="hidden" name="appid" value="77">'), "b", F.lit(" See all 3 Items See all "), F.format_number("t", 0), F.lit(" Items")).alias("html"), F.lit("").alias("url"))


@query("SELECT row_number() OVER (ORDER BY page_id, url) AS place, CAST(to_json(url) AS VARCHAR) AS json FROM pages WHERE trim(url) <> ''")
def q_url_document(spark, d):
    return report.url_document(load(spark, d, "pages"), "page_id", "url").withColumn("place", F.col("place").cast("long"))


@query(f"""WITH {_COVERAGE} SELECT 'url_count' AS part, count(*) FILTER (status <> 'extra') AS key, NULL AS status FROM c UNION ALL SELECT 'gap_count', count(*) FILTER (status IN ('missing', 'invalid')), NULL FROM c
UNION ALL SELECT CASE status WHEN 'extra' THEN 'extra' ELSE 'gap' END, page_id, status FROM c WHERE status <> 'ok'""")
def q_gap_document(spark, d):
    return report.gap_document(q_coverage(spark, d), "page_id")


@query("SELECT date_trunc('hour', ts) AS \"from\", date_trunc('hour', ts) + INTERVAL 1 HOUR AS \"to\", count(*) AS n FROM events GROUP BY 1, 2")
def q_heartbeat(spark, d):
    from ..streaming.queue_stream import heartbeat

    return heartbeat(load(spark, d, "events"), "ts")
