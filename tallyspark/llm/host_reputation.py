"""URL filter by empirical-Bayes host reputation (operator 2), DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels below which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
                      "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")


def with_parts(pages: DataFrame) -> DataFrame:
    """Host (A-Z lower-cased) after the first ``://`` and path up to ``?`` or ``#``; both '' without ``://``."""
    own = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("_url"))
    rest = F.when(F.instr("_url", "://") > 0, F.expr("substr(_url, instr(_url, '://') + 3)")).otherwise("")
    own = own.select("page_id", rest.alias("_rest"))
    return own.select(
        "page_id", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def _matching_rule(rules: list[tuple[str, str]]) -> Column:
    """The longest rule (verdict, 'host/path') that fits host and path, as a struct; null if none does."""
    options = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        options.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*options, none) if options else none


def _strength(groups: DataFrame, n: str, bad: str, parent: str) -> Column:
    """Beta-binomial prior strength by moments: how much the groups' rates vary around their parents' rate."""
    p = F.col(parent)
    spread = F.sum(F.when(F.col(n) > 0, F.col(n) * F.pow(F.col(bad) / F.col(n) - p, 2)))
    base = F.sum(F.when(F.col(n) > 0, p * (1 - p)))
    more = F.sum(F.when(F.col(n) > 0, p * (1 - p) * (F.col(n) - 1)))
    rho = F.when(more > 0, (spread - base) / more)
    return F.least(F.lit(1000.0), F.greatest(F.lit(1.0), 1 / F.greatest(rho, F.lit(1e-6)) - 1))


def host_reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """hosts(host, n, bad), one row a host -> (host, n, bad, rate, bound).

    Priors run from all pages to the suffix, the registered domain and the host: each level's rate is
    shrunk to its parent's with a strength estimated from the data. ``bound`` is the lower posterior
    bound of the host's share of bad pages, mean - z * deviation of its beta posterior.
    """
    labels = F.split("host", r"\.")
    two = F.concat_ws(".", F.slice(labels, -2, 2))
    plain = F.col("host").rlike(r"^[0-9.]*$|:") | (F.size(labels) < 2)
    width = F.when(two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    suffix = F.when(plain, F.lit("")).when(width == 2, two).otherwise(F.element_at(labels, -1))
    domain = F.when(plain, F.col("host")).otherwise(F.concat_ws(".", F.slice(labels, -F.least(width + 1, F.size(labels)), width + 1)))
    h = hosts.select("host", "n", "bad", suffix.alias("suffix"), domain.alias("domain"))
    d = h.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("bad").alias("db"))
    s = d.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb"))
    total = s.agg(F.coalesce(F.sum("sn"), F.lit(0)).alias("n"), F.coalesce(F.sum("sb"), F.lit(0)).alias("b")).first()
    p0 = (total["b"] + 1) / (total["n"] + 2)
    raw = lambda b, n: F.when(F.col(n) > 0, F.col(b) / F.col(n)).otherwise(F.lit(p0))
    s = s.withColumn("p0", F.lit(p0)).withColumn("sraw", raw("sb", "sn"))
    d = d.join(s, "suffix").withColumn("draw", raw("db", "dn"))
    h = h.join(d.drop("suffix"), "domain")
    ms, md, mh = (
        float(x.agg(_strength(x, n, b, p).alias("m")).first()["m"] or 1.0)
        for x, n, b, p in ((s, "sn", "sb", "p0"), (d, "dn", "db", "sraw"), (h, "n", "bad", "draw")))
    ps = (F.col("sb") + ms * p0) / (F.col("sn") + ms)
    pd = (F.col("db") + md * ps) / (F.col("dn") + md)
    a, b = F.col("bad") + mh * pd, F.col("n") - F.col("bad") + mh * (1 - pd)
    rate = a / (a + b)
    return h.select("host", "n", "bad", rate.alias("rate"), (rate - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] | None = None, limit: float = 0.5, z: float = 1.645,
) -> DataFrame:
    """pages(page_id, url, ...) and outcomes(page_id, bad) -> (page_id, host, path, rule, verdict, n_labelled, n_bad).

    A page is blocked if its host's lower posterior bound of bad pages exceeds ``limit``, unless an
    explicit rule ('host/path', longest wins) says otherwise. Null urls and urls without ``://`` have an
    empty host of their own. Null outcomes don't count; a page with several outcomes is bad if one is;
    a null page_id has none. Repeated pages each count and each come back; other columns are ignored.
    """
    parts = with_parts(pages)
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counts = Scratch(pages.sparkSession, "reputation").save(parts.select("page_id", "host").join(known, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    found = host_reputation(counts, z)
    out = parts.withColumn("_r", _matching_rule(rules or [])).join(found, "host")
    verdict = F.coalesce("_r.verdict", F.when(F.col("bound") > limit, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"),
                      F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"))
