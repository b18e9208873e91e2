"""The registered queries of this subpackage, with production parameters, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load
from .bit_sliced import top_k
from .decontaminate import contained_items
from .host_reputation import TWO_LABEL_SUFFIXES, judge_urls
from .language_id import identify_languages
from .minhash_dedup import near_duplicates
from .mixing import mix
from .paragraph_dedup import repeated_paragraphs
from .suffix_dedup import suffix_dedup
from .token_counts import prefix_table, within_budget
from .toxicity import score_toxicity
from .transcripts import format_chats
from .turn_repair import repair_damaged
from .whitening import whiten

#: Fixed values of the URL rules.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(load(spark, sf_dir, "documents"), 400)


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is that of the document it shows (page_id = doc_id): bad if low in quality or toxic."""
    outcomes = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))
    return judge_urls(load(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(load(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "embeddings"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(load(spark, sf_dir, "conversations"))


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(load(spark, sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), shingle_words=4, threshold=80)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(load(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # a folder of vocabulary files; other queries do without

    return within_budget(prefix_table(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")), 4096)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(load(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_reputation": op2_url_reputation,
    "op3_language_id": op3_language_id,
    "op4_mix_sources": op4_mix_sources,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_top_k": op7_top_k,
    "op8_chat_format": op8_chat_format,
    "op9_paragraph_dedup": op9_paragraph_dedup,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_whitening": op11_whitening,
    "op12_token_counts": op12_token_counts,
    "op13_turn_repair": op13_turn_repair,
}

_MOMENTS = """SELECT coalesce(least(1000.0, greatest(1.0, 1 / greatest(
  (sum(CASE WHEN n > 0 THEN n * pow(bad / n - p, 2) END) - sum(CASE WHEN n > 0 THEN p * (1 - p) END))
  / nullif(sum(CASE WHEN n > 0 THEN p * (1 - p) * (n - 1) END), 0), 1e-6) - 1)), 1.0) AS m"""

ORACLES: dict[str, str] = {
    "op2_url_reputation": f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT doc_id, max(CAST(greatest(1 - quality, toxic) AS INT)) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM p LEFT JOIN l ON page_id = doc_id GROUP BY host),
h0 AS (SELECT *, regexp_matches(host, '^[0-9.]*$|:') OR strpos(host, '.') = 0 AS plain, string_split(host, '.') AS l,
  CASE WHEN array_to_string(l[-2:], '.') IN {TWO_LABEL_SUFFIXES} THEN 2 ELSE 1 END AS k FROM c),
h1 AS (SELECT host, n, bad, CASE WHEN plain THEN '' WHEN k = 2 THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
  CASE WHEN plain THEN host WHEN k = 2 THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM h0),
g AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS p0 FROM h1),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(p0) AS p FROM h1, g GROUP BY suffix),
d AS (SELECT h1.suffix, domain, sum(h1.n) AS n, sum(h1.bad) AS bad, any_value(CASE WHEN s.n > 0 THEN s.bad / s.n ELSE s.p END) AS p
  FROM h1 JOIN s USING (suffix) GROUP BY h1.suffix, domain),
h AS (SELECT host, h1.n, h1.bad, h1.suffix, h1.domain, CASE WHEN d.n > 0 THEN d.bad / d.n ELSE p0 END AS p FROM h1 JOIN d USING (domain), g),
ms AS ({_MOMENTS} FROM s), md AS ({_MOMENTS} FROM d), mh AS ({_MOMENTS} FROM h),
ps AS (SELECT suffix, (bad + m * p0) / (n + m) AS ps FROM s, ms, g),
pd AS (SELECT domain, (bad + m * ps) / (n + m) AS pd FROM d JOIN ps USING (suffix), md),
ab AS (SELECT host, n, bad, bad + m * pd AS a, n - bad + m * (1 - pd) AS b FROM h JOIN pd USING (domain), mh),
v AS (SELECT host, n, bad, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM ab),
r(verdict, rh, rp) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
f AS (SELECT page_id, host AS fh, path AS fp, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS rv
  FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(rv, v.verdict) AS verdict, v.n AS n_labelled, CAST(v.bad AS BIGINT) AS n_bad
FROM p JOIN v USING (host) LEFT JOIN f ON p.page_id = f.page_id AND p.host = fh AND p.path = fp""",
    "op4_mix_sources": r"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT k, sum(size) AS sz, (ARRAY[5, 2, 1])[(row_number() OVER (ORDER BY k) - 1) % 3 + 1] AS w FROM d GROUP BY k),
b AS (SELECT *, 2.0 * sz / w AS r, coalesce(sum(2.0 * sz) OVER o, 0) AS cb, coalesce(sum(w) OVER o, 0) AS wb, sum(sz) OVER () * 1.5 AS t, sum(w) OVER () AS tw
  FROM s WINDOW o AS (ORDER BY 2.0 * sz / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (t - cb) / (tw - wb) * w >= 2 * sz AS filled FROM b),
g AS (SELECT k, sz, CAST(CASE WHEN filled THEN 2 * sz ELSE w * (t - coalesce(sum(2 * sz) FILTER (filled) OVER (), 0)) / sum(w) FILTER (NOT filled) OVER () END AS DOUBLE) AS target FROM f),
p AS (SELECT *, CASE WHEN sz > 0 THEN CAST(floor(target / sz) AS BIGINT) ELSE 0 END AS whole FROM g),
o AS (SELECT doc_id, d.k, size, sz, target, whole, CAST(round(target) AS BIGINT) - whole * sz AS extra,
  coalesce(sum(size) OVER (PARTITION BY d.k ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM d JOIN p ON d.k = p.k)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(sz AS BIGINT) AS source_size, target,
  CAST(whole * size + greatest(0, least(size, extra - sofar)) AS BIGINT) AS taken FROM o""",
    "op7_top_k": """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""",
    "op6_decontaminate": r"""
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - least(5, len(w)) + 2, 1)), lambda x: array_to_string(list_slice(w, x, x + least(5, len(w)) - 1), ' '))) AS s FROM w WHERE len(w) > 0),
q AS (SELECT item_id, count(*) AS q FROM i GROUP BY item_id),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
k AS (SELECT DISTINCT least(5, len(w)) AS k FROM w WHERE len(w) > 0),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda x: array_to_string(list_slice(w, x, x + k - 1), ' '))) AS s FROM dw, k)
SELECT doc_id, item_id, count(*) AS shared, CAST(any_value(q) AS INT) AS item_shingles FROM d JOIN i USING (s) JOIN q USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(q)""",
}
