"""Scalar functions on text, numbers and times, as Column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def loose_int(s: Column) -> Column:
    """Digits with spaces, commas, no-break spaces or apostrophes between them; 0 if that leaves no number."""
    return F.coalesce(F.regexp_replace(s, "[\\s, ']", "").try_cast("int"), F.lit(0))


def strict_int(s: Column) -> Column:
    """As loose_int, with dots that group thousands; an error if what is left isn't digits."""
    t = F.regexp_replace(s, "[\\s, ']", "")
    t = F.when(t.rlike(r"^\d{1,3}(\.\d{3})+$"), F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    return F.when(t.rlike(r"^\d+$"), t.try_cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("not an integer: "), s)))


#: What html.unescape looks at: a reference and nothing around it.
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def unescape(s: Column) -> Column:
    """HTML entities of every kind. Spark has no built-in for them, so each reference goes through Python; the text between them stays in Spark."""
    between, known = F.split(s, ENTITY, -1), unescape_all(F.regexp_extract_all(s, F.lit(ENTITY), F.lit(0)))
    return F.array_join(F.flatten(F.zip_with(between, known, lambda t, x: F.array(t, F.coalesce(x, F.lit(""))))), "")


def _all_unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: [x if x is None else html.unescape(x) for x in xs], na_action="ignore")


def unescape_all(texts: Column) -> Column:
    """``unescape`` of each text of an array."""
    return F.pandas_udf(_all_unescaped, "array<string>")(texts)


def unescape_basic(s: Column) -> Column:
    """The six most frequent entities, the ampersand last."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(char))
    return s


def collapse(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def strip_tags(s: Column) -> Column:
    return F.regexp_replace(s, "<[^>]+>", "")


def author_name(s: Column) -> Column:
    """Without one leading ``by `` label."""
    return F.trim(F.regexp_replace(F.trim(s), r"(?i)^by\s+", ""))


def tag_display(s: Column) -> Column:
    """A tag's name: cut at the count span or a no-break space entity, tags stripped, blanks collapsed."""
    cut = F.regexp_extract(s, r'(?s)^(.*?)(?:&nbsp;|<span class="tag_count"|$)', 1)
    return collapse(strip_tags(unescape_basic(cut)))


def shorten(s: Column, n: int) -> Column:
    t = collapse(s)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def cell(s: Column, most: int = 32767) -> Column:
    """A spreadsheet cell: no XML control characters, at most ``most`` characters with ... at the end."""
    t = F.regexp_replace(s, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 3), F.lit("..."))).otherwise(t)


def number_text(x: Column) -> Column:
    """1,234.50 from a thousand on; else 4 decimals from one on and 6 below, trailing zeros cut; NaN and Inf as such."""
    trim = lambda s: F.regexp_replace(s, r"\.?0+$", "")
    a = F.abs(x)
    return (F.when(F.isnan(x), "NaN").when(a == float("inf"), F.when(x > 0, "Inf").otherwise("-Inf"))
            .when(a >= 1000, F.format_number(x, 2)).when(a >= 1, trim(F.format_number(x, 4))).otherwise(trim(F.format_number(x, 6))))


def percent_text(x: Column) -> Column:
    return F.format_string("%.2f%%", x * 100)


def bar(x: Column, width: int = 20) -> Column:
    """A share as a row of full and light blocks."""
    k = F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)) * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), k), F.repeat(F.lit("░"), F.lit(width) - k))


def form_encode(s: Column) -> Column:
    """Form encoding that keeps ``~`` and encodes ``*``."""
    return F.replace(F.replace(F.url_encode(s), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def slug(s: Column) -> Column:
    """Runs of other than word characters become ``_``; a leading digit gets ``t_``; over 48 characters 39 stay with a digest."""
    t = F.regexp_replace(F.regexp_replace(s, r"(?U)\W+", "_"), "^_+|_+$", "")
    t = F.when(t.rlike(r"^\d"), F.concat(F.lit("t_"), t)).otherwise(t)
    return F.when(F.length(t) > 48, F.concat(F.substring(t, 1, 39), F.lit("_"), F.substring(F.md5(s), 1, 8))).otherwise(t)


def has_han(s: Column) -> Column:
    return s.rlike("[一-鿿]").cast("int")


def query_id(url: Column) -> Column:
    """The digits of ``id=`` in a url's query; null if there are none."""
    return F.nullif(F.regexp_extract(url, r"[?&]id=(\d+)", 1), F.lit(""))


def local_stamp(ts: Column, offset: str = "+08:00") -> Column:
    return F.date_format(F.from_utc_timestamp(ts, offset), "yyyy-MM-dd HH:mm:ss")


def transport_backoff(n: Column, base: float = 2.0, cap: float = 60.0) -> Column:
    return F.least(F.lit(cap), F.greatest(F.lit(base), base * F.pow(F.lit(2.0), n)))


def limit_backoff(n: Column, base: float = 30.0, cap: float = 120.0) -> Column:
    return F.least(F.lit(cap), base * F.pow(F.lit(2.0), n - 1))


def retry_after(header: Column, now: Column, attempt: Column) -> Column:
    """Seconds to wait, at least 1: the header's number, or its date less now, or the backoff."""
    date = F.try_to_timestamp(F.substring_index(header, ", ", -1), F.lit("dd MMM yyyy HH:mm:ss z"))
    return F.greatest(F.lit(1.0), F.coalesce(header.try_cast("double"), (F.unix_timestamp(date) - F.unix_timestamp(now)).cast("double"), limit_backoff(attempt)))


def percent_of(part: Column, total: Column) -> Column:
    return F.when(total > 0, 100.0 * part / total).otherwise(0.0)


def username(s: Column) -> Column:
    """A user's name: trimmed, white space collapsed, then entities decoded."""
    return unescape(F.regexp_replace(F.trim(s), r"\s+", " "))


def amount(x: Column) -> Column:
    """A figure with as many decimals as its size needs: 6 below 0.01, 4 below 1, else 2; 0 for zero."""
    a = F.abs(x)
    return F.when(a == 0, "0").when(a < 0.01, F.format_number(x, 6)).when(a < 1, F.format_number(x, 4)).otherwise(F.format_number(x, 2))


def ratio_text(x: Column) -> Column:
    """A ratio with two decimals; what has a zero denominator says so."""
    return F.when(F.abs(x) == float("inf"), "not computable (denominator 0)").otherwise(F.format_string("%.2f", x))


def count_lines(pairs: Column) -> Column:
    """``name: count`` of each struct (name, count), a line each."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit(": "), p["count"].cast("string"))), "\n")


def model_retry_delay(attempt: Column, base: float, limited: Column, jitter: Column | None = None) -> Column:
    """Seconds before another try: the base, at least 0.1; if limited, doubled with each attempt up to 60, plus a jitter of up to a second."""
    b = max(0.1, base)
    more = F.rand() if jitter is None else jitter
    return F.when(limited, F.least(b * F.pow(F.lit(2.0), attempt - 1), F.lit(60.0)) + more * min(1.0, b)).otherwise(F.lit(b))


def json_array_size(s: Column) -> Column:
    """Elements of a JSON array; 0 for anything else."""
    return F.coalesce(F.json_array_length(F.when(F.try_parse_json(s).isNotNull(), s)), F.lit(0))


def json_int(s: Column, path: str) -> Column:
    """A field that is a whole number or a string of digits, as a number; null for all else."""
    return F.when(F.get_json_object(s, path).rlike(r"^-?\d+$"), F.get_json_object(s, path)).try_cast("long")


def file_item_id(name: Column) -> Column:
    """The digits of a file named ``mod_<digits>.html``; null for other names."""
    return F.nullif(F.regexp_extract(name, r"^mod_(\d+)\.html$", 1), F.lit("")).cast("long")
