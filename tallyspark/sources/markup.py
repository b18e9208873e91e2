"""Catalogue pages to rows: list pages, item pages and the hub page."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import author_name, collapse, loose_int, strict_int, tag_display, unescape, unescape_all
from ..operators.derive import canonical_tag, star_name

#: Fixed values of the page format: marks of sections, payloads and fields.
ITEMS_FROM, ITEMS_TO = 'class="workshopBrowseItems"', 'class="workshopBrowsePaging"'
HOVER = "SharedFileBindMouseHover"
PARAMS = r"(?s)var\s+paramsGET\s*=\s*(\{.*?\})\s*;"
SHOWING = '(?i)workshopBrowsePagingInfo">Showing\\s+([\\d,\\s ]+)-[\\d,\\s ]+\\s+of'
TAG_LABEL = r"(?i)searchedForTerm[^>]*>\s*Tag:\s*([^<]+?)\s*<"
RATING = r'(?i)<img\s+class="fileRating"\s+src="([^"]+)"'
AUTHOR = r'(?i)<a\s+class="workshop_author_link"[^>]*>([^<]*)</a>'
ITEM_ID = r"(?i)var\s+publishedfileid\s*=\s*'(\d+)'"
ITEM_TITLE = r'(?is)<div class="workshopItemTitle">(.*?)</div>'
TAG_LINK = r'(?i)requiredtags%5B%5D=[^"&>]+">([^<]+)</a>'
APP_ID = (r'(?i)<input[^>]*\bname="appid"[^>]*\bvalue="(\d+)"', r'(?i)"APPID"\s*:\s*(\d+)')
FILTER = r'(?is)<div[^>]*\bclass="[^"]*\bfilterOption\b[^"]*"[^>]*>.*?<input[^>]*\bname="requiredtags\[\]"[^>]*\bvalue="([^"]*)"[^>]*>.*?<label[^>]*\bclass="tag_label"[^>]*>(.*?)</label>'
TAG_COUNT = r'(?is)<span[^>]*\bclass="tag_count"[^>]*>\(([^)]+)\)</span>'
SEE_ALL = r"(?i)See\s+all\s+([\d\s.,']+)\s+Items"
NO_TAG = "No_selected_tag"
CORE_MARKS = ("workshopitemtitle", "stats_table")


def items_section(page: Column) -> Column:
    """From the items' mark to the next paging mark or the end; '' without items."""
    at = F.locate(ITEMS_FROM, page)
    rest = F.substr(page, at)
    end = F.locate(ITEMS_TO, rest)
    return F.when(at == 0, "").when(end == 0, rest).otherwise(F.substr(rest, F.lit(1), end - 1))


_DECODER = json.JSONDecoder()
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.S)


def braced(text: str, at: int) -> str | None:
    """The balanced {...} that opens at ``at``; braces inside JSON strings don't count."""
    try:
        return text[at : _DECODER.raw_decode(text, at)[1]]
    except ValueError:
        depth = 0
    for t in _TOKEN.finditer(text, at):
        depth += (t[0] == "{") - (t[0] == "}")
        if not depth and t[0] == "}":
            return text[at : t.end()]
    return None


def _payloads(page: str | None) -> Iterator[dict]:
    page = page or ""
    at = page.find(HOVER)
    while at >= 0:
        brace = page.find("{", at)
        text = braced(page, brace) if brace >= 0 else None
        try:
            x = json.loads(text) if text else None
        except ValueError:
            x = None
        if isinstance(x, dict) and x.get("id"):
            yield {k: str(x.get(k, "")).strip() for k in ("id", "title", "description")}
        at = page.find(HOVER, at + len(HOVER))


_PAYLOADS = pa.list_(pa.struct([(k, pa.string()) for k in ("id", "title", "description")]))


def _all_payloads(pages: pa.Array) -> pa.Array:
    """A few pages at a time are Python objects."""
    some = [pa.array([list(_payloads(p)) for p in pages.slice(i, 16).to_pylist()], _PAYLOADS) for i in range(0, len(pages), 16)]
    return pa.concat_arrays(some) if some else pa.array([], _PAYLOADS)


def hover_payloads(page: Column) -> Column:
    """The JSON objects after each hover mark that have an id; broken ones are left out."""
    return F.arrow_udf(_all_payloads, "array<struct<id:string,title:string,description:string>>")(page)


def page_tag(page: Column) -> Column:
    """The first required tag of the page's parameters, NO_TAG if it asks for none, else the tag in its label."""
    params = F.regexp_extract(page, PARAMS, 1)
    tags = F.from_json(F.get_json_object(params, "$.requiredtags"), "array<string>")
    given = F.trim(F.try_element_at(tags, F.lit(1)))
    valid = F.try_parse_json(params).isNotNull()
    none = valid & (F.get_json_object(params, "$.requiredtags").isNull() | (F.size(tags) == 0))
    return F.when(given != "", given).when(none, NO_TAG).otherwise(F.nullif(F.trim(unescape(F.regexp_extract(page, TAG_LABEL, 1))), F.lit("")))


def list_entries(pages: DataFrame, page_id: str, html: str, detail_base: str) -> DataFrame:
    """(page_id, tag, entries) of list pages, entries being structs of rank, item_id, title, description, star_rating, author, detail_url.

    Payloads, ratings and authors are paired by position up to the shortest; ranks count from the page's
    first number, and entries whose id isn't digits are dropped after numbering.
    """
    section = items_section(F.col(html))
    p = pages.select(
        page_id, page_tag(F.col(html)).alias("tag"), F.coalesce(F.nullif(loose_int(F.regexp_extract(html, SHOWING, 1)), F.lit(0)), F.lit(1)).alias("_from"),
        hover_payloads(F.col(html)).alias("_p"), F.regexp_extract_all(section, F.lit(RATING)).alias("_r"), unescape_all(F.regexp_extract_all(section, F.lit(AUTHOR))).alias("_a"))
    n = F.least(F.size("_p"), F.size("_r"), F.size("_a"))
    entry = lambda z, i: F.struct(
        (F.col("_from") + i).alias("rank"), z["_p"]["id"].alias("item_id"), z["_p"]["title"].alias("title"), z["_p"]["description"].alias("description"), star_name(z["_r"]).alias("star_rating"),
        author_name(z["_a"]).alias("author"), F.concat(F.lit(detail_base), z["_p"]["id"]).alias("detail_url"))
    entries = F.transform(F.slice(F.arrays_zip("_p", "_r", "_a"), F.lit(1), n), entry)
    return p.select(page_id, "tag", F.filter(entries, lambda e: e["item_id"].rlike("^[0-9]+$")).alias("entries"))


def list_rows(pages: DataFrame, page_id: str, html: str, detail_base: str) -> DataFrame:
    """(page_id, tag, rank, item_id, title, description, star_rating, author, detail_url): the entries of list pages as rows."""
    return list_entries(pages, page_id, html, detail_base).select(page_id, "tag", F.inline("entries"))


def labelled_int(page: Column, label: str) -> Column:
    """The number in the table row before this label, or 0."""
    return loose_int(F.regexp_extract(page, rf"(?i)<tr>\s*<td>\s*([\d,]+)\s*</td>\s*<td>\s*{label}\s*</td>\s*</tr>", 1))


def detail_rows(pages: DataFrame, html: str) -> DataFrame:
    """(item_id, name, exposure, subscribers, favorites, tags) of item pages; pages without id or title give none."""
    h = F.col(html)
    rows = pages.select(F.regexp_extract(h, ITEM_ID, 1).alias("item_id"), unescape(collapse(F.regexp_extract(h, ITEM_TITLE, 1))).alias("name"),
                        labelled_int(h, "Unique Visitors").alias("exposure"), labelled_int(h, "Current Subscribers").alias("subscribers"), labelled_int(h, "Current Favorites").alias("favorites"),
                        F.array_distinct(F.filter(F.transform(F.regexp_extract_all(h, F.lit(TAG_LINK)), canonical_tag), lambda t: t.isNotNull())).alias("tags"))
    return rows.where("item_id <> '' and name <> ''")


def hub_row(pages: DataFrame, html: str, url: str) -> DataFrame:
    """(app_id, tags, items) of hub pages: the id by fallbacks, (name, count) of each tag block, the largest total."""
    h = F.col(html)
    some = lambda c: F.nullif(c, F.lit(""))
    app = F.coalesce(*[some(F.regexp_extract(h, p, 1)) for p in APP_ID], *[some(F.regexp_extract(x, r"(?i)/app/(\d+)/workshop", 1)) for x in (F.col(url), h)])
    names, labels = F.regexp_extract_all(h, F.lit(FILTER), F.lit(1)), F.regexp_extract_all(h, F.lit(FILTER), F.lit(2))
    tags = F.transform(F.arrays_zip(names.alias("v"), labels.alias("l")), lambda z: F.struct(
        F.coalesce(some(tag_display(z["l"])), F.url_decode(z["v"])).alias("name"), strict_int(F.regexp_extract(z["l"], TAG_COUNT, 1)).alias("count")))
    total = F.array_max(F.transform(F.regexp_extract_all(h, F.lit(SEE_ALL)), strict_int))
    fail = lambda c, why: F.when(c.isNull(), F.raise_error(F.lit(why)).cast("long")).otherwise(c.cast("long"))
    return pages.select(fail(app, "no app id").alias("app_id"), tags.alias("tags"), fail(total, "no total").alias("items"))


def page_status(page: Column, mark: str = ITEMS_FROM) -> Column:
    """missing, empty, invalid (no mark in the first 200,000 characters) or ok."""
    return F.when(page.isNull(), "missing").when(page == "", "empty").when(F.contains(F.substring(page, 1, 200_000), F.lit(mark)), "ok").otherwise("invalid")


def is_invalid(page: Column, hijack_marks: tuple[str, ...] = (), least: int = 2000) -> Column:
    """Whether an item page is not one: no core mark, and a sign of a login page or too short."""
    low = F.lower(page)
    has = lambda marks: F.coalesce(*[F.when(F.contains(low, F.lit(m)), True) for m in marks], F.lit(False)) if marks else F.lit(False)
    return F.when(has(CORE_MARKS), False).when(has(hijack_marks), True).otherwise(F.length(page) < least)


def plain_page(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """(page_id, lang, title, h1, links) of any page."""
    h = F.col(html)
    return pages.select(page_id, F.regexp_extract(h, r'(?i)<html[^>]*\blang="([^"]*)"', 1).alias("lang"), F.regexp_extract(h, r"(?is)<title>(.*?)</title>", 1).alias("title"),
                        F.regexp_extract(h, r"(?is)<h1[^>]*>(.*?)</h1>", 1).alias("h1"), F.size(F.regexp_extract_all(h, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'))).cast("long").alias("links"))


def page_links(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """(page_id, position, href) of every link."""
    return pages.select(page_id, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'))).alias("position", "href"))


def unfiltered(page: Column) -> Column:
    """Whether a list page asks for no tag."""
    return F.coalesce(page_tag(page) == NO_TAG, F.lit(False))


def item_id(page: Column) -> Column:
    """An item page's id; null without one."""
    return F.nullif(F.regexp_extract(page, ITEM_ID, 1), F.lit(""))
