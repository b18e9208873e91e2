"""Derived columns of catalogue items: flags, ratios, tiers, tags, text of lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse

_PRIVATE = "(test|debug|tmp|temp|private|for me|my |mine|backup|demo|自用|测试|临时)"
#: Names of items made for their maker alone, as a pattern; any letter is part of a word.
PRIVATE_NAME = rf"(?iU)(?:^|\b){_PRIVATE}(?:\b|$)"
_EDGE = r"(?-iu:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
#: The same as SQL reads it: words are of ASCII letters, digits and underscores, the end is that of the text, not of its last line, and an i has a dot in lower case only.
PRIVATE_NAME_SQL = rf"(?iu)(?:^|{_EDGE}){_PRIVATE.replace('i', '(?-iu:[Ii])')}(?:{_EDGE}|\z)"
#: Canonical tags.
TAGS = (
    "AI", "Alternative History", "Balance", "Cultures and Religions", "Diplomacy", "Economy and Buildings", "Events", "Expansion",
    "Fixes", "Flags", "Gameplay", "Graphics", "Historical", "Journal Entries", "Laws", "Map", "Military", "New Nations", "Politics",
    "Pops", "Technologies", "Total Conversion", "Trade", "Utilities",
)
#: Other spellings of tags, in lower case.
TAG_ALIASES = {
    "alternate history": "Alternative History", "alternete history": "Alternative History", "alternative": "Alternative History",
    "culture and religions": "Cultures and Religions", "cultures and religions": "Cultures and Religions",
    "economy": "Economy and Buildings", "economy and buildings": "Economy and Buildings", "fixed": "Fixes", "fix": "Fixes",
    "history": "Historical", "historicall": "Historical", "journal_entries": "Journal Entries", "new nations": "New Nations",
    "technology": "Technologies", "utilities": "Utilities", "utility": "Utilities", "warfare": "Military", "warefare": "Military",
}
#: Least subscribers of tiers 1, 2, 3.
TIERS = (100, 1000, 10000)


def private_like(name: Column, exposure: Column, subscribers: Column, favorites: Column, telling: str = PRIVATE_NAME) -> Column:
    """1 if an item seems made for its maker alone: hardly seen, or little used with a telling name."""
    return (F.when((subscribers >= 100) | (favorites >= 20) | (exposure >= 2000), 0)
            .when((subscribers <= 10) & (favorites <= 1) & (exposure <= 80), 1)
            .when((subscribers <= 50) & name.rlike(telling), 1).otherwise(0))


def ratio(part: Column, whole: Column, places: int = 3) -> Column:
    """part / whole, rounded half up; null where whole is not positive."""
    return F.when(whole > 0, F.round(part.cast("double") / whole, places))


def tier(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(TIERS, 1):
        out = F.when(n >= least, i).otherwise(out)
    return out


def canonical_tag(s: Column) -> Column:
    """The canonical spelling of a tag by alias or by name, without regard to case; null if unknown."""
    known = {t.lower(): t for t in TAGS} | TAG_ALIASES
    table = F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv])
    return F.try_element_at(table, F.lower(collapse(s)))


def tag_flags(df: DataFrame, key: str, tags: str, values=TAGS) -> DataFrame:
    """A 0/1 column ``has_<slug>`` for each value, from an array of tags."""
    name = lambda t: "has_" + "_".join(t.lower().replace("-", " ").split())
    return df.select(key, *[F.coalesce(F.array_contains(tags, t), F.lit(False)).cast("int").alias(name(t)) for t in values])


def in_scope(items: DataFrame, flags: DataFrame, key: str = "mod_id", flag: str = "is_private_like") -> DataFrame:
    """Items not flagged; an item without a flag row counts as not flagged."""
    return items.join(flags.where(F.col(flag) == 1), key, "left_anti")


def compact_titles(titles: Column, most: int = 12, chars: int = 140) -> Column:
    """The first ``most`` non-blank titles, each cut to ``chars`` characters."""
    kept = F.filter(F.transform(titles, lambda t: F.trim(t)), lambda t: F.coalesce(t != "", F.lit(False)))
    return F.transform(F.slice(kept, 1, most), lambda t: F.substring(t, 1, chars))


def star_name(src: Column) -> Column:
    """Base name of an image url without query and ``.png``."""
    return F.regexp_extract(src, r"([^/?]+?)(\.png)?(\?.*)?$", 1)


def id_folder(number: Column, width: int = 0) -> Column:
    """Folder of a numbered page: its first two characters, zero-padded to ``width`` first if given."""
    s = number.cast("string")
    return F.substring(F.lpad(s, width, "0") if width else s, 1, 2)


def script_mix(s: Column, most: float = 0.9) -> Column:
    """en or zh if the Latin or the Han letters are at least ``most`` of both, mixed if neither, unknown without any."""
    han, latin = F.regexp_count(s, F.lit("[一-鿿]")), F.regexp_count(s, F.lit("[A-Za-z]"))
    both = han + latin
    return F.when(F.coalesce(both, F.lit(0)) == 0, "unknown").when(han >= most * both, "zh").when(latin >= most * both, "en").otherwise("mixed")


#: A line of a text that says nothing of the item itself.
BOILERPLATE = r"(?i)^\s*(https?://\S+|(version|v)\s*[\d.]+|(license|licence|copyright|all rights reserved|terms of|subscribe|please)\b.*|\W*)\s*$"


def corpus_rows(df: DataFrame, key: str, text: str, least_chars: int = 100) -> DataFrame:
    """(key, content_hash, n_chars, excluded, tier): too short, a repeat of an earlier row's text, or boilerplate lines only; quality by length."""
    t = collapse(F.coalesce(F.col(text), F.lit("")))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    rows = df.select(key, F.md5(t).alias("content_hash"), F.length(t).alias("n_chars"), F.forall(lines, lambda x: x.rlike(BOILERPLATE)).alias("_bare"))
    first = rows.groupBy("content_hash").agg(F.min(key).alias("_first"))
    why = F.when(F.col("n_chars") < least_chars, "too_short").when(F.col(key) != F.col("_first"), "duplicate").when(F.col("_bare"), "boilerplate_only")
    level = F.when(F.col("n_chars") >= 2000, "A").when(F.col("n_chars") >= 500, "B").otherwise("C")
    return rows.join(first, "content_hash").select(key, "content_hash", "n_chars", why.alias("excluded"), level.alias("tier"))


def group_label(flag: Column, one: str = "domestic", other: str = "international") -> Column:
    """The label of a 0/1 flag; anything but 1 counts as 0."""
    return F.when(flag == 1, one).otherwise(other)


def has_category(categories: Column, number: int = 30, word: str = "workshop") -> Column:
    """Whether any of the structs (id, description) has this id or names the word; false for none."""
    return F.coalesce(F.exists(categories, lambda c: F.coalesce(c["id"] == number, F.lit(False)) | F.contains(F.lower(F.coalesce(c["description"], F.lit(""))), F.lit(word))), F.lit(False))


def created_time(files: DataFrame, first: int = 9) -> DataFrame:
    """files(row_id, file, size, modified) -> (file, modified): the data's age.

    The least of the ids 1 to ``first`` that has a non-empty file tells it, else the earliest non-empty file.
    """
    rank = F.when(F.col("row_id").between(1, first), F.col("row_id")).otherwise(first + 1)
    key = F.struct(rank.alias("r"), F.when(rank > first, F.col("modified")).alias("m"), "file")
    return files.where("size > 0").agg(F.min_by(F.struct("file", "modified"), key).alias("z")).where("z is not null").select("z.*")


def corpus_view(df: DataFrame, key: str, title: str, description: str, requires: str | None = None) -> DataFrame:
    """(key, text): title, a blank line, description, and a line ``Requires: ...`` if an array of names is given and not empty."""
    more = [F.when(F.size(requires) > 0, F.concat(F.lit("Requires: "), F.array_join(requires, ", ")))] if requires else []
    return df.select(key, F.concat_ws("\n\n", F.nullif(F.trim(title), F.lit("")), F.nullif(F.trim(description), F.lit("")), *more).alias("text"))
