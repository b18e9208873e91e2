"""Readers: pages, url and id lists, number series, item records, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import page_files

HUB = "APPID int, tags array<struct<name:string,count:int>>, tag_count int, workshop_item_count int, source_url string"


#: Given to ``text`` itself, whose defaults would outweigh options of the reader.
_PAGES = {"wholetext": True, "recursiveFileLookup": True, "pathGlobFilter": "*.html"}


def _page_rows(df: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return df.select(F.regexp_extract(name, r"(\d+)\.html$", 1).try_cast("long").alias("row_id"), name.alias("file"), F.col("value").alias("html"),
                     F.col("_metadata.file_modification_time").alias("modified"))


def pages(spark: SparkSession, root: str) -> DataFrame:
    """(row_id, file, html, modified) of all HTML files below root; row_id from the file's digits, null if it has none.

    Malformed UTF-8 is replaced. Order is a sort key, (row_id nulls last, file), not a property of the table.
    """
    return _page_rows(spark.read.text(root, **_PAGES))


def page_stream(spark: SparkSession, root: str, files_a_batch: int = 10_000) -> DataFrame:
    """``pages`` as a stream: a query with a checkpoint reads each file once, in the run that first sees it."""
    return _page_rows(spark.readStream.option("maxFilesPerTrigger", files_a_batch).schema("value string").text(root, **_PAGES))


def written_pages(spark: SparkSession, root: str) -> DataFrame:
    """``pages`` of a root that ``write_pages`` filled, by its table of what was written: the driver lists no pages. An error if there is none."""
    names = spark.read.schema("name string").parquet(f"{root}/{page_files.WRITTEN}").distinct()
    if names.isEmpty():
        raise FileNotFoundError(f"no page below {root}")
    return page_files.read_listed(names, root)


def written_page_stream(spark: SparkSession, root: str, files_a_batch: int = 10_000) -> DataFrame:
    """``written_pages`` as a stream: a query with a checkpoint reads each page once, in the run that first sees its name; a batch is so many files of names.

    The driver lists the files of names, one a task of a writer; which names came before is state of the query.
    """
    names = spark.readStream.option("maxFilesPerTrigger", files_a_batch).schema("name string").parquet(f"{root}/{page_files.WRITTEN}")
    return page_files.read_listed(names.dropDuplicates(["name"]), root)


def hub_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object, checked against its schema."""
    df = spark.read.schema(HUB).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df.withColumn("APPID", F.when(F.col("APPID").isNull(), F.raise_error(F.lit("no APPID")).cast("int")).otherwise(F.col("APPID")))


def _strings(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.coalesce(F.from_json("value", "array<string>"), F.from_json("value", "ids array<string>")["ids"]).alias("s"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, url): a JSON array of strings, numbered from 1; a blank or null entry is an error."""
    rows = _strings(spark, path).select(F.posexplode("s").alias("i", "url"))
    bad = F.col("url").isNull() | (F.trim("url") == "")
    return rows.select((F.col("i") + 1).alias("row_id"), F.when(bad, F.raise_error(F.lit("blank url")).cast("string")).otherwise(F.col("url")).alias("url"))


def id_list(spark: SparkSession, path: str, base: str) -> DataFrame:
    """(id, url) of the digit strings in a JSON array or in {"ids": [...]}."""
    rows = _strings(spark, path).select(F.explode("s").alias("id")).where(F.col("id").rlike("^[0-9]+$"))
    return rows.select("id", F.concat(F.lit(base), "id").alias("url"))


def series(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a number series: .json (array, or {"prestiges": [...]}), .txt by line, .csv the first number of each row."""
    if path.endswith(".json"):
        text = spark.read.text(path, wholetext=True)
        return text.select(F.explode(F.coalesce(F.from_json("value", "array<double>"), F.from_json("value", "prestiges array<double>")["prestiges"])).alias("value"))
    lines = spark.read.text(path)
    cells = F.split("value", ",") if path.endswith(".csv") else F.array("value")
    numbers = F.filter(F.transform(cells, lambda c: F.trim(c).try_cast("double")), lambda x: x.isNotNull())
    return lines.select(F.try_element_at(numbers, F.lit(1)).alias("value")).where("value is not null")


def author_items(spark: SparkSession, path: str) -> DataFrame:
    """(author, mod_titles) records of a JSON array; a record without author is an error."""
    df = spark.read.schema("author string, mod_titles array<string>").option("multiLine", True).json(path)
    return df.withColumn("author", F.when(F.col("author").isNull(), F.raise_error(F.lit("record without author")).cast("string")).otherwise(F.col("author")))


def column_values(spark: SparkSession, table: str, column: str) -> DataFrame:
    return spark.table(table).select(column).where(F.col(column).isNotNull())


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """(table, column) of the catalogue; no rows if the table isn't there."""
    names = [c.name for c in spark.catalog.listColumns(table)] if spark.catalog.tableExists(table) else []
    return spark.createDataFrame([(table, n) for n in names], "table string, column string")


def required_pages(spark: SparkSession, root: str) -> DataFrame:
    """The pages below root; an error if there is none."""
    df = pages(spark, root)
    if df.select("file").isEmpty():
        raise FileNotFoundError(f"no page below {root}")
    return df


def required_table(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """The table; an error if it isn't there, lacks a column or has no row."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    df = spark.table(table)
    lacks = [c for c in columns if c not in df.columns]
    if lacks:
        raise ValueError(f"{table} lacks {', '.join(lacks)}")
    if df.isEmpty():
        raise ValueError(f"{table} is empty")
    return df
