"""Pages as files: one HTML file a page, in folders by the first digits of its number."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.derive import id_folder
from .staging import mounted


def write_pages(pages: DataFrame, page_id: str, html: str, root: str, width: int = 6) -> int:
    """Writes each page that has a number and a text as <root>/<folder>/<number>.html and returns how many.

    A file gets its name only when it is whole, so a reader sees no part of one and a task that runs again does no harm. Of repeated numbers the
    text that comes last in order stays. The root must lie in a folder that driver and executors share. What was written is listed in a table
    below the root, so that those who read the pages need no list of all files.
    """
    at = mounted(root)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = []
            for number, folder, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                path = f"{at}/{folder}/{number:0{width}d}.html"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(f"{path}.{os.getpid()}", "w", encoding="utf-8", newline="") as out:
                    out.write(text)
                os.replace(f"{path}.{os.getpid()}", path)
                names.append(f"{folder}/{number:0{width}d}.html")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    rows = pages.where((F.col(html) != "") & F.col(page_id).isNotNull()).groupBy(F.col(page_id).cast("long").alias("number")).agg(F.max(html).alias("text"))
    rows = rows.select("number", id_folder(F.col("number"), width).alias("folder"), "text")
    count = Observation()
    rows.mapInArrow(work, "name string").observe(count, F.count("*").alias("n")).write.mode("append").parquet(f"{root}/{WRITTEN}")
    return count.get["n"]


#: The table of what was written, below a root of pages.
WRITTEN = "_written"


def read_listed(names: DataFrame, root: str, together: int = 64) -> DataFrame:
    """names(name) -> (row_id, file, html, modified): the pages of these names below root, each read by the task that has its name, some at a time."""
    at = mounted(root)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, together):
                out = []
                for name in b.column("name").slice(first, together).to_pylist():
                    with open(f"{at}/{name}", "rb") as page:
                        out.append((os.path.basename(name), page.read().decode("utf-8", "replace"), os.fstat(page.fileno()).st_mtime_ns // 1_000_000 * 1000))
                kinds = pa.string(), pa.string(), pa.timestamp("us", "UTC")
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["file", "html", "modified"])

    pages = names.select("name").mapInArrow(work, "file string, html string, modified timestamp")
    return pages.select(F.regexp_extract("file", r"(\d+)\.html$", 1).try_cast("long").alias("row_id"), "file", "html", "modified")
