"""A data source that writes one text file: parts by task, put together and renamed at commit."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .staging import Scratch, mounted

#: Byte order mark of UTF-8, as spreadsheet programs expect it.
MARK = b"\xef\xbb\xbf"


@dataclass
class Part(WriterCommitMessage):
    order: int
    path: str
    lines: int


#: What stands for a missing cell while a line is read. No cell is read as this text: Spark's reader leaves out a NUL after a quote.
_MISSING = '"\0'
_CELLS = {"escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


class OneFileWriter(DataSourceArrowWriter):
    """Each attempt of a task writes a part of its own beside the target; only those that Spark commits are used.

    The parts go into one new file in order of their partitions, which then takes the target's name in one step. A reader sees the old file or the
    new one. An aborted write removes its parts and leaves the target alone.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path = mounted(options["path"])
        self.mark = options.get("mark", "false").lower() == "true"
        self.head, self.foot, self.end = (options.get(k, v) for k, v in (("head", ""), ("foot", ""), ("end", "\n")))
        self.overwrite, self.parts = overwrite, f"{self.path}.parts-{uuid.uuid4().hex}"
        if not self.overwrite and os.path.exists(self.path):
            raise FileExistsError(self.path)
        os.makedirs(self.parts)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        path, n, end = f"{self.parts}/{task.partitionId():08d}-{task.taskAttemptId()}", 0, self.end.encode()
        with open(path, "wb") as out:
            for b in batches:
                for x in b.column(0):
                    out.write((x.as_py() or "").encode() + end)
                n += b.num_rows
        return Part(task.partitionId(), path, n)

    def commit(self, messages: list[Part | None]) -> None:
        whole = f"{self.parts}/whole"
        with open(whole, "wb") as out:
            out.write(MARK * self.mark + self.head.encode())
            for m in sorted((m for m in messages if m), key=lambda m: m.order):
                with open(m.path, "rb") as part:
                    shutil.copyfileobj(part, out, 1 << 20)
            out.write(self.foot.encode())
            out.flush()
            os.fsync(out.fileno())
        os.replace(whole, self.path)
        shutil.rmtree(self.parts)

    def abort(self, messages: list[Part | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


class OneFile(DataSource):
    """``df.write.format("onefile").option("path", ...)`` for a frame of one text column, a line a row.

    Options: head and foot, text before and after the lines; mark, whether a byte order mark comes first; end, what ends a line.
    The path must lie in a folder that driver and executors share; mode append means that no file may be there yet.
    """

    @classmethod
    def name(cls) -> str:
        return "onefile"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> OneFileWriter:
        if len(schema.fields) != 1 or schema.fields[0].dataType.simpleString() != "string":
            raise ValueError("one text column is written, a line a row")
        return OneFileWriter(dict(self.options), overwrite)


def write_lines(lines: DataFrame, path: str, order: list[str] | None = None, overwrite: bool = True, **options: str) -> None:
    """Writes the column ``line`` of lines as one file, ordered by ``order``, nulls last as in SQL: ranges of rows are written side by side."""
    lines.sparkSession.dataSource.register(OneFile)
    if order:
        by = [F.asc_nulls_last(o) for o in order]
        lines = lines.repartitionByRange(*by).sortWithinPartitions(*by)
    lines.select("line").write.format("onefile").mode("overwrite" if overwrite else "append").options(path=path, **options).save()


def write_csv(df: DataFrame, path: str, order: list[str], header: list[str] | None = None, mark: bool = True, empty: str = "") -> None:
    """One CSV file with a line of names, lines ended by carriage return and line feed, for spreadsheet programs with a byte order mark.

    An empty text is written as ``empty``: two quotes tell it from a missing one.
    """
    names = header or df.columns
    cells = [F.to_csv(F.struct(F.lit(n).alias("x")), {**_CELLS, "emptyValue": '""'}).alias(f"n{i}") for i, n in enumerate(names)]
    head = ",".join(df.sparkSession.range(1).select(*cells).first())
    line = F.to_csv(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]), {**_CELLS, "emptyValue": empty})
    write_lines(df.select(*[F.col(o) for o in order], line.alias("line")), path, order, head=head + "\r\n", end="\r\n", mark=str(mark))


def write_json_list(values: DataFrame, value: str, path: str, order: list[str]) -> None:
    """One JSON array of a column's values, an element a line."""
    last = values.select(*order).orderBy(*[F.desc_nulls_first(o) for o in order]).first()
    rest = F.lit(False)
    for o in order if last else ():
        rest = rest | ~F.col(o).eqNullSafe(F.lit(last[o]))
    text = F.regexp_extract(F.to_json(F.array(value), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1)
    write_lines(values.select(*order, F.concat(F.lit("  "), text, F.when(rest, ",").otherwise("")).alias("line")), path, order, head="[\n", foot="]\n")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(value): the whole file as one text."""
    return spark.read.text(path, wholetext=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of one CSV file with a line of names, as ``write_csv`` leaves it, read by as many tasks as the file has splits.

    A line end ends a row if the quotes before it are even in number. So lines are read split by split, quotes are counted on from the splits before
    (one row a split), and lines of one row, in whatever splits they lie, are put together. A cell of two quotes is an empty text, one of nothing is missing.
    """
    at, i = F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("i")
    lines = spark.read.text(path, lineSep="\n").select("value", at, i).withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    split = Window.partitionBy("at").orderBy("i")
    lines = lines.withColumn("odd", F.coalesce(F.sum("quotes").over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    lines = Scratch(spark, "csv-lines").save(lines.withColumns({"start0": F.sum(1 - F.col("odd")).over(upto), "start1": F.sum("odd").over(upto)}))
    before = Window.partitionBy(F.lit(0)).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    per = lines.groupBy("at").agg(F.sum("quotes").alias("n"), F.max("start0").alias("s0"), F.max("start1").alias("s1"))
    per = per.withColumn("open", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2)
    per = per.select("at", "open", F.coalesce(F.sum(F.when(F.col("open") == 0, F.col("s0")).otherwise(F.col("s1"))).over(before), F.lit(0)).alias("rows"))
    row = F.col("rows") + F.when(F.col("open") == 0, F.col("start0")).otherwise(F.col("start1"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "i", "value"))), lambda z: z["value"]), "\n")
    rows = lines.join(F.broadcast(per), "at").groupBy(row.alias("row")).agg(text.alias("text")).where("row > 1")
    cells = F.from_csv(F.regexp_replace("text", "\r\\z", ""), schema, {"multiLine": "true", "escape": '"', "nullValue": _MISSING, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return rows.select(cells.alias("r")).select("r.*")
