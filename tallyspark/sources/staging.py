"""Durable intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def mounted(path: str) -> str:
    """A path as Python opens it: without ``file:``. Other schemes than that are no path of this kind."""
    plain = re.sub(r"^file:(?://)?(?=/)", "", path)
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:/", plain):
        raise ValueError(f"{path} is not in a folder that driver and executors mount")
    return plain


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session, dots as two underscores, for what runs inside."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def lean(f: Callable) -> Callable:
    """For a function of a frame that saves its steps: each step's shuffle files go when it is saved, and not when the driver collects garbage."""
    @wraps(f)
    def run(df: DataFrame, *args, **kwargs):
        with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            return f(df, *args, **kwargs)

    return run


class Scratch:
    """Intermediate Parquet tables under the shared folder in ``spark.checkpoint.dir``.

    Each table cuts lineage durably: a lost executor only re-reads files. Only a session on one machine
    (master ``local``), as in tests, may name no folder; it gets a temporary one.
    """

    def __init__(self, spark: SparkSession, label: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            root = f"file://{tempfile.mkdtemp(prefix='tallyspark-')}"
        self.spark, self.root, self.n = spark, f"{root}/{label}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.tables: list[str] = []
        atexit.register(self.drop)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def bucketed(self, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """Like ``save``, as a table of so many buckets by ``key``, whose joins and groupings by it need no exchange; df comes partitioned that way."""
        self.n += 1
        name = f"scratch_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, key).option("path", f"{self.root}/{self.n}").saveAsTable(name)
        self.tables.append(name)
        out = self.spark.table(name)
        self.paths[id(out)] = out, f"{self.root}/{self.n}"
        return out

    def free(self, *tables: DataFrame) -> None:
        """Deletes tables from ``save`` or ``bucketed`` that nothing reads any more."""
        for t in tables:
            _, path = self.paths.pop(id(t), (None, None))
            if path:
                self._delete(path)

    def drop(self) -> None:
        """Deletes all tables; called when the driver exits, since returned frames read them lazily."""
        self.paths.clear()
        try:
            while self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")
            self._delete(self.root)
        except Exception:  # the JVM may have gone first
            pass

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
