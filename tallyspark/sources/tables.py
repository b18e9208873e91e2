"""Tables of the session's catalogue: bucketed by key, reloaded, filled in order, copied by database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relations import key_violations
from ..operators.scan import row_numbers


def _quoted(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def build(df: DataFrame, name: str, key: str = "mod_id", buckets: int | None = None, unique: bool = True) -> DataFrame:
    """Makes or replaces table ``name``, bucketed and sorted by ``key``, and returns it.

    Joins and groupings by the key of tables with as many buckets need no exchange. Rows are brought together by key first, so there is one file a
    bucket. ``buckets`` is the session's number of shuffle partitions if not given. A null or repeated key is an error if ``unique``; the table that
    was there stays then.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if unique:
        _check_key(df, name, key)
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(_quoted(name))
    return spark.table(_quoted(name))


def _check_key(df: DataFrame, name: str, key: str) -> None:
    bad = key_violations(df, [key]).select(key).unionByName(df.where(F.col(key).isNull()).select(key)).limit(1).collect()
    if bad:
        raise ValueError(f"{name}: {key} {bad[0][0]} is null or not unique")


def reload(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Replaces all rows of an existing table by those of df; columns by name, the table's schema and buckets stay.

    Columns that df lacks, or has beside the table's, are an error, as are null or repeated keys if ``key`` is given; the old rows stay then.
    """
    spark = df.sparkSession
    names = spark.table(_quoted(name)).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"{name} has {', '.join(names)}, not {', '.join(df.columns)}")
    if key:
        _check_key(df, name, key)
    df.select(*names).write.insertInto(_quoted(name), overwrite=True)
    return spark.table(_quoted(name))


def insert_ordered(df: DataFrame, name: str, order: Sequence, place: str = "place") -> DataFrame:
    """Appends df's rows to a table in order, numbered in ``place`` on from the last number there; makes the table if it isn't there.

    A table has no order of its own, so the number keeps it. Numbers come from range partitions and the counts before each; files follow one another by number.
    """
    spark = df.sparkSession
    there = spark.catalog.tableExists(name)
    last = spark.table(_quoted(name)).agg(F.max(place)).first()[0] or 0 if there else 0
    rows = row_numbers(df, list(order), place).withColumn(place, (F.col(place) + last).cast("long"))
    rows = rows.repartitionByRange(place).sortWithinPartitions(place)
    if there:
        rows.select(*spark.table(_quoted(name)).columns).write.insertInto(_quoted(name))
    else:
        rows.write.format("parquet").saveAsTable(_quoted(name))
    return spark.table(_quoted(name))


def copy_database(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copies every table of one database over those of the same name in another, by name; returns the names.

    Schema and buckets come along. A source that isn't there or has no table is an error.
    """
    if not spark.catalog.databaseExists(source):
        raise ValueError(f"no database {source}")
    names = sorted(t.name for t in spark.catalog.listTables(source) if t.tableType != "TEMPORARY")
    if not names:
        raise ValueError(f"no table in {source}")
    for n in names:
        new = _quoted(f"{target}.{n}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        spark.sql(f"CREATE TABLE {new} LIKE {_quoted(f'{source}.{n}')}")
        spark.table(_quoted(f"{source}.{n}")).write.insertInto(new)
    return names
