"""The corpus pipeline: five stages from raw documents to a weighted training mix.

A stage known by name takes (spark, docs, sf_dir). Its working tables are gone when it returns; what is left for the
returned frame to read, ids or places of what goes, lies in its scratch space, which ``run`` gives up
once the stage's rows are written. Stages share nothing, so pipelines in one session don't meet.

Rows are known by ``_key``: their doc_id, or without one a number from a hash of the text, so such rows pass every
stage as others do. Columns of docs are carried in one struct and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import Scratch, load
from tallyspark.llm.decontaminate import contained_items
from tallyspark.llm.minhash_dedup import near_duplicates
from tallyspark.llm.mixing import mix
from tallyspark.llm.paragraph_dedup import repeated_paragraphs, without_paragraphs
from tallyspark.llm.toxicity import without_toxic


def _key() -> Column:
    """doc_id, or for rows without one a number of at least 2**62, beyond all ids."""
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 3)
    return F.coalesce(F.col("doc_id").cast("long"), own)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), _key().alias("doc_id"), F.col("text"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, load(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id, one without an id only if none has one.

    Of rows that repeat an id and a text one stays, that with the least hash of all columns.
    """
    left, work = scratch or Scratch(spark, "near-dedup"), Scratch(spark, "near-dedup-work")
    held = _keyed(docs)
    if not held.groupBy("doc_id").count().where("count > 1").isEmpty():
        held = held.groupBy("doc_id", "text").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        held = work.save(held)  # read several times; the last read is that of the kept rows
        gone = work.save(near_duplicates(held, scratch=work).where("not kept").select("doc_id").distinct())
        out = left.save(held.join(gone, "doc_id", "left_anti").select("row.*"))
    else:
        gone = left.save(near_duplicates(held, scratch=work).where("not kept").select("doc_id").distinct())
        out = held.join(gone, "doc_id", "left_anti").select("row.*")
    work.drop()
    return out


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Repeated passages stay in their first document only. Passages of under 16 words, single phrases and lines, are left alone."""
    left, work = scratch or Scratch(spark, "substring-dedup"), Scratch(spark, "substring-dedup-work")
    found = repeated_paragraphs(_keyed(docs).select("doc_id", "text"), scratch=work)
    spans = left.save(found.where("not kept").select("doc_id", "t", "start", "n_words"))
    work.drop()
    return without_paragraphs(docs, _key(), spans)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that contain a benchmark item go."""
    left, work = scratch or Scratch(spark, "decontamination"), Scratch(spark, "decontamination-work")
    held = _keyed(docs)
    hits = left.save(contained_items(held.select("doc_id", "text"), load(spark, sf_dir, "benchmark"), scratch=work).select("doc_id").distinct())
    work.drop()
    return held.join(hits, "doc_id", "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """The documents with how many words the mix takes of each: their columns, then size, source_size, target and taken.

    A new column whose name docs already has is called mix_size and so on, with as many ``mix_`` as make it new.
    """
    rows = docs.select(F.struct("*").alias("row"), _key().alias("doc_id"), "text", "source")
    mixed = mix(rows, keep=["row"], scratch=scratch or Scratch(spark, "mixing"))
    there, new = {c.lower() for c in docs.columns}, []
    for c in ("size", "source_size", "target", "taken"):
        name = c
        while name in there:
            name = f"mix_{name}"
        new.append(F.col(c).alias(name))
    return mixed.select("row.*", *new)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing),
]

#: The toxicity network has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        own = Scratch(spark, name.replace("_", "-"))
        docs = scratch.save(stage(spark, docs, sf_dir, own))
        own.drop()
    return docs
