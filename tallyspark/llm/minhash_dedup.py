"""MinHash near-duplicate documents with odd sketches (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, parts, shingle_set, word_hashes
from .components import components
from .neardup import SETS, MinHasher, NodeIds, list_array, meeting, near_links


def signatures(docs: DataFrame, hasher: MinHasher, k: int, bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, own, alt, bands): own and alt identify equal shingle sets, null for empty ones."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches):
            sets = [shingle_set(word_hashes(x.as_py()), k) for x in t.column("text")]
            s = np.array([hasher.samples(x) for x in sets], np.uint32).reshape(len(sets), len(hasher.a))
            own, alt = zip(*(set_id(x, bits) for x in sets)) if sets else ((), ())
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(own, pa.int64()), pa.array(alt, pa.int64()), list_array(hasher.band_keys(s))],
                names=["doc_id", "n_shingles", "own", "alt", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        make, "doc_id long, n_shingles long, own long, alt long, bands array<long>")


def set_id(items: np.ndarray, bits: int = 64) -> tuple[int | None, int | None]:
    """128 bits of hash in two numbers; fewer ``bits`` of the first one are for tests."""
    if not len(items):
        return None, None
    own, alt = divmod(xxhash.xxh3_128_intdigest(items.tobytes()), 2**64)
    return own % 2**bits - 2 ** (bits - 1), alt - 2**63


def shingle_sets(docs: DataFrame, wanted: DataFrame, k: int, bits: int = 64) -> DataFrame:
    """Full sets (id, n, items) of the ids in wanted(doc_id, own, alt, id), each read from a text of that document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches):
            rows = []
            for text, want in zip(t.column("text"), t.column("want").to_pylist(), strict=True):
                x = shingle_set(word_hashes(text.as_py()), k)
                c = set_id(x, bits)
                rows += [(w["id"], len(x), x.tobytes()) for w in want if (w["own"], w["alt"]) == c]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["id", "n", "items"])

    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("own", "alt", "id")).alias("want"))  # one id for each text of a document
    held = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(lists, "doc_id")
    return held.select("text", "want").mapInArrow(make, SETS).dropDuplicates(["id"])


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = 80, hasher: MinHasher | None = None, scratch: Scratch | None = None, bits: int = 64) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked if 100 * intersection >= threshold * union of their shingle sets; components
    carry the smallest doc_id they reach. Equal sets, by 128 bits of hash, are one node from the start, so a
    large group of copies costs one comparison. Null or empty texts have an empty set and stay alone;
    a row without doc_id is linked with nothing, is kept and has a null component; rows that share a
    doc_id are one document, which is linked with all that any of its texts is linked with.
    Other columns are ignored; an empty table gives an empty result.
    """
    hasher = hasher or MinHasher()
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    sig = scratch.save(signatures(docs, hasher, shingle_words, bits))
    ids, settled = NodeIds(), False
    while not settled:
        usable = ids.of(sig.where("own is not null and doc_id is not null"))
        first = scratch.save(usable.groupBy("id").agg(F.min("doc_id").alias("rep"), F.min("own").alias("own"), F.min("alt").alias("alt"), ids.differ().alias("mixed")))
        settled = ids.settled(first)
    same = scratch.save(usable.select("doc_id", "id").join(first.select("id", "rep"), "id").where("doc_id <> rep").select("doc_id", "rep").distinct())
    nodes = usable.join(first.select("id", "rep"), "id").where("doc_id = rep").select("id", F.explode("bands").alias("h"))
    some = usable.where("pmod(xxhash64(doc_id), 256) = 0").select("id", F.explode("bands").alias("h"))
    met = scratch.save(meeting(nodes, some, scratch))
    sets_of = lambda wanted: shingle_sets(docs, first.join(wanted, "id").select(F.col("rep").alias("doc_id"), "own", "alt", "id"), shingle_words, bits)
    links, _ = near_links(met, sets_of, scratch, threshold)
    scratch.free(met)
    at = lambda x: first.select(F.col("id").alias(x), F.col("rep").alias("r" + x))
    edges = links.join(at("a"), "a").join(at("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    roots = components(edges.unionByName(same.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))), scratch)
    scratch.free(first, same, links)
    out = sig.select("doc_id", "n_shingles").join(roots.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
