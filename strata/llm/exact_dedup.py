"""Operator 9: exact dedup through an extendible-hash index on shared files.

Texts are equal when identical after each run of ASCII white space becomes one
space. Only DataFrame functions are used.

* **Entries.** One aggregate groups rows by hash key *and* normalised text, so
  Spark compares the bytes of every text with those already chained under its
  key; copies collapse on the map side (a hot text sends one row per task).
* **Directory.** The entries' keys are counted per cell (top 16 bits). Starting
  with one bucket, the directory doubles: every bucket with more than
  ``capacity`` entries splits on the next key bit, until none is overfull or
  the cells are reached (``MAX_DEPTH``); beyond, a bucket grows by its chains.
  Cells are at most 65,536 rows whatever the input, which bounds the broadcast.
  The aggregate decides the groups; the directory, buckets and chains are
  written with the entries, and no result reads them.
* **Index files.** Owner tasks each write a range of (bucket, key) in key
  order; entries that share a key but not the bytes get chain positions.

Defined results: a null text counts as empty; empty texts are equal to each
other; texts of any length are compared whole. A null ``doc_id`` sorts after every number; a text with only null ids
has a null ``keep_id``. Of rows repeated with the same id and text one is kept.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (WHITE_RUN, discard, keep_rows, spread, store, text_key,
                               text_or_empty)

CAPACITY = 100_000        # entries of a bucket before it splits
MAX_DEPTH = 16            # bits of the finest directory cell
OWNER_ROWS = 1_000_000    # entries of one owner task's key range


def normalised(c: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(c), WHITE_RUN, " ")


def key_bits(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key as a number from 0."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


@dataclass
class Index:
    """Stored tables. ``rows``: doc_id, key, key2, sha, n per (doc_id, text);
    ``directory``: cell, depth, bucket; ``entries``: bucket, key, key2, sha,
    chain, keep_id, group_size."""

    rows: DataFrame
    directory: DataFrame
    entries: DataFrame


def build_directory(entries: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cell -> (depth, bucket) after doubling until no bucket is overfull."""
    cells = entries.groupBy(key_bits(F.col("key"), MAX_DEPTH).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"))
    d = store(cells.withColumns({"depth": F.lit(0), "bucket": F.lit(0).cast("long")}), "exhash-cells")
    for depth in range(1, MAX_DEPTH + 1):
        over = (d.where(F.col("depth") == depth - 1).groupBy("bucket")
                .agg(F.sum("n").alias("load")).where(F.col("load") > capacity)
                .select("bucket", F.lit(depth - 1).alias("depth"), F.lit(True).alias("over")))
        d = store(d.join(F.broadcast(over), ["bucket", "depth"], "left").select(
            "cell", "n", F.when(F.col("over"), depth).otherwise(F.col("depth")).alias("depth"),
            F.when(F.col("over"), F.shiftright("cell", MAX_DEPTH - depth))
            .otherwise(F.col("bucket")).alias("bucket")), "exhash-directory")
        if d.where(F.col("depth") == depth).isEmpty():
            break
    return d.select("cell", "depth", "bucket")


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> Index:
    spark = docs.sparkSession
    base = docs.select("doc_id", normalised().alias("norm"))
    k1, k2 = text_key(F.col("norm"))
    entries = (base.groupBy(k1.alias("key"), "norm")
               .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("key", k2.alias("key2"), F.sha2("norm", 256).alias("sha"),
                       "keep_id", "group_size"))
    entries = store(entries, "exhash-entries")
    directory = build_directory(entries, capacity)
    n = entries.count()
    # every cell of an entry is in the directory, by construction
    placed = entries.withColumn("cell", key_bits(F.col("key"), MAX_DEPTH)).join(
        F.broadcast(directory.select("cell", "bucket", "depth")), "cell")
    chain = F.row_number().over(Window.partitionBy("key").orderBy("sha"))
    owners = placed.repartitionByRange(max(12, -(-n // OWNER_ROWS)), "key")
    index = store(owners.withColumn("chain", chain).select(
        "bucket", "depth", "key", "key2", "sha", "chain", "keep_id", "group_size"), "exhash-index")
    discard(spark, entries)
    rows = base.select("doc_id", k1.alias("key"), k2.alias("key2")).groupBy(
        "doc_id", "key", "key2").agg(F.count(F.lit(1)).alias("n"))
    return Index(rows, directory, index)


def dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    ix = build_index(docs, capacity)
    # the 128-bit key names one chain entry; rows of a hot text meet one
    # entry each in a join that Spark may split
    found = ix.rows.join(ix.entries.select("key", "key2", "sha", "keep_id", "group_size"),
                         ["key", "key2"])
    return spread(found, ["doc_id", "keep_id", "group_size", "sha"], "n").select(
        "doc_id", "keep_id", "group_size",
        ((F.col("copy_no") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of equal texts stays."""
    ix = build_index(docs)
    keep = ix.entries.select(F.col("keep_id").alias("k_id"),
                             F.struct("key", "key2").alias("k_text"))

    def key():
        a, b = text_key(normalised())
        return F.struct(a.alias("key"), b.alias("key2"))

    return keep_rows(docs, keep, key)
