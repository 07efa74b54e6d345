"""Operator 5: conflict-constrained best-fit packing of documents into bins.

A document becomes pieces of at most ``capacity`` words (whole texts: a longer
one fills bins alone and leaves a rest). Pieces are stored, counted and dealt to
shards of about ``SHARD_ROWS`` pieces by a hash over all their columns, piece
and copy number included, so neither a hot source, a large group of copies nor
a few very long documents land in one task. A shard packs
longest first. Its open bins stand in order of residual room, and each carries
two bitmaps: the sources that used up their quota and the duplicate clusters
it holds. The search starts at the tightest bin with enough room and goes on
to the next larger residual until one has no conflict; else a bin opens.

Defined results: a null text counts as empty; a text without words needs no
room and gets no bin (null ``bin_id``, length 0). A null source is a source of
its own. Rows repeated in full are packed as separate documents. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import spread, store, text_key, text_or_empty, word_array

CAPACITY = 2048      # words of a bin
SOURCE_QUOTA = 4     # documents of one source in a bin
SHARD_ROWS = 2_000   # pieces packed together
SCHEMA = "doc_id long, source string, cluster long, piece long, start long, length long, bin_id string, position long"


def pack(lengths, sources, clusters, capacity: int, quota: int) -> list[tuple[int, int]]:
    """(bin, start in bin) of each item, in order; items come longest first."""
    bits: dict = {}
    bit = lambda k: bits.setdefault(k, 1 << len(bits))
    order: list[tuple[int, int]] = []        # (residual, bin), ascending
    full: list[int] = []                     # per bin: sources at their quota
    held: list[int] = []                     # per bin: clusters
    used: list[dict] = []
    out = []
    for n, s, c in zip(lengths, sources, clusters):
        sb, cb = bit(("s", s)), bit(("c", c))
        at = bisect_left(order, (n, -1))
        while at < len(order) and (full[order[at][1]] & sb or held[order[at][1]] & cb):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(full)
            full.append(0)
            held.append(0)
            used.append({})
        out.append((b, capacity - room))
        held[b] |= cb
        used[b][s] = used[b].get(s, 0) + 1
        if used[b][s] >= quota:
            full[b] |= sb
        if room > n:
            insort(order, (room - n, b))
    return out


def items(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, source, cluster, copy_no, piece, start, length: one row per piece."""
    words = word_array(text_or_empty())
    cols = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       (cluster if cluster is not None else text_key(F.array_join(words, " "))[0])
                       .cast("long").alias("cluster"),
                       F.size(words).cast("long").alias("n"))
    rows = cols.groupBy("doc_id", "source", "cluster", "n").agg(F.count(F.lit(1)).alias("m"))
    rows = spread(rows, ["doc_id", "source", "cluster", "n"], "m")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)),
                        F.lit(capacity).cast("long"))
    return rows.select("*", F.posexplode(starts).alias("piece", "start")).select(
        "doc_id", "source", "cluster", "copy_no", F.col("piece").cast("long").alias("piece"),
        "start", F.least(F.col("n") - F.col("start"), F.lit(capacity)).alias("length"))


def best_fit(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY,
             source_quota: int = SOURCE_QUOTA, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece with its bin and place: columns of ``SCHEMA``.

    ``cluster``: a duplicate-cluster id; by default texts with equal words are
    one cluster. Two documents of a cluster never share a bin."""
    it = store(items(docs, cluster, capacity), "pieces")
    shards = max(1, -(-it.count() // shard_rows))
    it = it.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source", "cluster", "copy_no", "piece"),
                                       F.lit(shards)))

    def one(key, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", "doc_id", "source", "cluster", "copy_no", "piece"],
                          ascending=[False] + [True] * 5, kind="stable")
        g["bin_id"], g["position"] = None, 0
        some = g["length"] > 0
        w = g[some]
        placed = pack(w["length"], w["source"].where(w["source"].notna(), None), w["cluster"],
                      capacity, source_quota)
        g.loc[some, "bin_id"] = [f"{key[0]}-{b}" for b, _ in placed]
        g.loc[some, "position"] = [p for _, p in placed]
        return g[["doc_id", "source", "cluster", "piece", "start", "length", "bin_id", "position"]]

    # ids travel as text: pandas would turn longs beside nulls into floats
    it = it.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = it.groupBy("shard").applyInPandas(one, SCHEMA.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the bin and place of every piece of every document."""
    return best_fit(docs)
