"""Connected components by alternating large and small stars, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, store


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has u > v. Each u keeps its least neighbour; the rest join it."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of ``edges``
    (long columns u, v) that is not itself a root. Each round is written to the
    shared folder; a hub's neighbours are reduced before they are shuffled."""
    spark = edges.sparkSession
    e = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                           F.least("u", "v").alias("v")).distinct(), "stars")
    mark = lambda d: d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    now = mark(e)
    while True:
        nxt = store(_small_star(_large_star(e)), "stars")
        then, now = now, mark(nxt)
        discard(spark, e)
        e = nxt
        if now == then:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
