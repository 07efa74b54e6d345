"""Operator 7: removal of boilerplate lines that many distinct sites share.

A line is a ``\\n``-split part of a text with a character other than ASCII white
space; its identity is 128 bits of hash of the line without white space at its
ends. Per line one HyperLogLog sketch of its sites (column ``source``) is built
and merged by aggregation. A line whose estimate is farther than ``MARGIN``
times the threshold from it is decided by the estimate; lines in between get an
exact distinct count from a second aggregate over those lines only. Lines on at
least ``threshold`` sites go from every text; blank lines stay.

Positions to remove are found per distinct text, so copies cost once, and a
line common to all documents meets its decision in a join that Spark may split.

Defined results: a null text counts as empty and has one blank line; texts and
lines of any length are taken whole. A null
source is one site. Repeated rows get equal results; null ids pass through. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WHITE, WHITE_RUN, store, text_key, text_or_empty

MIN_SITES = 8
LG_K = 10          # a relative error of about 1/32 * 0.8 once sketches are dense
MARGIN = 0.25      # ten standard errors


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> tuple[Column, Column]:
    return text_key(F.regexp_replace(line, rf"^{WHITE_RUN}|{WHITE_RUN}$", ""))


def _site(c: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def _lines(df: DataFrame, *carry) -> DataFrame:
    """carry..., pos, l1, l2 of every line that is not blank."""
    x = df.select(*carry, F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    l1, l2 = line_key(F.col("line"))
    return x.where(F.length(F.translate("line", WHITE, "")) > 0).select(
        *carry, "pos", l1.alias("l1"), l2.alias("l2"))


def boilerplate(docs: DataFrame, threshold: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """l1, l2 of the lines found on at least ``threshold`` distinct sites."""
    src = docs.select(text_or_empty().alias("text"), _site().alias("site"))
    sites = _lines(src, "site").select("l1", "l2", "site")
    spread = (sites.groupBy("l1", "l2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
              .select("l1", "l2", F.hll_sketch_estimate("sketch").alias("n")))
    spread = store(spread.where(F.col("n") > threshold * (1 - margin)), "line-spread")
    sure = spread.where(F.col("n") >= threshold * (1 + margin)).select("l1", "l2")
    near = spread.where(F.col("n") < threshold * (1 + margin)).select("l1", "l2")
    exact = (sites.join(near, ["l1", "l2"], "left_semi").distinct().groupBy("l1", "l2")
             .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= threshold).select("l1", "l2"))
    return store(sure.union(exact), "line-boilerplate")


def clean(docs: DataFrame, threshold: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 0), kept_text."""
    bad = boilerplate(docs, threshold, margin)
    src = docs.select("doc_id", text_or_empty().alias("text"))
    t1, t2 = text_key(F.col("text"))
    src = src.withColumns({"t1": t1, "t2": t2})
    # lines of each distinct text: copies collapse on the map side
    places = (_lines(src, "t1", "t2").join(bad, ["l1", "l2"], "left_semi")
              .select("t1", "t2", "pos").groupBy("t1", "t2")
              .agg(F.array_sort(F.collect_set("pos")).alias("removed")))
    # stored, so that both sides of the join are bare shuffles and Spark can split
    # the copies of a hot text
    places = store(places, "line-places")
    none = F.array().cast("array<int>")
    out = src.join(places, ["t1", "t2"], "left").withColumn("removed", F.coalesce("removed", none))
    lines = lines_of(F.col("text"))
    # the stretches between removed lines, so the cost is linear in the lines
    gap = lambda j: F.coalesce(F.get("removed", j - 1) + 1, F.lit(0))
    end = lambda j: F.coalesce(F.get("removed", j), F.size("lines"))
    out = out.withColumn("lines", lines)
    kept = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("removed")),
        lambda j: F.slice("lines", gap(j) + 1, end(j) - gap(j)))), "\n"))
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                      F.size("removed").cast("long").alias("n_removed"), "removed", kept.alias("kept_text"))


def report(docs: DataFrame, threshold: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256."""
    return clean(docs, threshold).select("doc_id", "n_lines", "n_removed",
                                         F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
