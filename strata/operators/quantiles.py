"""Exact discrete quantiles of large groups by distributed selection.

``quantile_disc`` of a group is its value of rank ``ceil(q * n)`` (1 at least).
Sorting a group to find it puts the group into one task. Here every round lays
a histogram of ``BINS`` equal ranges over what is left of each group (counted
before the shuffle, so a hot group sends at most ``BINS`` rows per task), finds
the one range that holds the rank, and keeps only the rows of that range, with
the rank inside it. A quantile is found when least and greatest value of its
range are the same; a range of one repeated value ends at once however many rows
it has. Each round divides the range by ``BINS``, so a few rounds do; what
remains after a round is stored, and only its row count reaches the driver.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks.tables import materialize

BINS = 4096


def _bin(value: Column, lo: Column, hi: Column) -> Column:
    """Number of the range between the finite ends (halves keep differences
    finite); infinities and NaN, Spark's greatest value, have one of their own."""
    half = hi / 2 - lo / 2
    inner = F.least(F.floor(F.try_divide(value / 2 - lo / 2, half) * BINS), F.lit(BINS - 1)).cast("int")
    return (F.when(F.isnan(value), BINS + 1).when(value == float("inf"), BINS).when(value == float("-inf"), -1)
            .when(half == 0, (value == hi).cast("int")).otherwise(inner))


def _span() -> list[Column]:
    """Finite ends of the values, and their least and greatest."""
    finite = F.when(F.abs("_v") < float("inf"), F.col("_v"))
    return [F.min(finite).alias("_lo"), F.max(finite).alias("_hi"), F.min("_v").alias("_least"), F.max("_v").alias("_top")]


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, str]) -> DataFrame:
    """One row per group: ``keys``, ``n`` (values that are not NULL) and one
    column per quantile (name -> share as text, such as ``"0.95"``), NULL where a
    group has no values. NULL keys group."""
    spark = df.sparkSession
    key = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(a) for k, a in zip(keys, key)], F.col(value).cast("double").alias("_v"))
    groups = materialize(rows.groupBy(*key).agg(F.count("_v").alias("n"), *_span()), scratch_path(spark, "quantile-groups"))
    wanted = []
    for name, share in quantiles.items():
        f = Fraction(share)
        rank = F.greatest(F.lit(1), F.expr(f"(n * {f.numerator} + {f.denominator - 1}) div {f.denominator}"))
        wanted.append(F.struct(F.lit(name).alias("_q"), rank.cast("long").alias("_rank")))
    state = groups.where("n > 0").select(*key, F.explode(F.array(*wanted)).alias("_x"), "_lo", "_hi", "_least", "_top").select(
        *key, "_x.*", "_lo", "_hi", "_least", "_top")
    found, left = state.where("_least = _top").select(*key, "_q", F.col("_top").alias("_v")), rows.where("_v is not null")
    state = state.where("_least != _top")
    parts = [materialize(found, scratch_path(spark, "quantile-found"))]
    first = True
    while True:
        state = materialize(state, scratch_path(spark, "quantile-state"))
        if state.isEmpty():
            break
        on = _same(key, "r", "s") if first else _same([*key, "_q"], "r", "s")
        # the first round reads every row once per group, later ones per quantile
        span = state.select(*key, "_lo", "_hi").distinct() if first else state.select(*key, "_q", "_lo", "_hi")
        by = key if first else [*key, "_q"]
        tagged = left.alias("r").join(span.alias("s"), on).select(
            *[F.col(f"r.{c}") for c in [*by, "_v"]], _bin(F.col("r._v"), F.col("s._lo"), F.col("s._hi")).alias("_b"))
        hist = tagged.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"), *_span())
        upto = Window.partitionBy(*by).orderBy("_b")                      # BINS + 3 rows at most
        hist = hist.withColumn("_end", F.sum("_c").over(upto))
        picked = hist.alias("h").join(state.alias("s"), _same(by, "h", "s")).where(
            (F.col("h._end") >= F.col("s._rank")) & (F.col("h._end") - F.col("h._c") < F.col("s._rank"))).select(
            *[F.col(f"s.{c}") for c in [*key, "_q"]], "h._b",
            (F.col("s._rank") - (F.col("h._end") - F.col("h._c"))).alias("_rank"), "h._lo", "h._hi", "h._least", "h._top")
        picked = materialize(picked, scratch_path(spark, "quantile-ranges"))
        parts.append(picked.where("_least = _top").select(*key, "_q", F.col("_top").alias("_v")))
        state = picked.where("_least != _top").drop("_b")
        rest = picked.where("_least != _top").select(*key, "_q", "_b")
        left = materialize(tagged.alias("t").join(rest.alias("p"), _same([*by, "_b"], "t", "p")).select(
            *[F.col(f"t.{c}") for c in key], "p._q", "t._v"), scratch_path(spark, "quantile-rows"))
        first = False
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    wide = out.groupBy(*key).agg(*[F.max(F.when(F.col("_q") == q, F.col("_v"))).alias(q) for q in quantiles])
    return groups.alias("g").join(wide.alias("w"), _same(key, "g", "w"), "left").select(
        *[F.col(f"g.{a}").alias(k) for k, a in zip(keys, key)], "n", *quantiles)


def _same(cols: list[str], a: str, b: str) -> Column:
    on = F.lit(True)
    for c in cols:
        on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return on
