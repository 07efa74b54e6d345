"""Joins whose left side has hot keys.

A sketch of the left keys (``approx_top_k``, a fixed number of counters, whose
error is under half of ``share``) names the keys that hold more than ``share`` of
the rows, and perhaps some with a little less. Left rows of these keys stay where they are:
the right rows they need are few and are broadcast, after a count shows that
there are at most ``BROADCAST_ROWS`` of them. Where a hot key has more right rows
than that, its left rows are spread over ``SALT`` copies of them instead. All
other rows take the planner's join. The three parts are disjoint by key, so their
union is the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000          # counters of the sketch
BROADCAST_ROWS = 100_000
SALT = 64


def hot_keys(df: DataFrame, key: str, share: float = 0.001) -> list:
    """Keys that hold more than ``share`` of the rows, within the sketch's error:
    at most ``2 / share`` of them."""
    top = F.call_function("approx_top_k", F.col(key), F.lit(min(TRACKED, int(2 / share))), F.lit(TRACKED)).alias("top")
    r = df.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), top).first()
    return [x["item"] for x in r["top"] or [] if x["count"] > share / 2 * r["n"]]


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = 0.001,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` in ``left`` and ``inner``;
    rows with a NULL key match nothing."""
    if how not in ("left", "inner"):
        raise ValueError(f"join {how!r} is not a left or inner join")
    keys = hot_keys(left, key, share)
    if not keys:
        return left.join(right, key, how)
    hot = lambda c: F.coalesce(c.isin(keys), F.lit(False))
    cold = left.where(~hot(F.col(key))).join(right.where(~hot(F.col(key))), key, how)
    few, many = [], []
    for r in right.where(hot(F.col(key))).groupBy(key).count().collect():      # at most one row per hot key
        (few if r["count"] <= broadcast_rows // len(keys) else many).append(r[key])
    of = lambda ks: F.col(key).isin(ks) if ks else F.lit(False)
    rest = left.where(hot(F.col(key)) & ~of(many))
    out = cold.unionByName(rest.join(F.broadcast(right.where(of(few))), key, how))
    if many:
        out = out.unionByName(_salted(left.where(of(many)), right.where(of(many)), key, how))
    return out


def _salted(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    salt: Column = F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.withColumn("_salt", salt).join(copies, [key, "_salt"], how).drop("_salt")
