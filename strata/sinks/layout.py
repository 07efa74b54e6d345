"""Clustered files: rows that are near in several columns share a file.

Each column's values are cut into ``2 ** BITS`` ranges of about equal size by
quantiles over all rows (one aggregate of fixed size), and the bits of the range
numbers are interleaved to one order key. Written in ranges of that key, a file
spans a small part of every column, so its min/max statistics let a filter on any
of them skip most files, which a plain sort gives for its first column only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6          # 64 ranges per column
ACCURACY = 10_000


def _reached(value: Column):
    return lambda end: value >= end


def interleaved(df: DataFrame, cols: list[str]) -> Column:
    """Order key of numeric, date or timestamp columns; NULLs are in the first
    range. The boundaries of the ranges (63 numbers a column) come to the driver."""
    number = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if dict(df.dtypes)[c] in (
        "date", "timestamp", "timestamp_ntz") else F.col(c).cast("double")
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    cuts = df.agg(*[F.percentile_approx(number(c), shares, ACCURACY).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        ends = F.array(*[F.lit(x) for x in sorted(set(cuts[f"c{i}"] or []))]) if cuts[f"c{i}"] else F.array(F.lit(0.0))
        place = F.coalesce(F.size(F.filter(ends, _reached(number(c)))), F.lit(0))
        for b in range(BITS):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(bit, b * len(cols) + i)
    return key


def write_clustered(df: DataFrame, path: str, cols: list[str], files: int) -> None:
    """About ``files`` files clustered on ``cols``. Equal keys are told apart by
    the first column, so one frequent combination can be cut over files."""
    (df.withColumn("_z", interleaved(df, cols)).repartitionByRange(files, "_z", *cols)
     .sortWithinPartitions("_z", *cols).drop("_z").write.mode("overwrite").parquet(path))


def files_for(df: DataFrame, condition: str, cols: list[str]) -> tuple[int, int]:
    """(files whose min/max of ``cols`` allow ``condition``, all files) of a
    scan; the condition is over ``min_<col>`` and ``max_<col>``."""
    spans = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])
    r = spans.agg(F.count_if(F.expr(condition)).alias("read"), F.count(F.lit(1)).alias("files")).first()
    return r["read"], r["files"]
