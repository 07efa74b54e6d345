"""Dense surrogate keys, numbered without a global sort.

New natural keys are stored with the task and place at which they were written.
Counting rows per task (one short row each) gives every task its offset, and
``offset + place`` numbers all keys without gaps or collisions; no task sees more
than its own rows. Keys that already have a number keep it: an increment numbers
only the keys that the map lacks, from the greatest number on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks.tables import materialize

PLACE = (1 << 33) - 1      # monotonically_increasing_id: task above, place below


def dense_keys(rows: DataFrame, keys: list[str], name: str, known: DataFrame | None = None) -> DataFrame:
    """``known`` (columns ``keys`` and ``name``) with the keys of ``rows`` that
    it lacks added, numbered on from its greatest number (from 1 if there is
    none). NULL keys count as a value; repeated ones get one number."""
    spark = rows.sparkSession
    new = rows.select(*keys).distinct()
    base = F.lit(0).cast("long")
    if known is not None:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}"))
        new = new.alias("n").join(known.alias("k"), same, "left_anti")
        base = F.coalesce(known.agg(F.max(name)).scalar(), F.lit(0))
    placed = materialize(new.withColumn("_at", F.monotonically_increasing_id()), scratch_path(spark, "surrogates"))
    placed = placed.withColumns({"_task": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(PLACE)})
    # one row per task of the write: the only window, bounded by their number
    offsets = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)))
    numbered = placed.join(offsets, "_task").select(
        *keys, (base + F.coalesce("_before", F.lit(0)) + F.col("_place") + 1).alias(name))
    numbered = materialize(numbered, scratch_path(spark, "surrogates-numbered"))
    return numbered if known is None else known.select(*keys, name).unionByName(numbered)
