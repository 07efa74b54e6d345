"""Deduplication: keep-latest per key, first-seen per key, whole-row distinct.

``keep_latest`` is a grouped ``max`` over a struct whose leading fields are
the ordering keys, not a ``row_number`` window: the aggregate runs map-side
partial aggregation, so a key holding a third of all rows is collapsed on
every mapper before the shuffle instead of landing whole in one sort task.
The result equals ``row_number() OVER (PARTITION BY key ORDER BY o1 DESC
NULLS LAST, ...) = 1`` for descending orders (a NULL field sorts lowest in
a struct, so NULL ordering values lose), and the trailing fields make ties
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def keep_latest(df: DataFrame, keys: list[str], order_desc: list[str]) -> DataFrame:
    """One row per ``keys``: greatest ``order_desc`` tuple wins, NULLs last.

    Columns that cannot be ordered (maps) ride along as the value of a
    ``max_by`` whose ordering is the order columns plus every orderable
    column (deterministic ties)."""
    rest = [c for c in df.columns if c not in keys and c not in order_desc]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    ranked = order_desc + [c for c in rest if _orderable(kinds[c])]
    if len(ranked) == len(order_desc) + len(rest):
        packed = F.max(F.struct(*[F.col(c) for c in ranked]))
        fields = ranked
    else:
        fields = order_desc + rest
        packed = F.max_by(F.struct(*[F.col(c) for c in fields]),
                          F.struct(*[F.col(c) for c in ranked]))
    return (df.groupBy(*keys).agg(packed.alias("_w"))
            .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in fields])
            .select(*df.columns))


def keep_first_seen(df: DataFrame, keys: list[str]) -> DataFrame:
    """``dropDuplicates(keys)``: an arbitrary surviving row in batch, the
    first arriving one in a stream."""
    return df.dropDuplicates(keys)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicate removal (partial distinct before the shuffle)."""
    return df.dropDuplicates()
