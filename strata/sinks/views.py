"""Materialized aggregate views kept up to date from a change feed.

``AggregateView`` stores, per group of a versioned table, counts, exact sums and
extremes. A refresh reads only the changes since the version it last applied:
every new image counts once, every old image is retracted. Counts and sums take
the difference. A minimum or maximum is widened by new images; only where a
retracted image held the extreme (it left the group), the extremes of that one
group are recomputed from the table. Groups without rows go. The view is
published as a whole under the table's version, by one rename, so a failed
refresh leaves the old contents and a repeated one changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.changelog import ChangeLog
from strata.sinks.tables import publish, published_versions, read_current

OLD_IMAGES = ("update_preimage", "delete")


@dataclass
class AggregateView:
    """``measures``: name -> SQL expression of the table's columns; each gets
    ``n_<name>`` (values), ``sum_<name>``, ``min_<name>`` and ``max_<name>``.
    Sums must be of whole numbers or decimals: retracting doubles is not exact.
    ``where`` restricts the rows; groups may be NULL."""
    log: ChangeLog
    path: str
    group_by: list[str]
    measures: dict[str, str] = field(default_factory=dict)
    where: str = "true"

    # ---- reading
    def applied(self) -> int | None:
        """Version of the table that the view shows."""
        have = published_versions(self.log.spark, self.path)
        return have[-1] if have else None

    def read(self) -> DataFrame:
        """Groups with counts, sums, means and extremes."""
        v = read_current(self.log.spark, self.path)
        means = {f"avg_{m}": F.try_divide(F.col(f"sum_{m}").cast("double"), F.col(f"n_{m}")) for m in self.measures}
        return v.withColumns(means) if means else v

    # ---- building
    def _rows(self, table: DataFrame) -> DataFrame:
        return table.where(self.where).select(
            *self.group_by, *[F.expr(e).alias(m) for m, e in self.measures.items()])

    def _full(self, rows: DataFrame) -> DataFrame:
        aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
        for m in self.measures:
            aggs += [F.count(m).alias(f"n_{m}"), F.sum(m).alias(f"sum_{m}"), F.min(m).alias(f"min_{m}"),
                     F.max(m).alias(f"max_{m}")]
        return rows.groupBy(*self.group_by).agg(*aggs)

    def _same(self, left: str, right: str) -> Column:
        on = F.lit(True)
        for g in self.group_by:
            on = on & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
        return on

    def delta(self, start: int, end: int) -> DataFrame:
        """Per group touched after ``start``: differences of counts and sums,
        extremes of the new images, extremes of the retracted ones."""
        feed = self.log.changes(start, end, touched_only=True)
        sign = F.when(F.col("_change_type").isin(*OLD_IMAGES), -1).otherwise(1)
        rows = feed.where(self.where).select(
            *self.group_by, sign.alias("_sign"), *[F.expr(e).alias(m) for m, e in self.measures.items()])
        new = F.col("_sign") > 0
        aggs: list[Column] = [F.sum("_sign").alias("n_rows")]
        for m in self.measures:
            c = F.col(m)
            aggs += [F.sum(F.when(c.isNotNull(), F.col("_sign")).otherwise(0)).alias(f"n_{m}"),
                     F.sum(F.when(new, c).otherwise(-c)).alias(f"sum_{m}"),
                     F.min(F.when(new, c)).alias(f"min_{m}"), F.max(F.when(new, c)).alias(f"max_{m}"),
                     F.min(F.when(~new, c)).alias(f"low_{m}"), F.max(F.when(~new, c)).alias(f"high_{m}")]
        return rows.groupBy(*self.group_by).agg(*aggs)

    def _merged(self, old: DataFrame, delta: DataFrame) -> DataFrame:
        """Old rows with the delta added; ``_lost`` where an extreme left."""
        o, d = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"d.{c}"))
        both = old.withColumn("_old", F.lit(True)).alias("o").join(
            delta.withColumn("_new", F.lit(True)).alias("d"), self._same("o", "d"), "full_outer")
        add = lambda c: F.coalesce(o(c), F.lit(0)) + F.coalesce(d(c), F.lit(0))
        cols = [F.when(o("_old"), o(g)).otherwise(d(g)).alias(g) for g in self.group_by]
        cols.append(add("n_rows").alias("n_rows"))
        lost = F.lit(False)
        for m in self.measures:
            left = add(f"n_{m}")
            kind = old.schema[f"sum_{m}"].dataType
            cols += [left.alias(f"n_{m}"), F.when(left > 0, add(f"sum_{m}")).cast(kind).alias(f"sum_{m}"),
                     F.least(o(f"min_{m}"), d(f"min_{m}")).alias(f"min_{m}"),
                     F.greatest(o(f"max_{m}"), d(f"max_{m}")).alias(f"max_{m}")]
            lost = lost | F.coalesce(d(f"low_{m}") <= o(f"min_{m}"), F.lit(False)) | F.coalesce(
                d(f"high_{m}") >= o(f"max_{m}"), F.lit(False))
        return both.select(*cols, lost.alias("_lost")).where("n_rows > 0")

    def refresh(self) -> int:
        """Bring the view to the table's latest version; returns the number of
        groups whose extremes had to be recomputed (-1: built from nothing)."""
        end, start = self.log.latest_version(), self.applied()
        if start is None:
            publish(self._full(self._rows(self.log.snapshot(end))), self.path, version=end)
            return -1
        if start == end:
            return 0
        merged = publish(self._merged(read_current(self.log.spark, self.path), self.delta(start, end)),
                         f"{self.path}/_merged", keep=1)
        names = [c for c in merged.columns if c != "_lost"]
        again = merged.where("_lost").select(*self.group_by)
        recomputed = again.count() if self.measures else 0
        if not recomputed:
            publish(merged.select(*names), self.path, version=end)
            return 0
        ends = [F.min(m).alias(f"min_{m}") for m in self.measures] + [F.max(m).alias(f"max_{m}") for m in self.measures]
        rows = self._rows(self.log.snapshot(end)).alias("r").join(again.alias("a"), self._same("r", "a"), "left_semi")
        extremes = rows.groupBy(*self.group_by).agg(*ends).alias("x")
        fixed = merged.where("_lost").alias("m").join(extremes, self._same("m", "x"), "left").select(
            *[F.col(f"x.{c}" if c[:4] in ("min_", "max_") and c[4:] in self.measures else f"m.{c}").alias(c) for c in names])
        publish(merged.where("NOT _lost").select(*names).unionByName(fixed), self.path, version=end)
        return recomputed
