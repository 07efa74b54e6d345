"""Stored layers that a micro-batch replaces day by day.

A large layer keeps its rows under ``<root>/<layer>/batch_id=<n>/day=<d>``; a
``small`` one, such as an aggregate, in one folder ``<root>/<layer>/batch_id=<n>``
with the columns ``day`` and ``batch``. ``<root>/pointers/v=<n>`` says for each
day which batch wrote it last. A batch writes the days it touches beside the old
ones and then publishes the whole pointer table by one rename, so readers see
all of a batch or nothing of it, a day that became empty loses its rows, and a
replayed batch replaces its own folders. Reads name the folders they need: neither files nor folders of other
days are opened or listed, so a batch reads no more as the history grows. What
grows is the pointer table, by one short row per calendar day. Folders that two
publications have superseded are deleted; readers of the publication before can
finish.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DAY = "none"           # rows whose timestamp is NULL


def day_of(ts: str = "event_timestamp") -> Column:
    """The calendar day of a timestamp as text; ``NO_DAY`` for NULL."""
    return F.coalesce(F.to_date(ts).cast("string"), F.lit(NO_DAY)).alias("day")


@dataclass
class DayTables:
    spark: SparkSession
    root: str
    small: tuple[str, ...] = ()

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def published(self) -> list[int]:
        return sorted(int(n[2:]) for n in self._names(f"{self.root}/pointers") if n.startswith("v="))

    def pointers(self, version: int) -> dict[str, tuple[int, list[str]]]:
        """day -> (batch, the layers that have rows); one short row per day."""
        rows = self.spark.read.schema("day string, batch_id long, layers array<string>").parquet(
            f"{self.root}/pointers/v={version}").collect()
        return {r.day: (r.batch_id, r.layers) for r in rows}

    def folder(self, layer: str, batch_id: int, day: str) -> str:
        return f"{self.root}/{layer}/batch_id={batch_id}/day={quote(day, safe='')}"

    def read(self, layer: str, days: list[str] | None = None, before: int | None = None,
             schema: T.StructType | None = None) -> DataFrame | None:
        """Current rows of a layer, or of the given days of it; None where
        there are none. ``schema`` saves looking it up in the files."""
        have = [v for v in self.published() if before is None or v < before]
        if not have:
            return None
        ptr = self.pointers(have[-1])
        wanted = {d: ptr[d][0] for d in (ptr if days is None else days) if d in ptr and layer in ptr[d][1]}
        if not wanted:
            return None
        if layer not in self.small:
            r = self.spark.read.schema(schema) if schema is not None else self.spark.read
            return r.parquet(*[self.folder(layer, b, d) for d, b in wanted.items()])
        rows = self.spark.read.parquet(*[f"{self.root}/{layer}/batch_id={b}" for b in sorted(set(wanted.values()))])
        current = self.spark.createDataFrame(sorted(wanted.items()), "day string, batch long")   # a row per day
        return rows.join(F.broadcast(current), ["day", "batch"], "left_semi").drop("day", "batch")

    def put(self, df: DataFrame, layer: str, batch_id: int) -> DataFrame:
        """Write a batch's rows of a layer (with the column ``day``), few files
        a day however many tasks made them, and read them back."""
        path = f"{self.root}/{layer}/batch_id={batch_id}"
        if layer in self.small:
            df = df.withColumn("batch", F.lit(batch_id).cast("long"))
            df.write.mode("overwrite").parquet(path)
        else:
            (df.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("day").parquet(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def _filled(self, layer: str, batch_id: int, days: list[str]) -> set[str]:
        """The days of a batch for which a layer got rows."""
        if layer in self.small:
            path = f"{self.root}/{layer}/batch_id={batch_id}"
            return {r.day for r in self.spark.read.schema("day string").parquet(path).distinct().collect()}
        names = set(self._names(f"{self.root}/{layer}/batch_id={batch_id}"))
        return {d for d in days if f"day={quote(d, safe='')}" in names}

    def publish(self, batch_id: int, days: list[str], layers: list[str]) -> None:
        """Point the touched days to this batch, then drop what two
        publications have superseded."""
        have = [v for v in self.published() if v < batch_id]
        old = self.pointers(have[-1]) if have else {}
        filled = {layer: self._filled(layer, batch_id, days) for layer in layers}
        ptr = old | {d: (batch_id, [x for x in layers if d in filled[x]]) for d in days}
        staged = f"{self.root}/_staged-{uuid.uuid4().hex}"
        rows = [(d, b, x) for d, (b, x) in sorted(ptr.items())]
        self.spark.createDataFrame(rows, "day string, batch_id long, layers array<string>").coalesce(1) \
            .write.parquet(staged)
        fs, src = self._fs(staged)
        _, dst = self._fs(f"{self.root}/pointers/v={batch_id}")
        fs.mkdirs(dst.getParent())
        fs.delete(dst, True)                   # of the same batch, when replayed
        if not fs.rename(src, dst):
            raise RuntimeError(f"batch {batch_id} of {self.root} was not published")
        for v in have[:-1]:
            gone, then = self.pointers(v), self.pointers(have[have.index(v) + 1])
            for d, (b, held) in gone.items():
                if then.get(d, (b,))[0] != b:
                    for layer in held:
                        if layer not in self.small:
                            self._delete(self.folder(layer, b, d))
            for b in {b for b, _ in gone.values()} - {b for b, _ in then.values()}:
                for layer in self.small:
                    self._delete(f"{self.root}/{layer}/batch_id={b}")
            self._delete(f"{self.root}/pointers/v={v}")
