"""Versioned tables on plain Parquet: an append-only change log.

``path/log/_version=<n>/`` holds the rows of commit ``n``: every inserted,
updated or merged row as an ``upsert`` entry, every deleted row as a ``delete``
tombstone, each with the commit's time, operation and user. A commit is written
beside the log and becomes visible by one rename, which refuses an existing
version; files are never rewritten. Nothing else is stored: columns come from
the log's schema and history is an aggregate of it, so any instance on the same
path reads and writes the same table. Single writer; the shared folder's rename
must be atomic (HDFS and local folders are).

Reads are DataFrame plans: ``snapshot(v)`` prunes the log to partitions
``<= v`` and keeps the latest entry per key with a grouped ``max`` over
``(_version, row)`` (partial aggregation before the shuffle), then drops
tombstones. Change feed, diff and restore are built from the same pieces.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.dedup import keep_latest

UPSERT, DELETE = "upsert", "delete"
META = ["_change", "_version", "_timestamp", "_operation", "_user"]


def _ts_literal(ts: dt.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S}'")


class ChangeLog:
    def __init__(self, spark: SparkSession, path: str, keys: list[str],
                 clock: Callable[[int], dt.datetime] | None = None, user: str = "strata"):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.clock = clock or (lambda _v: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.user = user

    # ------------------------------------------------------------ commits
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _log(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/log")

    @property
    def columns(self) -> list[str]:
        return [c for c in self._log().columns if c not in META]

    def history(self) -> DataFrame:
        """``DESCRIBE HISTORY``: one row per committed version with rows."""
        return self._log().groupBy(F.col("_version").alias("version")).agg(
            F.max("_timestamp").alias("timestamp"), F.max("_operation").alias("operation"),
            F.max("_user").alias("userName"), F.count(F.lit(1)).alias("num_rows"))

    def latest_version(self) -> int | None:
        """Greatest version folder; None only where the table's path has no
        log. Every other failure is raised: a table that cannot be listed must
        not look new."""
        fs, p = self._fs(f"{self.path}/log")
        if not fs.exists(p):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return max((int(n.split("=")[1]) for n in names if n.startswith("_version=")), default=None)

    def _commit(self, rows: DataFrame, operation: str, columns: list[str], first: bool = False) -> int | None:
        """Write the entries of the next version and publish them by rename.
        The row count is observed on the same write; an empty write (after the
        create) leaves no version."""
        cur = self.latest_version()
        if first and cur is not None:
            raise ValueError(f"{self.path} already holds a table")
        if not first and cur is None:
            raise ValueError(f"{self.path} holds no table")
        version = 0 if first else cur + 1
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        obs = Observation(f"commit_{uuid.uuid4().hex[:8]}")
        (rows.select(*columns, "_change",
                     _ts_literal(self.clock(version)).alias("_timestamp"),
                     F.lit(operation).alias("_operation"), F.lit(self.user).alias("_user"))
         .observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(staged))
        fs, src = self._fs(staged)
        if not first and obs.get["n"] == 0:
            fs.delete(src, True)
            return None
        _, dst = self._fs(f"{self.path}/log/_version={version}")
        fs.mkdirs(dst.getParent())
        if fs.exists(dst) or not fs.rename(src, dst):
            raise RuntimeError(f"version {version} of {self.path} was written by someone else")
        return version

    # ------------------------------------------------------------ writes
    def create(self, df: DataFrame) -> int:
        """Version 0 of a new table at an unused path."""
        return self._commit(df.withColumn("_change", F.lit(UPSERT)), "CREATE TABLE AS SELECT",
                            df.columns, first=True)

    def insert(self, df: DataFrame) -> int | None:
        """``INSERT INTO t (cols) VALUES ...``: omitted columns become NULL."""
        schema, columns = self._log().schema, self.columns
        aligned = df.select(*[F.col(c).cast(schema[c].dataType).alias(c) if c in df.columns
                              else F.lit(None).cast(schema[c].dataType).alias(c) for c in columns])
        return self._commit(aligned.withColumn("_change", F.lit(UPSERT)), "WRITE", columns)

    def update(self, where: str, assignments: dict[str, str | Column]) -> int | None:
        """``UPDATE t SET c = expr WHERE pred``: only rows where pred is TRUE;
        values take the columns' types."""
        schema = self._log().schema
        sets = {c: (F.expr(e) if isinstance(e, str) else e).cast(schema[c].dataType) for c, e in assignments.items()}
        changed = self._current_where(where).withColumns(sets)
        return self._commit(changed.withColumn("_change", F.lit(UPSERT)), "UPDATE", self.columns)

    def delete(self, where: str) -> int | None:
        gone = self._current_where(where)
        return self._commit(gone.withColumn("_change", F.lit(DELETE)), "DELETE", self.columns)

    def delete_keys(self, keys: DataFrame) -> int | None:
        """Delete the rows whose keys are listed (``DELETE ... WHERE k IN``)."""
        gone = self.snapshot().join(keys.select(*self.keys), self.keys, "left_semi")
        return self._commit(gone.withColumn("_change", F.lit(DELETE)), "DELETE", self.columns)

    def merge(self, source: DataFrame, delete_not_matched_by_source: bool = False) -> int | None:
        """Upsert: matched keys take the source row, new keys are inserted.
        Every source row is one log entry, so no join is needed to write;
        the optional by-source delete is a ``left_anti`` against the source.
        Two source rows for one key fail the merge (an aggregate by key)."""
        columns = self.columns
        vals = [c for c in columns if c not in self.keys]
        one = source.select(*columns).groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(0).alias("_"), *vals)).alias("_row"))
        checked = F.when(F.col("_n") == 1, F.lit(UPSERT)).otherwise(
            F.raise_error(F.lit("MERGE: several source rows match one key")).cast("string"))
        rows = one.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in vals], checked.alias("_change"))
        if delete_not_matched_by_source:
            gone = (self.snapshot().join(source.select(*self.keys), self.keys, "left_anti")
                    .withColumn("_change", F.lit(DELETE)))
            rows = rows.unionByName(gone)
        return self._commit(rows, "MERGE", columns)

    def restore_rows(self, version: int) -> tuple[DataFrame, int | None]:
        """Bring back rows present at ``version`` but absent now: (the rows,
        the new version or None)."""
        missing = self.snapshot(version).join(self.snapshot().select(*self.keys), self.keys, "left_anti")
        columns = self.columns
        v = self._commit(missing.withColumn("_change", F.lit(UPSERT)), "RESTORE", columns)
        log = self._log()
        restored = log.where("false") if v is None else log.filter(F.col("_version") == v)
        return restored.select(*columns), v

    # ------------------------------------------------------------ reads
    def _entries(self, upto: int | None = None) -> DataFrame:
        log = self._log()
        return log if upto is None else log.filter(F.col("_version") <= upto)

    def _current_where(self, where: str) -> DataFrame:
        """Current rows matching ``where``, without resolving every key.

        A key whose current row matches has at least one matching log entry
        (that row), so the latest-per-key step runs only for keys with a
        matching entry (a semi join AQE can broadcast when the set is small),
        and the predicate is re-checked on the resolved rows."""
        pred = F.coalesce(F.expr(where), F.lit(False))
        entries = self._entries()
        candidates = entries.filter(pred).select(*self.keys).distinct()
        latest = keep_latest(entries.join(candidates, self.keys, "left_semi"), self.keys, ["_version"])
        return latest.filter((F.col("_change") == UPSERT) & pred).select(*self.columns)

    def snapshot(self, version: int | None = None) -> DataFrame:
        """``SELECT * FROM t VERSION AS OF version`` (latest when None)."""
        latest = keep_latest(self._entries(version), self.keys, ["_version"])
        return latest.filter(F.col("_change") == UPSERT).select(*self.columns)

    def version_at(self, ts: dt.datetime) -> int:
        """Greatest version committed at or before ``ts``."""
        v = (self.history().filter(F.col("timestamp") <= _ts_literal(ts))
             .agg(F.max("version")).first()[0])
        if v is None:
            raise ValueError(f"no version at or before {ts}")
        return v

    def snapshot_at(self, ts: dt.datetime) -> DataFrame:
        """``TIMESTAMP AS OF ts``."""
        return self.snapshot(self.version_at(ts))

    def changes(self, start: int, end: int | None = None, touched_only: bool = False) -> DataFrame:
        """Change feed for versions ``(start, end]``: insert, update_preimage,
        update_postimage and delete rows with their commit version and time.

        One scan and two shuffles whatever the range: all entries up to
        ``start`` fold into one base entry per key while they are aggregated,
        later ones stay one per (key, version); then every entry looks at the
        one before it within its key. A key has at most one entry per version
        of the range, so no window grows with the table's history.

        ``touched_only`` keeps, before the shuffles, the entries of keys that
        the range touches (a semi join that AQE broadcasts when they are few):
        for ranges that touch a small part of a large table."""
        columns = self.columns
        vals = [c for c in columns if c not in self.keys]
        slot = F.greatest(F.col("_version"), F.lit(start)).alias("_slot")
        entries = self._entries(end)
        if touched_only:
            touched = entries.filter(F.col("_version") > start).select(*self.keys).distinct()
            entries = entries.join(touched, self.keys, "left_semi")
        per = keep_latest(entries.select("*", slot), [*self.keys, "_slot"], ["_version"])
        before = Window.partitionBy(*self.keys).orderBy("_slot")
        state = F.struct("_change", *vals)
        now = per.withColumn("_pre", F.lag(state).over(before)).filter(F.col("_slot") > start)
        had = F.coalesce(F.col("_pre._change") == UPSERT, F.lit(False))
        row = lambda kind, src: F.struct(
            kind.alias("_change_type"), *[(F.col(f"{src}{c}") if src else F.col(c)).alias(c) for c in vals])
        post = row(F.when(F.col("_change") == DELETE, "delete").when(had, "update_postimage")
                   .otherwise("insert"), "")
        pre = F.when(had & (F.col("_change") == UPSERT), row(F.lit("update_preimage"), "_pre."))
        out = now.select(*self.keys, F.col("_slot").alias("_commit_version"),
                         F.col("_timestamp").alias("_commit_timestamp"),
                         F.explode(F.filter(F.array(post, pre), lambda x: x.isNotNull())).alias("_x"))
        return out.select("_commit_version", F.col("_x._change_type").alias("_change_type"),
                          *[c if c in self.keys else F.col(f"_x.{c}").alias(c) for c in columns],
                          "_commit_timestamp")

    def diff(self, v_old: int, v_new: int | None = None) -> DataFrame:
        """Row-level diff: added / removed / changed keys with both images."""
        vals = [c for c in self.columns if c not in self.keys]
        a = self.snapshot(v_old).select(*self.keys, *[F.col(c).alias(f"old_{c}") for c in vals],
                                        F.lit(True).alias("_in_old"))
        b = self.snapshot(v_new).select(*self.keys, *[F.col(c).alias(f"new_{c}") for c in vals],
                                        F.lit(True).alias("_in_new"))
        same = F.lit(True)
        for c in vals:
            same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        j = a.join(b, self.keys, "full_outer")
        change = (F.when(F.col("_in_old").isNull(), "added")
                  .when(F.col("_in_new").isNull(), "removed")
                  .when(~same, "changed"))
        return (j.withColumn("change", change).filter(F.col("change").isNotNull())
                .drop("_in_old", "_in_new"))
