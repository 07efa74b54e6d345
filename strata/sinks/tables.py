"""Table definition and write helpers (Parquet tables, no table-format jar).

Path tables are the default: a folder under the shared root, read back with
``spark.read.parquet``. Catalog tables are used where the semantics need a
stored definition (``INSERT OVERWRITE`` keeps the schema, ``IF NOT EXISTS``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GUARD_PROPERTY = "pipelines.reset.allowed"


class RefreshNotAllowed(RuntimeError):
    pass


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Parquet write. With ``partition_by`` the rows are rebalanced on the
    partition columns first (``REBALANCE`` hint): AQE clusters each value into
    few files, splits a skewed value over several tasks instead of one, and
    coalesces tiny ones. Overwrite of a partitioned table is dynamic: only the
    partitions present in ``df`` are replaced."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode) \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int,
                   location: str | None = None, sort: bool = True) -> None:
    """Catalog table hash-bucketed (and sorted) on ``keys``. Two tables
    bucketed the same way on their join key join without a shuffle on either
    side, e.g. line items and orders on the order key."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a layer to the shared folder and continue from the stored copy:
    cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream shuffles) and lets several consumers share one computation."""
    write_table(df, path, partition_by=partition_by)
    return df.sparkSession.read.parquet(path)


def create_table_as_select(spark: SparkSession, name: str, df: DataFrame,
                           replace: bool = False, location: str | None = None,
                           comment: str | None = None, properties: dict | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... AS SELECT`` (``replace=False``: skip
    if it exists) or ``CREATE OR REPLACE TABLE ... AS SELECT``, which leaves the
    old table as it is if the query or the write fails."""
    exists = spark.catalog.tableExists(name)
    if not replace and exists:
        return
    # a new table beside the old one, which goes only when the write is done
    fresh = f"{name}__{uuid.uuid4().hex[:8]}" if exists else name
    w = df.write.format("parquet")
    if location:
        w = w.option("path", f"{location}/r-{uuid.uuid4().hex[:8]}" if exists else location)
    w.mode("errorifexists").saveAsTable(fresh) if exists else w.mode("overwrite").saveAsTable(fresh)
    if exists:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    set_table_metadata(spark, name, comment, properties)


def create_empty_table(spark: SparkSession, name: str, ddl_columns: str,
                       location: str | None = None, partitioned_by: list[str] | None = None,
                       comment: str | None = None, properties: dict | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (cols) USING parquet``."""
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING parquet"
    if partitioned_by:
        sql += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if properties:
        sql += " TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def set_table_metadata(spark: SparkSession, name: str, comment: str | None = None,
                       properties: dict | None = None) -> None:
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '" + comment.replace("'", "\\'") + "'")
    if properties:
        props = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")


def table_properties(spark: SparkSession, name: str) -> dict:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def insert_overwrite(spark: SparkSession, name: str, df: DataFrame) -> None:
    """``INSERT OVERWRITE``: new contents, same definition; values are
    store-assigned to the table's column types (overflow raises)."""
    cols = spark.table(name).columns
    df.select(*cols).write.insertInto(name, overwrite=True)


def append_rows(spark: SparkSession, name: str, df: DataFrame) -> None:
    """``INSERT INTO t (cols)``: omitted columns become NULL."""
    target = spark.table(name)
    aligned = df.select(*[F.col(c) if c in df.columns else
                          F.lit(None).cast(target.schema[c].dataType).alias(c)
                          for c in target.columns])
    aligned.write.insertInto(name, overwrite=False)


def guarded_refresh(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Full refresh that honours ``pipelines.reset.allowed=false``."""
    if table_properties(spark, name).get(GUARD_PROPERTY, "true").lower() == "false":
        raise RefreshNotAllowed(f"full refresh of {name} is not allowed ({GUARD_PROPERTY}=false)")
    insert_overwrite(spark, name, df)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    """Existence probe through the typed error: ``None`` when the table or
    view is not found, any other analysis error is raised."""
    from pyspark.errors import AnalysisException
    try:
        df = spark.table(name)
        df.schema  # noqa: B018 - forces resolution
        return df
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def use_schema(spark: SparkSession, schema: str, create: bool = True) -> None:
    if create:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.catalog.setCurrentDatabase(schema)


def export_landing(df: DataFrame, path: str, fmt: str = "json", **options) -> None:
    """Drop a dataset into a landing folder as raw files (JSON lines / CSV)."""
    w = df.write.mode("overwrite").format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def published_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that ``path`` holds, in order."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def publish(df: DataFrame, path: str, keep: int = 2, version: int | None = None) -> DataFrame:
    """Replace a stored table or materialized view as a whole. The new contents
    (with any fail rules in their plan) are written beside the old ones and
    published by one rename to ``path/v=<n>``; readers take the greatest ``n``.
    A failing rule or write leaves the old contents in place. The last ``keep``
    versions stay, so readers of the one before can finish. ``version`` names
    the new one (it must exceed those there); by default it is the next number."""
    spark = df.sparkSession
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    fs, src = _fs(spark, staged)
    try:
        df.write.parquet(staged)
    except Exception:
        fs.delete(src, True)
        raise
    have = published_versions(spark, path)
    n = version if version is not None else have[-1] + 1 if have else 0
    _, dst = _fs(spark, f"{path}/v={n}")
    if (have and n <= have[-1]) or fs.exists(dst) or not fs.rename(src, dst):
        raise RuntimeError(f"version {n} of {path} was published by someone else")
    for old in [*have, n][:-keep]:
        fs.delete(_fs(spark, f"{path}/v={old}")[1], True)
    return read_current(spark, path)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The published contents of ``path``."""
    have = published_versions(spark, path)
    if not have:
        raise FileNotFoundError(f"nothing published at {path}")
    return spark.read.parquet(f"{path}/v={have[-1]}")
