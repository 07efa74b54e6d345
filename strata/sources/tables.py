"""Readers for the star-schema test tables and the event feed.

``events`` parquet carries ``(event_id, ts, user_id, event_type, value, props)``;
the event pipeline speaks ``EVENT_SCHEMA``. ``dirty_events`` injects the
faults a real landing zone delivers (NULL keys, NULL/negative values, bad IPs,
late duplicates) by a fixed rule over every row, so the pipeline's rules have
something to catch. It is written once here and once as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("event_value", T.DoubleType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("source_ip", T.StringType(), True),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def synthetic_ip(user_id: Column, event_id: Column) -> Column:
    return F.concat(F.lit("10."), (user_id % 256).cast("string"), F.lit("."),
                    (event_id % 256).cast("string"), F.lit(".1"))


def load_events(spark: SparkSession, sf_dir: str, with_source_file: bool = False) -> DataFrame:
    """Clean events in the pipeline's schema (column pruning reaches the scan)."""
    raw = read_table(spark, sf_dir, "events")
    cols = [
        F.col("event_id"), F.col("user_id"), F.col("event_type"),
        F.col("value").alias("event_value"),
        F.col("ts").alias("event_timestamp"),
        synthetic_ip(F.col("user_id"), F.col("event_id")).alias("source_ip"),
    ]
    if with_source_file:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    return raw.select(*cols)


def dirty_events(spark: SparkSession, sf_dir: str, with_source_file: bool = False) -> DataFrame:
    """Events with deterministic faults and a late second copy of some ids.

    Narrow transformation only (a generator, no shuffle): every input row is
    kept; ``event_id % 97 = 0`` rows get a second copy one hour later with the
    value doubled (``copy_no`` 1).
    """
    raw = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    extra = [F.col("_metadata.file_path").alias("source_file")] if with_source_file else []
    copies = raw.select(
        eid, uid, "event_type", "value", "ts", *extra,
        F.explode(F.when(eid % 97 == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy_no"),
    )
    second = F.col("copy_no") == 1
    ts_in = F.when(second, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    value_in = F.when(second, F.col("value") * 2).otherwise(F.col("value"))
    return copies.select(
        F.when(eid % 211 == 0, F.lit(None).cast("bigint")).otherwise(eid).alias("event_id"),
        F.when(eid % 101 == 0, F.lit(None).cast("bigint")).otherwise(uid).alias("user_id"),
        F.col("event_type"),
        F.when(eid % 53 == 0, -value_in)
         .when(eid % 59 == 0, F.lit(None).cast("double"))
         .otherwise(value_in).alias("event_value"),
        F.when((eid % 89 == 0) | ((F.col("copy_no") == 0) & (eid % 194 == 0)),
               F.lit(None).cast("timestamp_ntz"))
         .otherwise(ts_in).alias("event_timestamp"),
        F.when(eid % 71 == 0, F.lit("not-an-ip"))
         .when(eid % 73 == 0, F.lit("10x0x0x1"))
         .otherwise(synthetic_ip(uid, eid)).alias("source_ip"),
        F.col("copy_no"),
        *([F.col("source_file")] if with_source_file else []),
    )


# The same fault recipe as DuckDB SQL, for oracle queries.
DIRTY_EVENTS_SQL = """
dirty_events AS (
  SELECT
    CASE WHEN e.event_id % 211 = 0 THEN NULL ELSE e.event_id END AS event_id,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE e.user_id END AS user_id,
    e.event_type,
    CASE WHEN e.event_id % 53 = 0 THEN -(CASE WHEN c.copy_no = 1 THEN e.value * 2 ELSE e.value END)
         WHEN e.event_id % 59 = 0 THEN NULL
         ELSE (CASE WHEN c.copy_no = 1 THEN e.value * 2 ELSE e.value END) END AS event_value,
    CASE WHEN e.event_id % 89 = 0 OR (c.copy_no = 0 AND e.event_id % 194 = 0) THEN NULL
         ELSE (CASE WHEN c.copy_no = 1 THEN e.ts + INTERVAL 1 HOUR ELSE e.ts END) END AS event_timestamp,
    CASE WHEN e.event_id % 71 = 0 THEN 'not-an-ip'
         WHEN e.event_id % 73 = 0 THEN '10x0x0x1'
         ELSE '10.' || CAST(e.user_id % 256 AS VARCHAR) || '.' || CAST(e.event_id % 256 AS VARCHAR) || '.1' END AS source_ip,
    c.copy_no
  FROM events e
  JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c
    ON c.copy_no = 0 OR e.event_id % 97 = 0
)"""
