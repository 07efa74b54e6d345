"""Streaming query keys: each lands ``dirty_events`` as JSON lines, in one drop
or in three, runs the flow with ``availableNow`` and reads the sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import events as ev
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import export_landing
from strata.sources.tables import dirty_events
from strata.streaming import flows


def land_events(spark: SparkSession, sf_dir: str, root: str) -> str:
    landing = f"{root}/landing"
    export_landing(dirty_events(spark, sf_dir), landing, "json",
                   timestampNTZFormat=flows.TS_FORMAT)
    return landing


def run_bronze(spark: SparkSession, sf_dir: str, root: str) -> str:
    landing = land_events(spark, sf_dir, root)
    bronze = flows.bronze_stream(flows.read_landing(spark, landing), ev.check_clock())
    q = flows.start(bronze, f"{root}/_ckpt_bronze", f"{root}/bronze",
                    partition_by=["event_type"])
    q.awaitTermination()
    return f"{root}/bronze"


@query("stream_bronze_available_now", ev.BRONZE_CTES + f"""
SELECT event_id, user_id, event_type, event_value, event_timestamp, source_ip, copy_no,
       {ev.CHECK_CLOCK_SQL} AS ingest_time
FROM bronze
""")
def q_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-bronze")
    path = run_bronze(spark, sf_dir, root)
    return spark.read.parquet(path).select(
        "event_id", "user_id", "event_type", "event_value", "event_timestamp", "source_ip",
        "copy_no", "ingest_time")


# Three drops in a fixed order: first copies of even, then of odd ids, then the
# late second copies, some of which fall on the next day.
DROPS = ("copy_no = 0 AND coalesce(event_id, 0) % 2 = 0", "copy_no = 0 AND coalesce(event_id, 0) % 2 = 1",
         "copy_no = 1")
FIRST_SEEN_CTES = ev.SILVER_CTES.replace("ORDER BY event_timestamp DESC NULLS LAST, copy_no DESC",
                                         "ORDER BY copy_no")
SILVER_COLUMNS = ["event_id", "user_id", "event_type", "event_value", "event_timestamp", "source_ip", "copy_no",
                  "event_date", "event_hour", "day_of_week", "is_weekend", "value_category", "ingest_time"]
SILVER_ROWS_SQL = f"""
SELECT event_id, user_id, event_type, event_value, event_timestamp, source_ip, copy_no, event_date,
       event_hour, day_of_week, is_weekend, value_category, {ev.CHECK_CLOCK_SQL} AS ingest_time
FROM silver
"""


def in_drops(spark: SparkSession, sf_dir: str, root: str, run) -> None:
    """Land the drops one after the other and call ``run`` after each: every
    drop is at least one micro-batch of its own."""
    for k, drop in enumerate(DROPS):
        export_landing(dirty_events(spark, sf_dir).filter(drop), f"{root}/landing/drop{k}", "json",
                       timestampNTZFormat=flows.TS_FORMAT)
        run()


def bronze_source(spark: SparkSession, root: str) -> DataFrame:
    return flows.bronze_stream(flows.read_landing(spark, f"{root}/landing/*"), ev.check_clock())


@query("stream_dedup", FIRST_SEEN_CTES.replace("silver AS (SELECT * FROM derived WHERE event_timestamp IS NOT NULL)",
                                               "silver AS (SELECT * FROM derived)")
       + "SELECT event_id, user_id, event_type FROM silver")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen dedup in a stream before any rule: the surviving keys."""
    root = scratch_path(spark, "stream-dedup")
    in_drops(spark, sf_dir, root, lambda: flows.start(
        flows.silver_stream(bronze_source(spark, root), drop_rules=False),
        f"{root}/_ckpt", f"{root}/silver").awaitTermination())
    return spark.read.parquet(f"{root}/silver").select("event_id", "user_id", "event_type")


@query("stream_silver_rows", FIRST_SEEN_CTES + SILVER_ROWS_SQL)
def q_stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming Silver itself: first-seen rows with derivations and
    rules, stored by date."""
    root = scratch_path(spark, "stream-silver")
    in_drops(spark, sf_dir, root, lambda: flows.start(
        flows.silver_stream(bronze_source(spark, root)), f"{root}/_ckpt", f"{root}/silver",
        partition_by=["event_date"]).awaitTermination())
    return spark.read.parquet(f"{root}/silver").select(*SILVER_COLUMNS)


@query("stream_dedup_watermark", FIRST_SEEN_CTES.replace("FROM bronze) WHERE rn = 1",
                                                         "FROM bronze WHERE event_timestamp IS NOT NULL) WHERE rn = 1")
       + SILVER_ROWS_SQL)
def q_stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup with bounded state: a copy is dropped while its id is within the
    watermark (here longer than the data, so every late copy is); rows
    without an event time cannot enter and are dropped first."""
    root = scratch_path(spark, "stream-watermark")
    in_drops(spark, sf_dir, root, lambda: flows.start(
        flows.silver_stream(bronze_source(spark, root).filter("event_timestamp IS NOT NULL"), watermark="4000 days"),
        f"{root}/_ckpt", f"{root}/silver").awaitTermination())
    return spark.read.parquet(f"{root}/silver").select(*SILVER_COLUMNS)


@query("stream_dedup_horizon", FIRST_SEEN_CTES.replace(
    "silver AS (SELECT * FROM derived WHERE event_timestamp IS NOT NULL)", "silver AS (SELECT * FROM derived)")
       + SILVER_ROWS_SQL)
def q_stream_dedup_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded first-seen dedup over all rows, also those without event time:
    ids are kept for a week after their arrival, and all drops arrive within."""
    root = scratch_path(spark, "stream-horizon")

    def run():
        landed = flows.read_landing(spark, f"{root}/landing/*", arrival=True)
        flows.start(flows.silver_stream(flows.bronze_stream(landed, ev.check_clock()), drop_rules=False, horizon="7 days"),
                    f"{root}/_ckpt", f"{root}/silver").awaitTermination()

    in_drops(spark, sf_dir, root, run)
    return spark.read.parquet(f"{root}/silver").select(*SILVER_COLUMNS)


GOLD_WITHIN_ERROR_SQL = """
SELECT event_date, event_type, is_weekend, COUNT(*) AS event_count,
       CAST(SUM(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       CAST(SUM(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(event_value) AS avg_value,
       TRUE AS users_within_error, TRUE AS p95_within_error
FROM silver GROUP BY event_date, event_type, is_weekend
"""


def within_error(g: DataFrame, silver: DataFrame, users: float) -> DataFrame:
    """Approximate columns against exact ones over the same Silver: distinct
    users within ``users`` (relative) or two users, the percentile's rank within
    one percent."""
    v, p95 = F.col("event_value"), F.col("p95_value")
    n = F.greatest(F.count(v), F.lit(1))
    seen = (silver.join(g.select(*ev.GOLD_KEYS, "p95_value"), ev.GOLD_KEYS)
            .groupBy(*ev.GOLD_KEYS).agg(
                F.count_distinct("user_id").alias("users"), F.count(v).alias("values"),
                (F.count_if(v <= p95) / n).alias("upto"), (F.count_if(v < p95) / n).alias("below")))
    off = F.abs(F.col("unique_users") - F.col("users"))
    return g.join(seen, ev.GOLD_KEYS).select(
        *ev.GOLD_KEYS, "event_count", "total_value", "avg_value",
        ((off <= 2) | (off <= users * F.col("users"))).alias("users_within_error"),
        ((F.col("values") == 0) | ((F.col("upto") >= 0.94) & (F.col("below") <= 0.96))).alias("p95_within_error"))


@query("stream_gold_approx", FIRST_SEEN_CTES + GOLD_WITHIN_ERROR_SQL)
def q_stream_gold_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete-mode gold of the stream; users within four standard deviations
    of the sketch (20 %)."""
    root = scratch_path(spark, "stream-gold-approx")
    silver_path = f"{root}/silver"

    def run():
        silver = flows.silver_stream(bronze_source(spark, root))
        flows.start(silver, f"{root}/_ckpt_silver", silver_path).awaitTermination()
        stored = spark.readStream.schema(spark.read.parquet(silver_path).schema).parquet(silver_path)
        flows.start(flows.gold_approx_stream(stored), f"{root}/_ckpt", mode="complete",
                    foreach_batch=flows.versioned_sink(f"{root}/gold")).awaitTermination()

    in_drops(spark, sf_dir, root, run)
    return within_error(flows.read_published(spark, f"{root}/gold"), spark.read.parquet(silver_path), 0.2)


def run_sketches(spark: SparkSession, sf_dir: str, tag: str) -> str:
    """First-seen Silver stream, then a second stream over the stored Silver
    that merges each batch into the stored sketches; drop by drop."""
    root = scratch_path(spark, tag)
    silver_path = f"{root}/silver"

    def run():
        flows.start(flows.silver_stream(bronze_source(spark, root)), f"{root}/_ckpt_silver",
                    silver_path).awaitTermination()
        stored = spark.readStream.schema(spark.read.parquet(silver_path).schema).parquet(silver_path)
        flows.start(stored, f"{root}/_ckpt", foreach_batch=flows.gold_sketch_sink(spark, f"{root}/gold")).awaitTermination()

    in_drops(spark, sf_dir, root, run)
    return root


@query("stream_gold_sketches", FIRST_SEEN_CTES + GOLD_WITHIN_ERROR_SQL)
def q_stream_gold_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from mergeable sketches: counts and sums exact, users within four
    standard deviations (7 %), the percentile's rank within one percent."""
    root = run_sketches(spark, sf_dir, "stream-sketches")
    return within_error(flows.read_sketch_gold(spark, f"{root}/gold"), spark.read.parquet(f"{root}/silver"), 0.07)


@query("stream_gold_sketch_rollup", FIRST_SEEN_CTES + """
SELECT event_date, COUNT(*) AS event_count,
       CAST(SUM(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, TRUE AS users_within_error
FROM silver GROUP BY event_date
""")
def q_stream_sketch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of whole days by merging the stored sketches of their
    types; distinct counts themselves could not be added."""
    root = run_sketches(spark, sf_dir, "stream-rollup")
    users = spark.read.parquet(f"{root}/silver").groupBy("event_date").agg(F.count_distinct("user_id").alias("users"))
    off = F.abs(F.col("unique_users") - F.col("users"))
    return flows.read_sketch_gold(spark, f"{root}/gold", ["event_date"]).join(users, "event_date").select(
        "event_date", "event_count", "total_value", ((off <= 2) | (off <= 0.07 * F.col("users"))).alias("users_within_error"))


def run_exact(spark: SparkSession, sf_dir: str, tag: str) -> str:
    """Bronze stream, then a second stream over the Bronze table whose keyed
    state finds the touched days and whose sink keeps their exact gold tables
    up to date; drop by drop."""
    root = scratch_path(spark, tag)
    bronze = f"{root}/bronze"

    def run():
        flows.start(bronze_source(spark, root), f"{root}/_ckpt_bronze", bronze).awaitTermination()
        src = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
        flows.start(flows.latest_with_days(src), f"{root}/_ckpt_gold", mode="update",
                    foreach_batch=flows.gold_exact_sink(spark, f"{root}/exact"),
                    conf=flows.ONE_BATCH_STATE).awaitTermination()

    in_drops(spark, sf_dir, root, run)
    return f"{root}/exact"


@query("stream_gold_exact", ev.SILVER_CTES + """
SELECT event_date, event_type, is_weekend,
  COUNT(*) AS event_count,
  COUNT(DISTINCT user_id) AS unique_users,
  CAST(SUM(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
  CAST(SUM(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(event_value) AS avg_value,
  quantile_disc(event_value, 0.95) AS p95_value
FROM silver GROUP BY event_date, event_type, is_weekend
""")
def q_stream_gold_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.read_generation(spark, run_exact(spark, sf_dir, "stream-gold-exact"), "gold_daily")


@query("stream_user_activity_exact", ev.GOLD_USER_SQL)
def q_stream_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.read_generation(spark, run_exact(spark, sf_dir, "stream-users-exact"), "gold_users")


@query("replay_silver", ev.SILVER_CTES + SILVER_ROWS_SQL)
def q_replay_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rebuilt in batch from the streamed Bronze history: the latest
    copies replace the first-seen ones."""
    root = scratch_path(spark, "stream-replay")
    in_drops(spark, sf_dir, root, lambda: flows.start(
        bronze_source(spark, root), f"{root}/_ckpt", f"{root}/bronze").awaitTermination())
    flows.replay_silver(spark, f"{root}/bronze", f"{root}/silver")
    return spark.read.parquet(f"{root}/silver").select(*SILVER_COLUMNS)
