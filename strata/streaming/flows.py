"""Structured Streaming flows of the event medallion.

* ``bronze_stream``: landing JSON -> drop rules -> provenance (stateless).
* ``silver_stream``: first-seen dedup by ``event_id`` (unbounded state, as the
  batch pipeline; ``watermark=`` bounds it with
  ``dropDuplicatesWithinWatermark``) -> derivations -> rules.
* ``latest_with_days`` + ``gold_exact_sink``: keyed state finds the days on
  which a micro-batch's ids ever had a copy; ``foreachBatch`` recomputes only
  those days and publishes them. A replayed batch rewrites its own folders.
* ``gold_sketch_sink``: approximate distinct users and percentile as stored
  sketches that batches merge into, day by day; no complete mode.
* ``gold_approx_stream``: the same in complete mode, for small group counts.

Every sink writes to files under the shared root; nothing is collected.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.events import event_derivations
from strata.operators.dedup import keep_latest
from strata.operators.rules import apply_rules, rule_metrics
from strata.plans import events as ev
from strata.streaming.days import NO_DAY, DayTables, day_of
from strata.streaming.ingest import ANY_AGE

LANDED_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_value", T.DoubleType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("copy_no", T.IntegerType()),
])


# Microsecond timestamps in landing JSON (the writer's default keeps milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_landing(spark: SparkSession, landing: str, schema: T.StructType = LANDED_SCHEMA,
                 max_files_per_trigger: int | None = None, multi_line: bool = False,
                 arrival: bool = False) -> DataFrame:
    # files are taken whatever their age; ``multi_line``: one JSON array a file;
    # ``arrival``: ``arrived_at``, when the row's file was landed
    r = (spark.readStream.schema(schema).option("timestampNTZFormat", TS_FORMAT)
         .option("maxFileAge", ANY_AGE).option("multiLine", multi_line))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.json(landing)
    return rows.withColumn("arrived_at", F.col("_metadata.file_modification_time")) if arrival else rows


def bronze_stream(landed: DataFrame, clock: Column | None = None) -> DataFrame:
    with_file = landed.withColumn("source_file", F.col("_metadata.file_name"))
    return ev.bronze_events(with_file, clock)


def silver_stream(bronze: DataFrame, watermark: str | None = None,
                  drop_rules: bool = True, horizon: str | None = None) -> DataFrame:
    """``horizon``: keep an id for so long after its first arrival (the column
    ``arrived_at`` of ``read_landing``). Every row has an arrival, so rows
    without event time take part; a copy that arrives within the horizon is
    dropped whatever its event time, and ids expire, so the state's size follows
    the arrivals of one horizon and not the history."""
    if horizon:
        deduped = (bronze.withWatermark("arrived_at", horizon)
                   .dropDuplicatesWithinWatermark(["event_id"]))
    elif watermark:
        # event-time watermarks need TIMESTAMP (session time zone, UTC here)
        deduped = (bronze.withColumn("_event_time", F.col("event_timestamp").cast("timestamp"))
                   .withWatermark("_event_time", watermark)
                   .dropDuplicatesWithinWatermark(["event_id"])
                   .drop("_event_time"))
    else:
        deduped = bronze.dropDuplicates(["event_id"])
    derived = deduped.withColumns(event_derivations())
    rules = ev.SILVER_RULES if drop_rules else [r for r in ev.SILVER_RULES if r.policy != "drop"]
    return apply_rules(derived, rules, dataset="silver_events")


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """The settings that the session does not set itself, for a while."""
    unset = [k for k in conf if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, conf[k])
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def start(df: DataFrame, checkpoint: str, path: str | None = None, fmt: str = "parquet",
          mode: str = "append", once: bool = True, interval: str = "10 seconds",
          partition_by: list[str] | None = None, foreach_batch=None, conf: dict[str, str] | None = None):
    """Start a flow: ``once`` drains what is available and stops
    (triggered pipeline); otherwise runs continuously every ``interval``.
    ``conf``: settings of this flow alone (a flow keeps those of the session as
    they are when it starts); what the session sets itself goes first."""
    if conf:
        with _settings(df.sparkSession, conf):
            return start(df, checkpoint, path, fmt, mode, once, interval, partition_by, foreach_batch)
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def gold_approx_stream(silver: DataFrame) -> DataFrame:
    return ev.gold_daily_base(silver, approx_distinct=True)


def versioned_sink(path: str):
    """foreachBatch sink for complete-mode results. Each micro-batch's full
    result goes to its own folder (a replayed batch rewrites the same one),
    and only then is the batch id appended to ``_published``; readers take
    the highest published id, so they never see a half-written result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.sparkSession.createDataFrame([(batch_id,)], "batch_id long").coalesce(1) \
            .write.mode("append").parquet(f"{path}/_published")
    return write


def read_published(spark: SparkSession, path: str) -> DataFrame:
    latest = spark.read.parquet(f"{path}/_published").agg(F.max("batch_id")).first()[0]
    return spark.read.parquet(f"{path}/batch_id={latest}")


# ------------------------------------------------------------ exact gold

ID_BUCKETS = 256
# The state of ``latest_with_days`` has a row for every id ever seen: it is kept in
# files with a bounded cache, since the default store holds all of it in the heap.
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
ID_STATE = {"spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            f"{_ROCKSDB}.boundedMemoryUsage": "true", f"{_ROCKSDB}.trackTotalNumberOfRows": "false"}
# A run of one batch closes each store with its task: an open one takes disk (4 MB at
# least) and memory on its executor until long after the run. Not for runs of many
# batches, which would load the ids again for each.
ONE_BATCH_STATE = {**ID_STATE, "spark.sql.streaming.stateStore.unloadOnCommit": "true"}
EXACT_LAYERS = ["current", "gold_daily", "gold_users"]
SMALL_LAYERS = ("gold_daily", "gold_users", "sketches")


def read_generation(spark: SparkSession, root: str, name: str, before: int | None = None) -> DataFrame | None:
    """Current rows of a stored layer (None before the first batch)."""
    return DayTables(spark, root, SMALL_LAYERS).read(name, before=before)


def latest_with_days(bronze: DataFrame) -> DataFrame:
    """Keyed streaming aggregate (update mode): for every id of a micro-batch
    its latest copy so far and ``days``, all days on which a copy ever was.

    The state store is the index of ids: a micro-batch looks up and rewrites the
    keys it holds and no others, whatever the number of ids seen before."""
    order = ["event_timestamp"] + (["copy_no"] if "copy_no" in bronze.columns else [])
    rest = [c for c in bronze.columns if c != "event_id" and c not in order]
    return (bronze.groupBy("event_id")
            .agg(F.max(F.struct(*order, *rest)).alias("_w"), F.collect_set(day_of()).alias("days"))
            .select("event_id", *[F.col(f"_w.{c}").alias(c) for c in order + rest], "days"))


def gold_exact_sink(spark: SparkSession, root: str):
    """foreachBatch body over ``latest_with_days``: exact daily metrics and user
    activity of the days a batch touches, kept up to date under ``root``.

    ``current`` holds the latest copy of every event by day. Only the touched
    days of it are read, merged with the batch and written anew, and the two
    gold layers are recomputed for the same days (see ``DayTables``)."""
    tables = DayTables(spark, root, SMALL_LAYERS)

    def run(batch: DataFrame, batch_id: int) -> None:
        # the plan above reads and writes state: run it once
        arrived = f"{root}/arrived/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(arrived)
        rows = spark.read.schema(batch.schema).parquet(arrived)
        days = sorted(r.day for r in rows.select(F.explode("days").alias("day")).distinct().collect())
        if not days:
            return
        rows = rows.drop("days")
        have = tables.read("current", days, before=batch_id, schema=rows.schema)
        if have is not None:
            rows = rows.unionByName(have)
        order = ["event_timestamp"] + (["copy_no"] if "copy_no" in rows.columns else [])
        now = tables.put(keep_latest(rows, ["event_id"], order).select("*", day_of()), "current", batch_id).drop("day")
        silver = ev.silver_events(now, dedup="stored")
        day = F.col("event_date").cast("string").alias("day")
        gold = {"gold_daily": ev.gold_daily_base(silver), "gold_users": ev.gold_user_activity_base(silver)}
        with ThreadPoolExecutor(len(gold)) as pool:          # two small jobs side by side
            list(pool.map(lambda x: tables.put(x[1].select("*", day), x[0], batch_id), gold.items()))
        tables.publish(batch_id, days, EXACT_LAYERS)
        tables._delete(arrived)
    return run


def gold_exact_incremental(spark: SparkSession, root: str):
    """The same for batches that come without keyed state (a backfill by hand):
    the days of an id are looked up in a stored table of (id, day) of all
    arrivals, in ``ID_BUCKETS`` folders by id. A stream uses
    ``latest_with_days`` instead, whose lookups do not grow with the history."""
    sink = gold_exact_sink(spark, root)

    def run(batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64("event_id"), F.lit(ID_BUCKETS)).alias("bucket")
        arrivals = batch.select("event_id", day_of(), bucket).distinct()
        (arrivals.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("bucket").parquet(f"{root}/ids/batch_id={batch_id}"))
        ids = (spark.read.parquet(f"{root}/ids").where(F.col("batch_id") <= batch_id)
               .join(arrivals.select("event_id", "bucket").distinct(), ["event_id", "bucket"], "left_semi"))
        days = ids.groupBy("event_id").agg(F.collect_set(F.col("day").cast("string")).alias("days"))
        sink(batch.join(days, "event_id"), batch_id)
    return run


# ------------------------------------------------------------ mergeable gold

HLL_LG, KLL_K = 12, 400     # about 1.6 % error of distinct counts, 0.7 % of ranks
SKETCH_LAYERS = ["sketches"]


def _measures(value: Column) -> list[Column]:
    exact = value.try_cast("decimal(38,12)")
    return [F.count(F.lit(1)).alias("event_count"), F.count(value).alias("values"),
            F.sum(exact).alias("exact_sum"), F.hll_sketch_agg("user_id", HLL_LG).alias("users"),
            F.kll_sketch_agg_double(value, KLL_K).alias("quantiles")]


def sketch_rows(silver: DataFrame) -> DataFrame:
    """Mergeable row per (date, type, weekend): counts, exact sum, a sketch of
    the users and one of the values."""
    return silver.groupBy(*ev.GOLD_KEYS).agg(*_measures(F.col("event_value")))


def merge_sketches(rows: DataFrame) -> DataFrame:
    """Union of mergeable rows of the same group."""
    return rows.groupBy(*ev.GOLD_KEYS).agg(
        F.sum("event_count").alias("event_count"), F.sum("values").alias("values"),
        F.sum("exact_sum").cast("decimal(38,12)").alias("exact_sum"),
        F.hll_union_agg("users").alias("users"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def gold_sketch_sink(spark: SparkSession, root: str):
    """foreachBatch body over Silver rows: adds a batch's sketches to the stored
    ones. A group's row has a fixed size, only the days of the batch are read
    and written anew, and no state is kept in the stream; in complete mode every
    group ever seen would be written for every batch."""
    tables = DayTables(spark, root, SMALL_LAYERS)

    def run(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY)).alias("day")
        fresh = f"{root}/arrived/batch_id={batch_id}"
        sketch_rows(batch).select("*", day).write.mode("overwrite").parquet(fresh)
        rows = spark.read.parquet(fresh)
        days = sorted(r.day for r in rows.select("day").distinct().collect())
        if not days:
            return
        have = tables.read("sketches", days, before=batch_id)
        rows = rows.drop("day")
        merged = merge_sketches(rows if have is None else rows.unionByName(have))
        tables.put(merged.select("*", day), "sketches", batch_id)
        tables.publish(batch_id, days, SKETCH_LAYERS)
        tables._delete(fresh)
    return run


def read_sketch_gold(spark: SparkSession, root: str, keys: list[str] | None = None) -> DataFrame:
    """Daily metrics from the stored sketches; with ``keys`` (some of the
    group's) rolled up to them by merging, for example to all types of a day."""
    keys = ev.GOLD_KEYS if keys is None else keys
    rows = DayTables(spark, root, SMALL_LAYERS).read("sketches")
    total = F.sum("exact_sum").cast("double")
    p95 = F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("quantiles"), F.lit(0.95))
    return rows.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"), total.alias("total_value"),
        F.try_divide(total, F.sum("values")).alias("avg_value"),
        F.when(F.sum("values") > 0, p95).alias("p95_value"))


def replay_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                  partition_by: list[str] | None = ("event_date",)) -> None:
    """Rebuild Silver from the full Bronze history after a rule change (batch
    recompute + overwrite). Streams restarted afterwards need a new
    checkpoint, since their old offsets describe the replaced output."""
    silver = ev.silver_events(spark.read.parquet(bronze_path))
    w = silver.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(silver_path)


def rule_metrics_sink(root: str, rules, dataset: str, write):
    """foreachBatch body that appends one row per rule and batch (passed and
    failed counts, in the batch's own pass) under ``root``, then calls
    ``write(batch, batch_id)``; a replayed batch replaces its rows, so the sum
    over batches is exact."""
    def run(batch: DataFrame, batch_id: int) -> None:
        rule_metrics(batch, rules, dataset).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
        write(batch, batch_id)
    return run


def read_rule_metrics(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)
