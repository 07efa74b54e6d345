"""Streaming flows: availableNow runs, dedup, exact vs approximate gold."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from strata.plans import events as ev
from strata.plans import streams as st
from strata.streaming import flows

from conftest import SF_SMALL


def test_stream_bronze_rerun_is_noop(spark, tmp):
    path = st.run_bronze(spark, SF_SMALL, tmp)
    n = spark.read.parquet(path).count()
    assert n == 996
    bronze = flows.bronze_stream(flows.read_landing(spark, f"{tmp}/landing"))
    q = flows.start(bronze, f"{tmp}/_ckpt_bronze", path, partition_by=["event_type"])
    q.awaitTermination()
    assert spark.read.parquet(path).count() == n


def test_stream_gold_exact_equals_batch(spark):
    got = st.q_stream_gold_exact(spark, SF_SMALL)
    _, _, silver = ev.pipeline(spark, SF_SMALL)
    want = ev.gold_daily_base(silver)
    cols = want.columns
    assert got.select(*cols).exceptAll(want).count() == 0
    assert want.exceptAll(got.select(*cols)).count() == 0


def test_stream_gold_approx_within_stated_error(spark):
    approx = st.q_stream_gold_approx(spark, SF_SMALL)
    assert approx.filter("NOT users_within_error OR NOT p95_within_error").count() == 0
    assert approx.count() > 0


def test_exact_gold_clears_a_day_that_an_event_left(spark, tmp):
    """Three batches: an event, its later copy on the next day, a replay."""
    schema = "event_id long, user_id long, event_type string, event_value double, event_timestamp timestamp_ntz, source_ip string, copy_no int"
    import datetime as dt
    row = lambda i, day, v, c: (i, 7, "a", v, dt.datetime(2024, 1, day, 23), "1.1.1.1", c)
    run = flows.gold_exact_incremental(spark, f"{tmp}/exact")
    batches = [spark.createDataFrame([row(1, 1, 5.0, 0)], schema),
               spark.createDataFrame([row(1, 2, 6.0, 1), row(2, 2, 0.004, 0)], schema)]
    for n in (0, 1, 1):
        run(batches[n], n)
    got = {str(r.event_date): (r.event_count, r.total_value)
           for r in flows.read_generation(spark, f"{tmp}/exact", "gold_daily").collect()}
    assert got == {"2024-01-02": (2, 6.004)}
    users = flows.read_generation(spark, f"{tmp}/exact", "gold_users").collect()
    assert [(str(r.event_date), r.daily_event_count) for r in users] == [("2024-01-02", 2)]


def test_rule_metrics_sum_over_batches(spark, tmp):
    path = st.run_bronze(spark, SF_SMALL, tmp)
    src = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    kept = []
    sink = flows.rule_metrics_sink(f"{tmp}/metrics", ev.SILVER_RULES, "silver", lambda b, n: kept.append(n))
    flows.start(src, f"{tmp}/_ck_metrics", foreach_batch=sink).awaitTermination()
    m = flows.read_rule_metrics(spark, f"{tmp}/metrics").groupBy("rule").agg(
        F.sum(F.col("passed") + F.col("failed")).alias("n")).collect()
    assert len(kept) > 1 and {r.n for r in m} == {996}


def test_stream_dedup_keeps_one_row_per_id(spark):
    df = st.q_stream_dedup(spark, SF_SMALL)
    assert df.count() == df.select("event_id").distinct().count() == 986


def test_watermarked_dedup_and_replay(spark, tmp):
    path = st.run_bronze(spark, SF_SMALL, tmp)
    src = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    silver = flows.silver_stream(src, watermark="2 hours")
    q = flows.start(silver, f"{tmp}/_ckpt_wm", f"{tmp}/silver_wm")
    q.awaitTermination()
    ids = spark.read.parquet(f"{tmp}/silver_wm").select("event_id")
    assert ids.count() == ids.distinct().count() > 900
    flows.replay_silver(spark, path, f"{tmp}/silver_replayed")
    assert spark.read.parquet(f"{tmp}/silver_replayed").count() == \
        ev.silver_events(spark.read.parquet(path)).count()


def test_stream_static_join_and_continuous_trigger(spark, tmp):
    """Enrichment of a stream with a static dimension, run on a processing-
    time trigger (continuous mode) until the available input is drained."""
    path = st.run_bronze(spark, SF_SMALL, tmp)
    src = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    enriched = ev.events_with_profile(flows.silver_stream(src), customer)
    q = flows.start(enriched, f"{tmp}/_ckpt_join", f"{tmp}/joined", once=False,
                    interval="1 second")
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(f"{tmp}/joined")
    assert out.count() > 0 and out.filter("user_name IS NULL").count() == 0


def events_table(spark, path):
    """300 events of 20 users on three days, in the schema of the feed."""
    spark.range(1, 301).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 22:00:00' + make_dt_interval(CAST(id % 3 AS INT), 0, CAST(id % 180 AS INT)) AS ts",
        "id % 20 AS user_id", "element_at(array('a', 'b'), CAST(id % 2 + 1 AS INT)) AS event_type",
        "CAST(id AS DOUBLE) / 4 AS value", "'{}' AS props").write.parquet(f"{path}/events.parquet")
    return path


def test_exact_flow_keeps_its_ids_out_of_the_heap(spark, tmp):
    """The keyed state has a row per id ever seen, so it is not in the default store,
    and the session's own settings stay as they were."""
    before = {k: spark.conf.get(k, None) for k in flows.ONE_BATCH_STATE}
    root = st.run_exact(spark, events_table(spark, f"{tmp}/in"), "test-exact").removesuffix("/exact")
    assert glob.glob(f"{root}/_ckpt_gold/state/0/*/*.zip") and not glob.glob(f"{root}/_ckpt_gold/state/0/*/*.delta")
    assert {k: spark.conf.get(k, None) for k in flows.ONE_BATCH_STATE} == before
    _, _, silver = ev.pipeline(spark, f"{tmp}/in")
    for name, want in (("gold_daily", ev.gold_daily_base(silver)), ("gold_users", ev.gold_user_activity_base(silver))):
        got = flows.read_generation(spark, f"{root}/exact", name).select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 0


def test_a_session_that_names_its_state_store_keeps_it(spark, tmp):
    key = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, default)
    try:
        root = st.run_exact(spark, events_table(spark, f"{tmp}/in"), "test-exact").removesuffix("/exact")
        assert spark.conf.get(key) == default and glob.glob(f"{root}/_ckpt_gold/state/0/*/*.delta")
    finally:
        spark.conf.unset(key)


def test_exact_sink_dedups_a_batch_once(spark, tmp, monkeypatch):
    """Gold is made from the stored latest copies without another dedup of them."""
    plans, daily, users = [], ev.gold_daily_base, ev.gold_user_activity_base
    seen = lambda silver: plans.append(silver._jdf.queryExecution().optimizedPlan().toString()) or silver
    monkeypatch.setattr(ev, "gold_daily_base", lambda s: daily(seen(s)))
    monkeypatch.setattr(ev, "gold_user_activity_base", lambda s: users(seen(s)))
    schema = "event_id long, user_id long, event_type string, event_value double, event_timestamp timestamp_ntz, source_ip string, copy_no int, days array<string>"
    at = lambda day: dt.datetime(2024, 1, day, 9)
    batches = [[(1, 7, "a", 5.0, at(1), "1.1.1.1", 0, ["2024-01-01"]), (2, 7, "a", None, None, "1.1.1.1", 0, ["none"])],
               [(1, 7, "a", 6.0, at(2), "1.1.1.1", 1, ["2024-01-01", "2024-01-02"]), (1, 7, "a", 4.0, at(1), "1.1.1.1", 0, ["2024-01-01"]),
                (3, 7, "b", 1.0, at(2), "1.1.1.1", 0, ["2024-01-02"])]]
    sink = flows.gold_exact_sink(spark, f"{tmp}/exact")
    for n, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, schema), n)
    assert len(plans) == 4 and not any("Aggregate" in p for p in plans), plans
    got = {(str(r.event_date), r.event_type, r.event_count, r.total_value)
           for r in flows.read_generation(spark, f"{tmp}/exact", "gold_daily").collect()}
    assert got == {("2024-01-02", "a", 1, 6.0), ("2024-01-02", "b", 1, 1.0)}
    assert flows.read_generation(spark, f"{tmp}/exact", "current").count() == 3
