"""Layers replaced day by day: flat cost per batch, replays, keyed state,
mergeable sketches, dedup bounded by arrival."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.plans import events as ev
from strata.streaming import flows
from strata.streaming.days import DayTables

SCHEMA = ("event_id long, user_id long, event_type string, event_value double, event_timestamp timestamp_ntz, "
          "source_ip string, copy_no int, days array<string>")


def row(i, day, value, copy=0, days=None):
    ts = None if day is None else dt.datetime(2024, 1, 1, 9, i % 60) + dt.timedelta(days=day)
    name = "none" if ts is None else str(ts.date())
    return (i, i % 5, "ab"[i % 2], value, ts, "1.1.1.1", copy, sorted({name, *(days or [])}))


def few_tasks(spark):
    """Plans for tiny batches: one task a stage, no re-planning."""
    for k, v in (("spark.sql.shuffle.partitions", "1"), ("spark.sql.adaptive.enabled", "false")):
        RESTORE[k] = spark.conf.get(k)
        spark.conf.set(k, v)


RESTORE = {}


@pytest.fixture(autouse=True)
def restored(spark):
    yield
    for k, v in list(RESTORE.items()):
        spark.conf.set(k, v)
    RESTORE.clear()


def size(files):
    return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in files)


def test_fifty_batches_read_no_more_than_the_first_ones(spark, tmp, monkeypatch):
    read = []
    inner = DayTables.read

    def counted(self, layer, days=None, before=None, schema=None):
        df = inner(self, layer, days, before, schema)
        if before is not None:
            read.append(size(df.inputFiles()) if df is not None else 0)
        return df

    monkeypatch.setattr(DayTables, "read", counted)
    monkeypatch.setattr(ev, "gold_user_activity_base", lambda s: s.select("event_date", "user_id").distinct())
    sink = flows.gold_exact_sink(spark, f"{tmp}/exact")
    latest = {}
    few_tasks(spark)
    for b in range(50):
        # a new day, and three late copies of the day before
        rows = [row(100 * b + k, b, float(k)) for k in range(20)]
        rows += [row(100 * (b - 1) + k, b - 1, 500.0 + k, 1) for k in range(3)] if b else []
        latest |= {r[0]: r for r in rows}
        sink(spark.createDataFrame(rows, SCHEMA).coalesce(1), b)
    first, last = sum(read[2:12]), sum(read[40:50])
    assert 0 < last <= 1.1 * first, read
    want = spark.createDataFrame(list(latest.values()), SCHEMA).drop("days")
    assert flows.read_generation(spark, f"{tmp}/exact", "current").exceptAll(want).count() == 0
    gold = flows.read_generation(spark, f"{tmp}/exact", "gold_daily")
    full = ev.gold_daily_base(ev.silver_events(want)).select(*gold.columns)
    assert gold.exceptAll(full).count() == full.exceptAll(gold).count() == 0 and full.count() == 100
    # superseded folders are gone: at most two publications are kept
    assert len(glob.glob(f"{tmp}/exact/pointers/v=*")) == 2
    assert len(glob.glob(f"{tmp}/exact/current/batch_id=*/day=*")) <= 50 + 4
    assert not glob.glob(f"{tmp}/exact/arrived/batch_id=*")


def test_exact_sink_replays_and_clears_days(spark, tmp):
    sink = flows.gold_exact_sink(spark, f"{tmp}/exact")
    batches = [[row(1, 0, 5.0), row(2, None, 1.0), row(3, 0, 2.0)],
               [row(1, 1, 6.0, 1, ["2024-01-01"]), row(3, 1, 9.0, 1, ["2024-01-01"])],
               [row(2, 2, 4.0, 1, ["none"])]]
    for n in (0, 0, 1, 1, 2, 2):
        sink(spark.createDataFrame(batches[n], SCHEMA), n)
    got = {str(r.event_date): (r.event_count, r.total_value)
           for r in flows.read_generation(spark, f"{tmp}/exact", "gold_daily").groupBy("event_date").agg(
               F.sum("event_count").alias("event_count"), F.sum("total_value").alias("total_value")).collect()}
    assert got == {"2024-01-02": (2, 15.0), "2024-01-03": (1, 4.0)}
    assert flows.read_generation(spark, f"{tmp}/exact", "current").count() == 3
    assert flows.read_generation(spark, f"{tmp}/exact", "current", before=2).count() == 3   # the one before stays
    sink(spark.createDataFrame([], SCHEMA), 3)                                  # nothing arrived
    assert flows.read_generation(spark, f"{tmp}/exact", "current").count() == 3


def land(spark, rows, path, age):
    """One JSON file, landed ``age`` seconds after a fixed time."""
    spark.createDataFrame(rows, SCHEMA).drop("days").coalesce(1).write.mode("overwrite").option(
        "timestampNTZFormat", flows.TS_FORMAT).json(path)
    for f in glob.glob(f"{path}/*.json"):
        os.utime(f, (1_700_000_000 + age,) * 2)


def test_keyed_state_remembers_all_days_across_restarts(spark, tmp):
    """Copies of one id on three days, each in a run of its own: the third run
    must clear the day of the second, which only the state knows."""
    for k, day in enumerate((0, 1, 2)):
        land(spark, [row(7, day, float(k), k), row(8 + k, day, 1.0)], f"{tmp}/landing/d{k}", k)
        src = flows.read_landing(spark, f"{tmp}/landing/*")
        flows.start(flows.latest_with_days(src), f"{tmp}/_ckpt", mode="update",
                    foreach_batch=flows.gold_exact_sink(spark, f"{tmp}/exact")).awaitTermination()
        rows = flows.read_generation(spark, f"{tmp}/exact", "current").where("event_id = 7").collect()
        assert [(r.copy_no, r.event_timestamp.day) for r in rows] == [(k, day + 1)]
    gold = flows.read_generation(spark, f"{tmp}/exact", "gold_daily").groupBy("event_date").agg(F.sum("event_count").alias("n"))
    assert sorted(r.n for r in gold.collect()) == [1, 1, 2]


def test_sketches_merge_by_day_with_measured_error(spark, tmp):
    rnd = random.Random(4)
    sink = flows.gold_sketch_sink(spark, f"{tmp}/gold")
    schema = "event_date date, event_type string, is_weekend boolean, user_id long, event_value double"
    day = dt.date(2024, 1, 1)
    every = []
    for b in range(4):
        rows = [(day + dt.timedelta(days=b + k % 2), "ab"[k % 2 and rnd.random() < 0.5], False, rnd.randrange(30_000),
                 round(rnd.gauss(100, 30), 2) if k % 50 else None) for k in range(15_000)]
        every += rows
        frame = spark.createDataFrame(rows, schema)
        for _ in range(2 if b == 2 else 1):                                     # one replay
            sink(frame, b)
        touched = spark.read.parquet(f"{tmp}/gold/sketches/batch_id={b}").select("day").distinct().count()
        assert touched == 2                                                     # and no other day is written
    silver = spark.createDataFrame(every, schema)
    keys = ["event_date", "event_type", "is_weekend"]
    got = flows.read_sketch_gold(spark, f"{tmp}/gold").join(silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"),
        F.sum(F.col("event_value").cast("decimal(18,2)")).cast("double").alias("total")), keys).collect()
    assert len(got) == silver.select(*keys).distinct().count()
    for r in got:
        assert r.event_count == r.n and abs(r.total_value - r.total) < 1e-6 and abs(r.unique_users - r.users) <= 0.07 * r.users
        values = sorted(x[4] for x in every if x[0] == r.event_date and x[1] == r.event_type and x[4] is not None)
        below = sum(v < r.p95_value for v in values) / len(values)
        upto = sum(v <= r.p95_value for v in values) / len(values)
        assert below <= 0.96 and upto >= 0.94
    days = flows.read_sketch_gold(spark, f"{tmp}/gold", ["event_date"]).collect()
    for r in days:
        users = len({x[3] for x in every if x[0] == r.event_date})
        assert abs(r.unique_users - users) <= 0.07 * users


def test_bounded_dedup_takes_all_rows_and_keeps_state_flat(spark, tmp):
    """Twelve landings a day apart, horizon two days; every landing repeats the
    ids of the one before, half of them without event time."""
    states, total = [], 0
    for k in range(12):
        fresh = [row(10 * k + j, None if j % 2 else k, 1.0) for j in range(10)]
        again = [row(10 * (k - 1) + j, None if j % 3 else k, 2.0, 1) for j in range(10)] if k else []
        land(spark, fresh + again, f"{tmp}/landing/d{k:02d}", 86_400 * k)
        total += len(fresh)
        src = flows.read_landing(spark, f"{tmp}/landing/*", arrival=True)
        silver = flows.silver_stream(flows.bronze_stream(src, ev.check_clock()), drop_rules=False, horizon="2 days")
        q = flows.start(silver, f"{tmp}/_ckpt", f"{tmp}/silver")                # a restart for every landing
        q.awaitTermination()
        states.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))
    out = spark.read.parquet(f"{tmp}/silver")
    assert out.count() == out.select("event_id").distinct().count() == total
    assert out.where("copy_no = 1").count() == 0 and out.where("event_timestamp is null").count() > 0
    assert max(states[6:]) <= max(states[:6]) <= 60, states
