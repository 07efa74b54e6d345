"""Event medallion on a small pretty-printed JSON array (with a surplus
closing bracket after it) and on the fault-injected test table."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import events as ev
from strata.sources.readers import read_json
from strata.sources.tables import dirty_events

from conftest import SF_CHECK, SF_SMALL

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("event_value", T.DoubleType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("source_ip", T.StringType())])

# 2026-10-08 is a Thursday, 2026-10-10 a Saturday.
EVENTS = [
    (1, 501, "login", 1.0, "2026-10-08 09:00:00", "192.168.1.1"),
    (2, 502, "purchase", 250.0, "2026-10-08 09:05:00", "10.0.0.2"),
    (2, 502, "purchase", 250.0, "2026-10-08 09:05:00", "10.0.0.2"),
    (4, 503, "purchase", 40.0, "2026-10-10 10:00:00", "10.0.0.3"),
    (5, 501, "search", 1.0, "2026-10-08 09:10:00", "192x168x1x1"),
    (6, None, "search", 1.0, "2026-10-08 09:20:00", "10.0.0.6"),
    (7, 504, "purchase", -5.0, "2026-10-08 11:00:00", "10.0.0.4"),
    (8, 501, "logout", 1.0, None, "10.0.0.8"),
]


@pytest.fixture()
def sample_path(tmp):
    keys = ["event_id", "user_id", "event_type", "event_value", "event_timestamp", "source_ip"]
    text = json.dumps([dict(zip(keys, e)) for e in EVENTS], indent=2) + "\n]\n"
    path = f"{tmp}/events.json"
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture()
def sample(spark, sample_path):
    return read_json(spark, sample_path, SCHEMA, multi_line=True,
                     timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


def test_line_mode_reader_yields_only_null_rows(spark, sample_path):
    rows = read_json(spark, sample_path, SCHEMA).collect()
    assert rows and all(r["event_id"] is None for r in rows)


def test_multiline_reader_takes_first_array(sample):
    assert sample.count() == 8


def test_sample_gold_daily(sample):
    bronze = ev.bronze_events(sample)
    silver = ev.silver_events(bronze)
    assert bronze.count() == 7 and silver.count() == 5
    gold = {(str(r["event_date"]), r["event_type"]): r
            for r in ev.gold_daily_event_metrics(silver).collect()}
    assert set(gold) == {("2026-10-08", "login"), ("2026-10-08", "purchase"),
                         ("2026-10-08", "search"), ("2026-10-10", "purchase")}
    p = gold[("2026-10-08", "purchase")]
    assert (p["event_count"], p["unique_users"], p["total_value"], p["avg_value"],
            p["p95_value"], p["is_weekend"]) == (2, 2, 245.0, 122.5, 250.0, False)
    assert gold[("2026-10-10", "purchase")]["is_weekend"] is True


def test_sample_user_activity_buckets_kpis(sample):
    bronze = ev.bronze_events(sample)
    silver = ev.silver_events(bronze)
    act = {(str(r["event_date"]), r["user_id"]): (r["daily_event_count"], r["event_type_variety"],
                                                  r["activity_tier"])
           for r in ev.gold_user_activity(silver).collect()}
    assert act[("2026-10-08", 501)] == (2, 2, "casual_user") and len(act) == 4
    cats = {r["value_category"]: r["n"] for r in
            silver.groupBy("value_category").agg(F.count("*").alias("n")).collect()}
    assert cats == {"low": 4, "high": 1}
    kpis = {r["metric_name"]: r["metric_value"] for r in
            ev.quality_kpis(bronze, silver).collect()}
    assert kpis == {"bronze_to_silver_retention": 71.43, "silver_dedup_rate": 28.57}
    m = {(r["rule"]): (r["passed"], r["failed"]) for r in
         ev.expectation_metrics(sample).filter("dataset = 'silver_events'").collect()}
    assert m == {"positive_value": (5, 1), "valid_ip_format": (5, 1), "valid_timestamp": (5, 1)}


def test_ip_rule_intended_vs_loose(spark):
    from strata.functions.events import ip_rule_sql
    df = spark.createDataFrame([("192.168.1.101",), ("192x168x1x101",), ("not-an-ip",)], "source_ip string")
    strict = [r[0] for r in df.filter(ip_rule_sql()).collect()]
    loose = [r[0] for r in df.filter(ip_rule_sql(compat=True)).collect()]
    assert strict == ["192.168.1.101"]
    assert sorted(loose) == ["192.168.1.101", "192x168x1x101"]


@pytest.mark.parametrize("sf, expected", [
    (SF_SMALL, dict(rows=1011, bronze=996, latest=986, null_ts=11, neg=34, bad_ip=27)),
    (SF_CHECK, dict(rows=10104, bronze=9955, latest=9853, null_ts=111, neg=352, bad_ip=273)),
])
def test_dirty_events_recipe_counts(spark, sf, expected):
    landed = dirty_events(spark, sf)
    bronze = ev.bronze_events(landed)
    base = ev.silver_base(bronze)
    got = base.agg(
        F.count("*").alias("latest"),
        F.sum(F.when(F.col("event_timestamp").isNull(), 1).otherwise(0)).alias("null_ts"),
        F.sum(F.when(F.coalesce(F.col("event_value") > 0, F.lit(False)), 0).otherwise(1)).alias("neg"),
        F.sum(F.when(F.expr(ev.ip_rule_sql()), 0).otherwise(1)).alias("bad_ip")).first()
    assert landed.count() == expected["rows"]
    assert bronze.count() == expected["bronze"]
    assert got["latest"] == expected["latest"]
    assert got["null_ts"] == expected["null_ts"]
    assert got["neg"] == expected["neg"]
    assert got["bad_ip"] == expected["bad_ip"]


def test_keep_latest_avoids_null_timestamp_copy(spark):
    """An id whose first copy has a NULL timestamp keeps the valid later copy
    under keep-latest (first-seen dedup could lose it)."""
    bronze = ev.bronze_events(dirty_events(spark, SF_CHECK))
    silver = ev.silver_events(bronze)
    s4 = silver.filter((F.col("event_id") % 194 == 0) & (F.col("event_id") % 97 == 0)
                       & (F.col("event_id") % 89 != 0))
    assert s4.count() == 51
    assert s4.filter("copy_no = 1").count() == 51
