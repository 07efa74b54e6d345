"""Plan shape checks: pruning and pushdown reach the scan, dedup and
distinct counts pre-aggregate, bounded broadcasts only, and a hot key gives
the same answer as the reference formulation."""

import contextlib
import io

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.dedup import keep_latest
from strata.plans import events as ev
from strata.plans import kpi

from conftest import SF_SMALL


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(kpi.q_top20(spark, SF_SMALL))
    assert "EqualTo(r_name,EUROPE)" in p
    assert "l_shipdate" not in p and "l_returnflag" not in p   # pruned columns
    assert "TakeOrderedAndProject" in p


def test_dedup_and_distinct_preaggregate(spark):
    _, _, silver = ev.pipeline(spark, SF_SMALL)
    p = plan(ev.gold_daily_base(silver))
    assert "partial_max" in p                 # keep-latest combines map-side
    assert "partial_count" in p
    assert "percentile_approx" in p


def test_fixed_dimensions_broadcast(spark):
    p = plan(kpi.q_country_5y(spark, SF_SMALL))
    assert "BroadcastExchange" in p and "BroadcastNestedLoopJoin" not in p


def test_hot_key_keep_latest_matches_window(spark):
    """A third of all rows share one key."""
    ev_raw = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev_raw.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit(-1))
                            .otherwise(F.col("event_id")))
    got = keep_latest(hot, ["k"], ["ts", "event_id"])
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("event_id").desc())
    want = hot.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count()


def test_bucketed_tables_join_without_shuffle(spark, tmp):
    from strata.sinks.tables import write_bucketed
    from strata.plans.kpi import order_totals
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    write_bucketed(li, "li_bucketed", ["l_orderkey"], 8, f"{tmp}/li")
    write_bucketed(o.withColumnRenamed("o_orderkey", "l_orderkey"), "o_bucketed",
                   ["l_orderkey"], 8, f"{tmp}/o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = order_totals(spark.table("li_bucketed")).join(spark.table("o_bucketed"), "l_orderkey")
        p = plan(j)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == o.join(li.select("l_orderkey").distinct(),
                                   o.o_orderkey == F.col("l_orderkey")).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
