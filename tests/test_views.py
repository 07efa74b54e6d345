"""Aggregate views refreshed from the change feed, against a full recompute."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.changelog import ChangeLog
from strata.sinks.tables import publish
from strata.sinks.views import AggregateView

SCHEMA = "id long, g string, v decimal(12,2), w long"


def full(log, view):
    return view._full(view._rows(log.snapshot()))


def equal(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def rows(spark, ids, rnd):
    return spark.createDataFrame([(i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, rnd.randrange(-50, 50)]), rnd.randrange(9))
                                  for i in ids], "id long, g string, v int, w long").withColumn("v", F.col("v").cast("decimal(12,2)"))


def test_refresh_equals_recompute_after_random_changes(spark, tmp):
    rnd = random.Random(2)
    log = ChangeLog(spark, f"{tmp}/log", ["id"])
    view = AggregateView(log, f"{tmp}/view", ["g"], {"v": "v", "twice": "2 * w"}, "w < 8")
    log.create(rows(spark, range(40), rnd))
    assert view.refresh() == -1 and view.refresh() == 0
    steps = [lambda: log.insert(rows(spark, range(40, 60), rnd)),
             lambda: log.update("id % 5 = 0", {"g": "'d'", "v": "v + 1"}),
             lambda: log.delete("id % 7 = 0"),
             lambda: log.merge(rows(spark, range(30, 70), rnd)),
             lambda: log.update("id % 2 = 0", {"v": F.lit(None).cast("decimal(12,2)")}),
             lambda: log.delete("g = 'a'")]
    for k, step in enumerate(steps):
        step()
        if k != 2:                                             # two versions in one refresh
            view.refresh()
            equal(view.read().drop("avg_v", "avg_twice"), full(log, view))
    log.delete("true")
    view.refresh()
    assert view.read().count() == 0
    log.insert(rows(spark, range(5), rnd))
    view.refresh()
    equal(view.read().drop("avg_v", "avg_twice"), full(log, view))


def test_extremes_are_recomputed_only_where_one_left(spark, tmp):
    log = ChangeLog(spark, f"{tmp}/log", ["id"])
    view = AggregateView(log, f"{tmp}/view", ["g"], {"v": "v"})
    log.create(spark.createDataFrame([(i, "ab"[i % 2], i, 0) for i in range(20)], "id long, g string, v int, w long")
               .withColumn("v", F.col("v").cast("decimal(12,2)")))
    view.refresh()
    log.delete("id = 10")                                      # inside group a
    assert view.refresh() == 0
    log.delete("id = 19")                                      # the greatest of b
    assert view.refresh() == 1
    assert {r.g: (int(r.min_v), int(r.max_v), r.n_rows) for r in view.read().collect()} == {"a": (0, 18, 9), "b": (1, 17, 9)}


def test_failed_refresh_keeps_the_view(spark, tmp, monkeypatch):
    log = ChangeLog(spark, f"{tmp}/log", ["id"])
    view = AggregateView(log, f"{tmp}/view", ["g"], {"v": "v"})
    log.create(spark.createDataFrame([(1, "a", 1, 1)], "id long, g string, v int, w long"))
    view.refresh()
    log.insert(spark.createDataFrame([(2, "a", 5, 1)], "id long, g string, v int, w long"))
    monkeypatch.setattr(AggregateView, "_merged", lambda self, old, delta: old.withColumn("_lost", F.raise_error(F.lit("no")).cast("boolean")))
    with pytest.raises(Exception, match="no"):
        view.refresh()
    assert view.read().collect()[0].n_rows == 1 and view.applied() == 0
    monkeypatch.undo()
    view.refresh()
    assert view.read().collect()[0].n_rows == 2 and view.applied() == 1


def test_publish_refuses_an_older_version(spark, tmp):
    df = spark.range(1)
    publish(df, f"{tmp}/t", version=3)
    with pytest.raises(RuntimeError):
        publish(df, f"{tmp}/t", version=2)
