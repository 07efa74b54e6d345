"""Versioned table goldens: the four-employee table through insert, update
and delete (versions 0-3), plus properties of as-of reads, diff and feed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.changelog import ChangeLog

EMP = [(1, "Kristi", "United States", "Data Engineer"),
       (2, "Sophia", "Germany", "Data Analyst"),
       (3, "Peter", "Canada", "ML Engineer"),
       (4, "Zebi", "India", "Data Scientist")]
SCHEMA = "ID int, FirstName string, Country string, Role string"


def clock(v):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=v)


@pytest.fixture()
def log(spark, tmp):
    t = ChangeLog(spark, f"{tmp}/employees", ["ID"], clock, user="tester")
    t.create(spark.createDataFrame(EMP, SCHEMA))
    t.insert(spark.createDataFrame([(5, "Maria", "Brazil", "Data Engineer"),
                                    (6, "Aiden", "Australia", "Data Analyst")], SCHEMA))
    t.update("FirstName = 'Maria'", {"Role": "'Senior Data Engineer'"})
    t.delete("FirstName = 'Aiden'")
    return t


def roles(df):
    return {r["FirstName"]: r["Role"] for r in df.collect()}


def test_version_row_counts(log):
    assert [log.snapshot(v).count() for v in range(4)] == [4, 6, 6, 5]
    assert log.snapshot().count() == 5


def test_update_and_time_travel(log):
    assert roles(log.snapshot(1))["Maria"] == "Data Engineer"
    assert roles(log.snapshot(2))["Maria"] == "Senior Data Engineer"
    assert "Aiden" not in roles(log.snapshot())
    assert log.snapshot_at(dt.datetime(2024, 1, 1, 1, 30)).count() == 6
    with pytest.raises(ValueError):
        log.version_at(dt.datetime(2023, 1, 1))


def test_history_operations(log):
    h = log.history().orderBy("version").collect()
    assert [r["operation"] for r in h] == ["CREATE TABLE AS SELECT", "WRITE", "UPDATE", "DELETE"]
    assert [r["num_rows"] for r in h] == [4, 2, 1, 1]
    assert {r["userName"] for r in h} == {"tester"}
    # subquery over the history: everything that is not a plain write
    assert log.history().filter("operation <> 'WRITE'").count() == 3


def test_noop_update_commits_no_version(log):
    assert log.update("FirstName = 'Nobody'", {"Role": "'x'"}) is None
    assert log.history().count() == 4


def test_as_of_latest_equals_current_and_self_diff_empty(log):
    assert log.snapshot(3).exceptAll(log.snapshot()).count() == 0
    assert log.diff(2, 2).count() == 0


def test_diff_and_change_feed(log):
    d = {r["ID"]: r["change"] for r in log.diff(0, 3).collect()}
    assert d == {5: "added"}  # Aiden added and deleted; Maria added (then updated)
    feed = sorted((r["_commit_version"], r["_change_type"], r["FirstName"])
                  for r in log.changes(0, 3).collect())
    assert feed == [(1, "insert", "Aiden"), (1, "insert", "Maria"),
                    (2, "update_postimage", "Maria"), (2, "update_preimage", "Maria"),
                    (3, "delete", "Aiden")]
    pre = log.changes(1, 2).filter("_change_type = 'update_preimage'").first()
    assert pre["Role"] == "Data Engineer"


def test_restore_deleted_rows(log):
    restored, v = log.restore_rows(2)
    assert [r["FirstName"] for r in restored.collect()] == ["Aiden"]
    assert v == 4 and log.snapshot().count() == 6


def test_merge_upsert(log, spark):
    src = spark.createDataFrame([(1, "Kristi", "Mexico", "Lead"), (7, "Ana", "Peru", "Analyst")],
                                SCHEMA)
    log.merge(src)
    cur = {r["ID"]: (r["Country"], r["Role"]) for r in log.snapshot().collect()}
    assert cur[1] == ("Mexico", "Lead") and cur[7] == ("Peru", "Analyst") and len(cur) == 6
    log.merge(src.filter(F.col("ID") == 7), delete_not_matched_by_source=True)
    assert sorted(r["ID"] for r in log.snapshot().collect()) == [7]


def test_insert_with_partial_columns_gives_nulls(log, spark):
    log.insert(spark.createDataFrame([(8, "Lee")], "ID int, FirstName string"))
    row = log.snapshot().filter("ID = 8").first()
    assert row["Country"] is None and row["Role"] is None


def test_second_instance_reads_and_writes(log, spark):
    other = ChangeLog(spark, log.path, ["ID"], clock)
    assert other.snapshot().count() == 5 and other.snapshot(0).count() == 4
    assert other.update("FirstName = 'Zebi'", {"Role": "'Lead'"}) == 4
    assert roles(log.snapshot())["Zebi"] == "Lead"
    assert other.diff(3, 4).count() == 1 and other.changes(3).count() == 2
    assert other.merge(spark.createDataFrame(EMP[:1], SCHEMA)) == 5
    assert ChangeLog(spark, log.path, ["ID"]).restore_rows(1)[1] == 6
    with pytest.raises(ValueError):
        other.create(spark.createDataFrame(EMP, SCHEMA))


def test_failed_listing_is_raised_and_overwrites_nothing(log, spark, monkeypatch):
    before = sorted(map(tuple, log.snapshot(0).collect()))

    def broken(self, path):
        raise OSError("injected read failure")
    with monkeypatch.context() as m:
        m.setattr(ChangeLog, "_fs", broken)
        with pytest.raises(OSError):
            log.insert(spark.createDataFrame(EMP[:1], SCHEMA))
        with pytest.raises(OSError):
            log.create(spark.createDataFrame(EMP[:1], SCHEMA))
    assert sorted(map(tuple, log.snapshot(0).collect())) == before and log.latest_version() == 3


def test_taken_version_is_never_overwritten(log, spark, monkeypatch):
    monkeypatch.setattr(ChangeLog, "latest_version", lambda self: 2)
    with pytest.raises(RuntimeError):
        log.insert(spark.createDataFrame(EMP[:1], SCHEMA))
    assert log.snapshot(3).count() == 5


def test_merge_rejects_two_rows_for_a_key(log, spark):
    src = spark.createDataFrame([(1, "A", "x", "y"), (1, "B", "x", "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        log.merge(src)
    assert log.latest_version() == 3


def test_feed_plan_does_not_grow_with_versions(spark, tmp):
    import contextlib
    import io

    def shape(n):
        t = ChangeLog(spark, f"{tmp}/t{n}", ["ID"], clock)
        t.create(spark.createDataFrame(EMP, SCHEMA))
        for i in range(n):
            t.update("ID = 1", {"Role": f"'r{i}'"})
        out = t.changes(0, n)
        assert out.count() == 2 * n
        with contextlib.redirect_stdout(io.StringIO()) as s:
            out.explain()
        text = s.getvalue().split("Initial Plan")[-1]
        return text.count("FileScan"), text.count("Exchange")
    assert shape(2) == shape(8) == (1, 2)
