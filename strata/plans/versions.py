"""Versioned customer table: create, insert, update, delete, merge; history,
as-of reads by version and time, version compare, diff, change feed, restore.

Scenario over ``customer`` (every step is a predicate over all rows):
v0 create with all non-MACHINERY customers; v1 insert the MACHINERY ones;
v2 ``UPDATE SET c_mktsegment = 'SENIOR ' || c_mktsegment WHERE c_acctbal > 9000``;
v3 ``DELETE WHERE c_acctbal < 0``. Commit ``n`` is stamped 2024-03-01 + n hours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.changelog import ChangeLog
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import materialize
from strata.sinks.views import AggregateView
from strata.sources.tables import read_table

BASE_TIME = dt.datetime(2024, 3, 1)
COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def commit_clock(version: int) -> dt.datetime:
    return BASE_TIME + dt.timedelta(hours=version)


def build_customer_log(spark: SparkSession, sf_dir: str) -> ChangeLog:
    cust = read_table(spark, sf_dir, "customer").select(*COLUMNS)
    log = ChangeLog(spark, scratch_path(spark, "customer-log"), ["c_custkey"], commit_clock)
    log.create(cust.filter(F.col("c_mktsegment") != "MACHINERY"))
    log.insert(cust.filter(F.col("c_mktsegment") == "MACHINERY"))
    log.update("c_acctbal > 9000", {"c_mktsegment": "concat('SENIOR ', c_mktsegment)"})
    log.delete("c_acctbal < 0")
    return ChangeLog(spark, log.path, ["c_custkey"], commit_clock)   # opened anew


VERSIONS_SQL = """
WITH v0 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
            FROM customer WHERE c_mktsegment <> 'MACHINERY'),
v1 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
v2 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
              CASE WHEN c_acctbal > 9000 THEN 'SENIOR ' || c_mktsegment ELSE c_mktsegment END
                AS c_mktsegment FROM v1),
v3 AS (SELECT * FROM v2 WHERE NOT (c_acctbal < 0))
"""


@query("dml_insert_update_delete", VERSIONS_SQL + "SELECT * FROM v3")
def q_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).snapshot()


@query("as_of_version", VERSIONS_SQL + "SELECT * FROM v2")
def q_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).snapshot(2)


@query("as_of_timestamp", VERSIONS_SQL + "SELECT * FROM v1")
def q_as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).snapshot_at(BASE_TIME + dt.timedelta(minutes=90))


@query("table_history", VERSIONS_SQL + """
SELECT 0 AS version, TIMESTAMP '2024-03-01 00:00:00' AS timestamp,
       'CREATE TABLE AS SELECT' AS operation, 'strata' AS userName,
       (SELECT COUNT(*) FROM v0) AS num_rows
UNION ALL SELECT 1, TIMESTAMP '2024-03-01 01:00:00', 'WRITE', 'strata',
       (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'MACHINERY')
UNION ALL SELECT 2, TIMESTAMP '2024-03-01 02:00:00', 'UPDATE', 'strata',
       (SELECT COUNT(*) FROM customer WHERE c_acctbal > 9000)
UNION ALL SELECT 3, TIMESTAMP '2024-03-01 03:00:00', 'DELETE', 'strata',
       (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0)
""")
def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).history()


@query("version_count_compare", VERSIONS_SQL + """
SELECT 'Current' AS label, COUNT(*) AS row_count FROM v3
UNION ALL SELECT 'Version 0', COUNT(*) FROM v0
""")
def q_version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = build_customer_log(spark, sf_dir)
    cur = log.snapshot().agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("Current").alias("label"), "row_count")
    v0 = log.snapshot(0).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("Version 0").alias("label"), "row_count")
    return cur.union(v0)


@query("version_diff", VERSIONS_SQL + """
SELECT COALESCE(a.c_custkey, b.c_custkey) AS c_custkey,
  a.c_name AS old_c_name, a.c_nationkey AS old_c_nationkey, a.c_acctbal AS old_c_acctbal,
  a.c_mktsegment AS old_c_mktsegment,
  b.c_name AS new_c_name, b.c_nationkey AS new_c_nationkey, b.c_acctbal AS new_c_acctbal,
  b.c_mktsegment AS new_c_mktsegment,
  CASE WHEN a.c_custkey IS NULL THEN 'added' WHEN b.c_custkey IS NULL THEN 'removed'
       ELSE 'changed' END AS change
FROM v0 a FULL OUTER JOIN v3 b ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL
   OR a.c_name IS DISTINCT FROM b.c_name OR a.c_nationkey IS DISTINCT FROM b.c_nationkey
   OR a.c_acctbal IS DISTINCT FROM b.c_acctbal OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment
""")
def q_version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).diff(0, 3)


@query("change_feed", VERSIONS_SQL + """
SELECT 'update_preimage' AS _change_type, 2 AS _commit_version,
       TIMESTAMP '2024-03-01 02:00:00' AS _commit_timestamp, * FROM v1 WHERE c_acctbal > 9000
UNION ALL
SELECT 'update_postimage', 2, TIMESTAMP '2024-03-01 02:00:00', * FROM v2 WHERE c_acctbal > 9000
UNION ALL
SELECT 'delete', 3, TIMESTAMP '2024-03-01 03:00:00', * FROM v2 WHERE c_acctbal < 0
""")
def q_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_customer_log(spark, sf_dir).changes(1, 3)


@query("restore_deleted", VERSIONS_SQL + """
SELECT * FROM v2 WHERE c_acctbal < 0
""")
def q_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = build_customer_log(spark, sf_dir)
    restored, _ = log.restore_rows(2)
    return restored


@query("merge_upsert", """
WITH src AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 3
  UNION ALL
  SELECT -c_custkey - 1, c_name || ' (new)', c_nationkey, c_acctbal, c_mktsegment
  FROM customer WHERE c_nationkey = 4)
SELECT * FROM src
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM src)
""")
def q_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge a batch of changed (nation 3: balance + 100) and new (nation 4,
    re-keyed) customers into the table."""
    cust = read_table(spark, sf_dir, "customer").select(*COLUMNS)
    log = ChangeLog(spark, scratch_path(spark, "merge-log"), ["c_custkey"], commit_clock)
    log.create(cust)
    src = (cust.filter(F.col("c_nationkey") == 3)
           .withColumn("c_acctbal", F.col("c_acctbal") + 100)
           .unionByName(cust.filter(F.col("c_nationkey") == 4).select(
               (-F.col("c_custkey") - 1).alias("c_custkey"),
               F.concat("c_name", F.lit(" (new)")).alias("c_name"),
               "c_nationkey", "c_acctbal", "c_mktsegment")))
    log.merge(src)
    return ChangeLog(spark, log.path, ["c_custkey"]).snapshot()


@query("history_non_writes", """
SELECT 0 AS version, 'CREATE TABLE AS SELECT' AS operation
UNION ALL SELECT 2, 'UPDATE' FROM customer HAVING COUNT(*) FILTER (WHERE c_acctbal > 9000) > 0
UNION ALL SELECT 3, 'DELETE' FROM customer HAVING COUNT(*) FILTER (WHERE c_acctbal < 0) > 0
""")
def q_history_non_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter over the history as a subquery, read by a second instance."""
    path = build_customer_log(spark, sf_dir).path
    return ChangeLog(spark, path, ["c_custkey"]).history().filter("operation <> 'WRITE'").select(
        "version", "operation")


@query("empty_dml_commits", VERSIONS_SQL + """
SELECT step, 3 AS version, (SELECT COUNT(*) FROM v3) AS n_rows
FROM (VALUES ('before'), ('update'), ('delete'), ('insert'), ('restore')) x(step)
""")
def q_empty_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements that change no row leave no version."""
    log = build_customer_log(spark, sf_dir)
    none = read_table(spark, sf_dir, "customer").select(*COLUMNS).where("false")
    steps = [("before", lambda: None), ("update", lambda: log.update("c_custkey < 0", {"c_name": "'x'"})),
             ("delete", lambda: log.delete("c_custkey < 0")), ("insert", lambda: log.insert(none)),
             ("restore", lambda: log.restore_rows(log.latest_version()))]
    out = None
    for name, run in steps:
        run()
        one = log.snapshot().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("step"), F.lit(log.latest_version()).alias("version"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- views

_VIEW_STEP = """
SELECT {v} AS version, c_mktsegment, COUNT(*) AS n_rows, COUNT(balance) AS n_balance,
       CAST(SUM(balance) AS DOUBLE) AS sum_balance, CAST(MIN(balance) AS DOUBLE) AS min_balance,
       CAST(MAX(balance) AS DOUBLE) AS max_balance, CAST(SUM(balance) AS DOUBLE) / COUNT(balance) AS avg_balance
FROM (SELECT *, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM {t} WHERE c_nationkey < 20)
GROUP BY c_mktsegment"""

VIEW_STEPS_SQL = VERSIONS_SQL.rstrip() + """,
v4 AS (SELECT * FROM v3 WHERE NOT (c_custkey IN (
         SELECT c_custkey FROM v3 QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1))),
v5 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM v4)
"""


@query("materialized_view_incremental", VIEW_STEPS_SQL + " UNION ALL ".join(
    _VIEW_STEP.format(v=v, t=f"v{v}") for v in range(6)))
def q_materialized_view_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate view refreshed from the change feed after every commit:
    inserts, updates that move rows between groups, deletes, deletes of every
    group's greatest row, and updates to NULL; equal to the recomputed view."""
    cust = read_table(spark, sf_dir, "customer").select(*COLUMNS)
    log = ChangeLog(spark, scratch_path(spark, "view-log"), ["c_custkey"], commit_clock)
    view = AggregateView(log, scratch_path(spark, "aggregate-view"), ["c_mktsegment"],
                         {"balance": "CAST(c_acctbal AS DECIMAL(18,2))"}, "c_nationkey < 20")
    best = lambda: (log.snapshot().groupBy("c_mktsegment").agg(
        F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("c_custkey")).select("c_custkey"))
    steps = [
        lambda: log.create(cust.filter(F.col("c_mktsegment") != "MACHINERY")),
        lambda: log.insert(cust.filter(F.col("c_mktsegment") == "MACHINERY")),
        lambda: log.update("c_acctbal > 9000", {"c_mktsegment": "concat('SENIOR ', c_mktsegment)"}),
        lambda: log.delete("c_acctbal < 0"),
        lambda: log.delete_keys(best()),
        lambda: log.update("c_custkey % 7 = 0", {"c_acctbal": F.lit(None).cast("double")}),
    ]
    seen = []
    for v, step in enumerate(steps):
        step()
        view.refresh()
        stored = materialize(view.read(), scratch_path(spark, "view-step"))
        seen.append(stored.select(F.lit(v).alias("version"), "c_mktsegment", "n_rows", "n_balance", *[
            F.col(f"{x}_balance").cast("double").alias(f"{x}_balance") for x in ("sum", "min", "max", "avg")]))
    out = seen[0]
    for df in seen[1:]:
        out = out.unionByName(df)
    return out
