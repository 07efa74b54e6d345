"""The same datasets written with the SQL API (temporary views, DDL, CTAS,
INSERT OVERWRITE): the Python and SQL forms must agree row for row."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.plans import employees as emp
from strata.plans import events as ev
from strata.plans import songs
from strata.plans.registry import ORACLE_SQL, query
from strata.session import scratch_path
from strata.sinks.tables import export_landing
from strata.sources.tables import read_table


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


@query("top_artists_by_year_sql", ORACLE_SQL["top_artists_by_year"])
def q_top_artists_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _name("songs_prepared")
    songs.songs_prepared(songs.songs_raw(spark, songs.land_songs(spark, sf_dir))) \
        .createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT artist_name, year, COUNT(*) AS total_number_of_songs
        FROM {view}
        WHERE year > 0
        GROUP BY artist_name, year
        ORDER BY total_number_of_songs DESC, year DESC, artist_name""")


@query("gold_daily_event_metrics_sql", ORACLE_SQL["gold_daily_event_metrics"])
def q_gold_daily_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _name("silver_events")
    _, _, silver = ev.pipeline(spark, sf_dir, ev.check_clock(), materialize_silver=True)
    silver.createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH users AS (
          SELECT event_date, event_type, is_weekend, COUNT(user_id) AS unique_users
          FROM (SELECT DISTINCT event_date, event_type, is_weekend, user_id FROM {view})
          GROUP BY event_date, event_type, is_weekend),
        v AS (SELECT *, IF(CAST(TRY_CAST(event_value AS DECIMAL(38,12)) AS DOUBLE) = event_value,
                           TRY_CAST(event_value AS DECIMAL(38,12)), NULL) AS exact FROM {view}),
        s AS (
          SELECT event_date, event_type, is_weekend,
                 COUNT(*) AS event_count, COUNT(event_value) AS n_values,
                 COALESCE(IF(COUNT(exact) = COUNT(event_value), CAST(try_sum(exact) AS DOUBLE), NULL),
                          SUM(event_value)) AS total_value,
                 percentile_approx(event_value, 0.95) AS p95_value
          FROM v GROUP BY event_date, event_type, is_weekend),
        m AS (SELECT *, try_divide(total_value, n_values) AS avg_value FROM s)
        SELECT m.event_date, m.event_type, m.is_weekend, m.event_count,
               COALESCE(u.unique_users, 0) AS unique_users, m.total_value, m.avg_value,
               m.p95_value, TIMESTAMP_NTZ '2024-02-01 00:00:00' AS updated_at
        FROM m LEFT JOIN users u
          ON m.event_date <=> u.event_date AND m.event_type <=> u.event_type
         AND m.is_weekend <=> u.is_weekend""")


@query("roles_gold_sql", ORACLE_SQL["roles_gold"])
def q_roles_gold_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze/Silver/Gold in SQL: a typed CSV view over the landing folder,
    CTAS for Silver, a fixed-schema Gold table, a temp view for the Gold
    logic and INSERT OVERWRITE to refresh it."""
    root = scratch_path(spark, "employees-sql")
    employees = emp.employees_from_customers(read_table(spark, sf_dir, "customer"),
                                             read_table(spark, sf_dir, "nation"))
    export_landing(employees, f"{root}/landing", "csv", header=True)
    landing, silver, gold, gold_v = (_name("emp_landing"), _name("emp_silver"),
                                     _name("gold_roles"), _name("gold_roles_v"))
    spark.sql(f"""CREATE TEMPORARY VIEW {landing} (ID BIGINT, FirstName STRING, Country STRING,
                  Role STRING) USING csv OPTIONS (path '{root}/landing', header 'true')""")
    spark.sql(f"""CREATE TABLE {silver} USING parquet LOCATION '{root}/silver' AS
                  SELECT ID, FirstName, Country, UPPER(Role) AS Role,
                         TIMESTAMP_NTZ '2024-02-01 00:00:00' AS processed_timestamp,
                         DATE '2024-02-01' AS processed_date
                  FROM {landing}""")
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {gold} (Role STRING, TotalEmployees INT)
                  USING parquet LOCATION '{root}/gold'""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {gold_v} AS
                  SELECT Role, COUNT(*) AS TotalEmployees FROM {silver} GROUP BY Role""")
    spark.sql(f"INSERT OVERWRITE {gold} SELECT Role, TotalEmployees FROM {gold_v}")
    return spark.table(gold)
