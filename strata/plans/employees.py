"""Employee medallion, imperative style: CSV drops -> idempotent load into a
fixed-schema Bronze -> Silver replaced from a query (upper-case role, audit
columns) -> Gold refreshed with INSERT OVERWRITE into a table whose INT column
definition is kept.

Employees are derived from ``customer`` joined to ``nation`` (ID = customer
key, FirstName = name, Country = nation, Role = market segment as received).
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.rules import apply_rules, expect_or_fail
from strata.plans.events import CHECK_CLOCK_SQL, check_clock
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import create_empty_table, export_landing, insert_overwrite, publish, read_current
from strata.sources.tables import read_table
from strata.streaming.ingest import copy_into, read_loaded

EMPLOYEE_SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("FirstName", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Role", T.StringType()),
])
GOLD_DDL = "Role STRING, TotalEmployees INT"


def employees_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded
    n = F.broadcast(nation.select("n_nationkey", "n_name"))
    return customer.join(n, customer.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("FirstName"),
        F.col("n_name").alias("Country"),
        F.lower("c_mktsegment").alias("Role"))


def employee_silver(bronze: DataFrame, clock: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if clock is None else clock
    return bronze.select("ID", "FirstName", "Country", F.upper("Role").alias("Role"),
                         now.alias("processed_timestamp"), F.to_date(now).alias("processed_date"))


def roles_view(silver: DataFrame) -> DataFrame:
    return silver.groupBy("Role").agg(F.count(F.lit(1)).alias("TotalEmployees"))


def employee_job(spark: SparkSession, landing: str, root: str,
                 clock: Column | None = None) -> dict:
    """Task 1: load new CSV drops into Bronze (idempotent). Task 2: replace
    Silver from a query, then refresh Gold through a temp view with INSERT
    OVERWRITE into its fixed-schema table. Returns the table handles and the
    number of rows task 1 loaded."""
    bronze_path = f"{root}/bronze"
    loaded = copy_into(spark, landing, bronze_path, f"{root}/_checkpoint", "csv",
                       EMPLOYEE_SCHEMA, {"header": True})
    bronze = read_loaded(spark, bronze_path)
    silver_path = f"{root}/silver"
    silver = publish(employee_silver(bronze, clock), silver_path)
    view = f"gold_roles_v_{uuid.uuid4().hex[:8]}"
    roles_view(silver).createOrReplaceTempView(view)
    gold = f"gold_roles_{uuid.uuid4().hex[:8]}"
    create_empty_table(spark, gold, GOLD_DDL, location=f"{root}/gold")
    insert_overwrite(spark, gold, spark.table(view))
    return {"bronze": bronze, "silver": silver, "gold": spark.table(gold), "gold_name": gold,
            "rows_loaded": loaded.rows_loaded}


def run_employee_job(spark: SparkSession, sf_dir: str, clock: Column | None = None) -> dict:
    """The job on employees derived from the test tables."""
    root = scratch_path(spark, "employees")
    emp = employees_from_customers(read_table(spark, sf_dir, "customer"),
                                   read_table(spark, sf_dir, "nation"))
    export_landing(emp, f"{root}/landing", "csv", header=True)
    return employee_job(spark, f"{root}/landing", root, clock)


_EMP_SQL = """
WITH employees AS (
  SELECT c.c_custkey AS ID, c.c_name AS FirstName, n.n_name AS Country,
         lower(c.c_mktsegment) AS Role
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""


@query("employee_silver", _EMP_SQL + f"""
SELECT ID, FirstName, Country, upper(Role) AS Role,
       {CHECK_CLOCK_SQL} AS processed_timestamp, CAST({CHECK_CLOCK_SQL} AS DATE) AS processed_date
FROM employees
""")
def q_employee_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_employee_job(spark, sf_dir, check_clock())["silver"]


@query("roles_gold", _EMP_SQL + """
SELECT upper(Role) AS Role, CAST(COUNT(*) AS INTEGER) AS TotalEmployees FROM employees GROUP BY 1
""")
def q_roles_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_employee_job(spark, sf_dir, check_clock())["gold"]


@query("materialized_view_refresh", """
SELECT 'first' AS step, c_mktsegment, COUNT(*) AS customers FROM customer WHERE c_nationkey < 12 GROUP BY 2
UNION ALL SELECT 'after_failure', c_mktsegment, COUNT(*) FROM customer WHERE c_nationkey < 12 GROUP BY 2
UNION ALL SELECT 'refreshed', c_mktsegment, COUNT(*) FROM customer GROUP BY 2
""")
def q_materialized_view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored view is recomputed and swapped as a whole; a refresh that
    breaks a fail rule leaves the old contents."""
    path = scratch_path(spark, "view")
    cust = read_table(spark, sf_dir, "customer")
    per = lambda df: df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    seen = lambda step, df: df.select(F.lit(step).alias("step"), "c_mktsegment", "customers")
    out = seen("first", publish(per(cust.filter("c_nationkey < 12")), path))
    try:
        publish(apply_rules(per(cust), [expect_or_fail("none", "customers < 0")], dataset="view"), path)
        raise AssertionError("the rule must fail the refresh")
    except PySparkException:
        out = out.union(seen("after_failure", read_current(spark, path)))
    return out.union(seen("refreshed", publish(per(cust), path)))
