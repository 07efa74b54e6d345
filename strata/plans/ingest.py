"""Ingestion queries: idempotent loads, schema evolution, rescued values, plain
readers, tables made by queries, clustered files."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.layout import files_for, write_clustered
from strata.sinks.tables import (create_table_as_select, drop_table, export_landing, materialize,
                                 read_table_if_exists)
from strata.sources.readers import RESCUED, read_csv, read_tsv
from strata.sources.tables import read_table
from strata.streaming.ingest import (age_files, copy_into, load_with_schema_evolution,
                                     read_loaded)

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


@query("incremental_load_counts", """
SELECT 'load_1' AS step, COUNT(*) FILTER (WHERE c_nationkey < 12) AS rows_loaded,
       COUNT(*) FILTER (WHERE c_nationkey < 12) AS table_rows FROM customer
UNION ALL
SELECT 'rerun', CAST(0 AS BIGINT), COUNT(*) FILTER (WHERE c_nationkey < 12) FROM customer
UNION ALL
SELECT 'load_2', COUNT(*) FILTER (WHERE c_nationkey >= 12), COUNT(*) FROM customer
""")
def q_incremental_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV drops of ``customer`` (split by nation), loaded, re-run, loaded;
    the second drop carries month-old file dates."""
    root = scratch_path(spark, "copy-into")
    cust = read_table(spark, sf_dir, "customer")
    landing, target, ckpt = f"{root}/landing", f"{root}/table", f"{root}/_checkpoint"
    steps = []

    def load(step):
        res = copy_into(spark, f"{landing}/*", target, ckpt, "csv", CUSTOMER_SCHEMA,
                        {"header": True})
        steps.append((step, res.rows_loaded, read_loaded(spark, target).count()))

    export_landing(cust.filter(F.col("c_nationkey") < 12), f"{landing}/drop1", "csv", header=True)
    load("load_1")
    load("rerun")
    export_landing(cust.filter(F.col("c_nationkey") >= 12), f"{landing}/drop2", "csv", header=True)
    age_files(spark, f"{landing}/drop2", 30)
    load("load_2")
    return spark.createDataFrame(steps, "step string, rows_loaded bigint, table_rows bigint")


@query("schema_evolution_load", """
SELECT event_id, event_type,
       CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_id % 50 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN props END AS props,
       CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_id % 50 = 0
            THEN '{"value":"v' || CAST(event_id AS VARCHAR) || '"}' END AS rescued
FROM events
""")
def q_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop 1 without ``props``; drop 2 adds it and the load widens the schema
    (``addNewColumns``); drop 3, with old file dates, holds text in ``value``,
    which is rescued."""
    root = scratch_path(spark, "evolve")
    ev = read_table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    odd = F.col("event_id") % 50 == 0
    landing, target, state = f"{root}/landing", f"{root}/table", f"{root}/_state"

    def load():
        load_with_schema_evolution(spark, f"{landing}/*", target, state, glob="*.json")

    export_landing(ev.filter(~late).select("event_id", "event_type", "value"), f"{landing}/d1")
    load()
    export_landing(ev.filter(late & ~odd).select("event_id", "event_type", "value", "props"), f"{landing}/d2")
    load()
    text = F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("value")
    export_landing(ev.filter(late & odd).select("event_id", "event_type", text, "props"), f"{landing}/d3")
    age_files(spark, f"{landing}/d3", 45)
    load()
    return read_loaded(spark, target).select("event_id", "event_type", "value", "props",
                                             F.to_json(RESCUED).alias("rescued"))


# Fault recipe for the CSV drops: unparsable balances and nation keys; odd keys
# come in a second file with another column order and a surplus column.
@query("rescued_rows", """
SELECT c_custkey, c_name,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  c_mktsegment,
  CASE WHEN c_custkey % 37 = 0 OR c_custkey % 41 = 0 OR c_custkey % 2 = 1 THEN '{' || concat_ws(',',
    CASE WHEN c_custkey % 2 = 1 THEN '"extra":"x' || CAST(c_custkey AS VARCHAR) || '"' END,
    CASE WHEN c_custkey % 41 = 0 THEN '"c_nationkey":"n' || CAST(c_nationkey AS VARCHAR) || '"' END,
    CASE WHEN c_custkey % 37 = 0 THEN '"c_acctbal":"$' || CAST(c_custkey AS VARCHAR) || '"' END) || '}'
  END AS rescued,
  NOT (c_custkey % 37 = 0 OR c_custkey % 41 = 0) AS type_valid
FROM customer
""")
def q_rescued_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two files loaded together through the incremental load."""
    root = scratch_path(spark, "rescue")
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    faulty = c.select(
        key, "c_name",
        F.when(key % 41 == 0, F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
         .otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.when(key % 37 == 0, F.concat(F.lit("$"), key.cast("string")))
         .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment", F.concat(F.lit("x"), key.cast("string")).alias("extra"))
    export_landing(faulty.filter(key % 2 == 0).drop("extra"), f"{root}/landing/a", "csv", header=True)
    export_landing(faulty.filter(key % 2 == 1).select(
        "c_name", "c_custkey", "extra", "c_nationkey", "c_acctbal", "c_mktsegment"),
        f"{root}/landing/b", "csv", header=True)
    copy_into(spark, f"{root}/landing/*", f"{root}/table", f"{root}/_checkpoint", "csv", CUSTOMER_SCHEMA)
    bad = F.coalesce(F.map_contains_key(RESCUED, "c_nationkey") | F.map_contains_key(RESCUED, "c_acctbal"),
                     F.lit(False))
    return read_loaded(spark, f"{root}/table").select(
        *CUSTOMER_SCHEMA.fieldNames(), F.to_json(RESCUED).alias("rescued"), (~bad).alias("type_valid"))


@query("quoted_rows", """
SELECT c_custkey, c_name || chr(10) || 'says "hi", twice' || chr(10) || CASE WHEN c_custkey % 3 = 0 THEN chr(10) || ',' ELSE '' END
         AS c_name,
       CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 41 = 0 THEN '{"c_nationkey":"n' || chr(92) || 'n' || CAST(c_nationkey AS VARCHAR) || '"}' END AS rescued
FROM customer
""")
def q_quoted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV fields with line breaks, quotes and separators, among them one that
    does not fit its type, through the incremental load."""
    root = scratch_path(spark, "quoted")
    key = F.col("c_custkey")
    name = F.concat("c_name", F.lit('\nsays "hi", twice\n'), F.when(key % 3 == 0, "\n,").otherwise(""))
    nation = F.when(key % 41 == 0, F.concat(F.lit("n\n"), F.col("c_nationkey").cast("string"))).otherwise(
        F.col("c_nationkey").cast("string"))
    faulty = read_table(spark, sf_dir, "customer").select(
        key, name.alias("c_name"), nation.alias("c_nationkey"), "c_acctbal", "c_mktsegment")
    export_landing(faulty, f"{root}/landing", "csv", header=True, escape='"', ignoreTrailingWhiteSpace=False)
    copy_into(spark, f"{root}/landing", f"{root}/table", f"{root}/_checkpoint", "csv", CUSTOMER_SCHEMA, {"multiLine": True})
    return read_loaded(spark, f"{root}/table").select(
        *CUSTOMER_SCHEMA.fieldNames(), F.to_json(RESCUED).alias("rescued"))


@query("inferred_load", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, TRUE AS typed FROM customer
""")
def q_inferred_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without a schema: types come from all rows of the first batch."""
    root = scratch_path(spark, "infer")
    cust = read_table(spark, sf_dir, "customer")
    export_landing(cust.select(*CUSTOMER_SCHEMA.fieldNames()), f"{root}/landing", "csv", header=True)
    copy_into(spark, f"{root}/landing", f"{root}/table", f"{root}/_checkpoint", "csv")
    out = read_loaded(spark, f"{root}/table")
    typed = dict(out.dtypes)
    ok = [typed[c] for c in CUSTOMER_SCHEMA.fieldNames()] == ["bigint", "string", "bigint", "double", "string"]
    return out.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal",
                      "c_mktsegment", F.lit(ok).alias("typed"))


# ---------------------------------------------------------------- plain readers

@query("csv_inferred_read", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, TRUE AS typed FROM customer")
def q_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a header and inferred types."""
    root = scratch_path(spark, "csv")
    export_landing(read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
                   root, "csv", header=True)
    df = read_csv(spark, root)
    typed = [t for _, t in df.dtypes][1:] == ["string", "int", "double"]
    return df.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
                     F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", F.lit(typed).alias("typed"))


@query("tsv_untyped_preview", """
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, c_mktsegment AS _c2 FROM customer
""")
def q_tsv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A headerless tab-separated file without a schema: every column is text."""
    root = scratch_path(spark, "tsv")
    export_landing(read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), root, "csv", sep="\t")
    return read_tsv(spark, root)


@query("ctas_and_probe", """
SELECT 'absent' AS step, CAST(NULL AS VARCHAR) AS c_mktsegment, CAST(NULL AS BIGINT) AS customers
UNION ALL SELECT 'created', c_mktsegment, COUNT(*) FROM customer WHERE c_nationkey < 12 GROUP BY 2
UNION ALL SELECT 'kept', c_mktsegment, COUNT(*) FROM customer WHERE c_nationkey < 12 GROUP BY 2
UNION ALL SELECT 'failed', c_mktsegment, COUNT(*) FROM customer WHERE c_nationkey < 12 GROUP BY 2
UNION ALL SELECT 'replaced', c_mktsegment, COUNT(*) FROM customer GROUP BY 2
""")
def q_ctas_and_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probe for an absent table; CREATE TABLE AS SELECT, which skips a table
    that is there; a replacement that fails and leaves it; one that succeeds."""
    name, cust = f"segments_{uuid.uuid4().hex[:8]}", read_table(spark, sf_dir, "customer")
    per = lambda df: df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    root, steps = scratch_path(spark, "ctas"), []

    def seen(step):
        df = read_table_if_exists(spark, name)
        df = spark.range(1).select(F.lit(None).cast("string").alias("c_mktsegment"),
                                   F.lit(None).cast("bigint").alias("customers")) if df is None else df
        steps.append(materialize(df.select(F.lit(step).alias("step"), "c_mktsegment", "customers"), f"{root}/{step}"))

    seen("absent")
    create_table_as_select(spark, name, per(cust.where("c_nationkey < 12")))
    seen("created")
    create_table_as_select(spark, name, per(cust))
    seen("kept")
    try:
        create_table_as_select(spark, name, per(cust).withColumn("customers", F.raise_error(F.lit("no")).cast("bigint")), replace=True)
        raise AssertionError("the replacement must fail")
    except PySparkException:
        seen("failed")
    create_table_as_select(spark, name, per(cust), replace=True)
    seen("replaced")
    drop_table(spark, name)
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


@query("clustered_scan", """
SELECT 'part' AS filter, COUNT(*) AS lines, TRUE AS few_files FROM lineitem WHERE l_partkey BETWEEN 20 AND 40
UNION ALL
SELECT 'price', COUNT(*), TRUE FROM lineitem WHERE l_extendedprice BETWEEN 30000 AND 32000
""")
def q_clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines clustered on two columns: a narrow filter on either one finds its
    rows in at most half of the files."""
    path, cols = scratch_path(spark, "clustered"), ["l_partkey", "l_extendedprice"]
    write_clustered(read_table(spark, sf_dir, "lineitem"), path, cols, 64)
    out = None
    for name, c, lo, hi in (("part", "l_partkey", 20, 40), ("price", "l_extendedprice", 30_000, 32_000)):
        read, files = files_for(spark.read.parquet(path), f"max_{c} >= {lo} AND min_{c} <= {hi}", cols)
        one = spark.read.parquet(path).where(F.col(c).between(lo, hi)).agg(F.count(F.lit(1)).alias("lines")).select(
            F.lit(name).alias("filter"), "lines", F.lit(read * 2 <= files).alias("few_files"))
        out = one if out is None else out.unionByName(one)
    return out
