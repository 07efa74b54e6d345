"""Cleaning, validation and data-quality query keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clean import (age_in_years, cast_columns, clean_text, fill_defaults,
                                    standardise_column_names)
from strata.functions.events import ip_rule_sql
from strata.operators.dedup import distinct_rows
from strata.operators.quality import (duplicate_keys, json_field_drift, nested_drift, null_profile,
                                      orphan_summary, quarantine, reconcile_counts)
from strata.operators.rules import Rule
from strata.plans.events import IP_OK_SQL
from strata.plans.registry import query
from strata.sources.tables import DIRTY_EVENTS_SQL, dirty_events, read_table


# ------------------------------------------------------------------ cleaning

def messy_customers(customer: DataFrame) -> DataFrame:
    """Customers as a careless export delivers them: spaced/mixed-case
    headers, text-typed numbers, padded or missing names, lower-case
    segments, and every 13th key exported twice."""
    k = F.col("c_custkey")
    copies = customer.select(
        "*", F.explode(F.when(k % 13 == 0, F.array(F.lit(0), F.lit(1)))
                       .otherwise(F.array(F.lit(0)))).alias("_copy"))
    return copies.select(
        k.alias("Cust Key"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(k % 6 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
         .otherwise(F.col("c_name")).alias("Customer Name"),
        F.col("c_nationkey").cast("string").alias("Nation-Key"),
        F.col("c_acctbal").cast("string").alias("AcctBal"),
        F.when(k % 5 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
         .alias("Mkt Segment"))


def clean_customers(raw: DataFrame) -> DataFrame:
    df = standardise_column_names(raw)
    df = cast_columns(df, {"nation_key": "int", "acct_bal": "double"})
    df = df.withColumns({"customer_name": clean_text(F.col("customer_name")),
                         "mkt_segment": clean_text(F.col("mkt_segment"), "upper")})
    df = fill_defaults(df, {"customer_name": "Unknown"})
    df = df.withColumn("acct_bal_valid", F.col("acct_bal") >= 0)
    return distinct_rows(df)


_MESSY_SQL = """
WITH copies AS (
  SELECT c.*, x.cp FROM customer c
  JOIN (SELECT 0 AS cp UNION ALL SELECT 1) x ON x.cp = 0 OR c.c_custkey % 13 = 0),
messy AS (
  SELECT c_custkey AS cust_key,
    CASE WHEN c_custkey % 17 = 0 THEN NULL
         WHEN c_custkey % 6 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS customer_name,
    c_nationkey AS nation_key, c_acctbal AS acct_bal,
    CASE WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS mkt_segment
  FROM copies)
"""


@query("clean_customers", _MESSY_SQL + """
SELECT DISTINCT cust_key,
  COALESCE(regexp_replace(trim(customer_name), '\\s+', ' ', 'g'), 'Unknown') AS customer_name,
  nation_key, acct_bal,
  upper(regexp_replace(trim(mkt_segment), '\\s+', ' ', 'g')) AS mkt_segment,
  acct_bal >= 0 AS acct_bal_valid
FROM messy
""")
def q_clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_customers(messy_customers(read_table(spark, sf_dir, "customer")))


AS_OF_DATE = "2024-06-15"


def customers_with_dob(customer: DataFrame) -> DataFrame:
    """A date of birth spread over 1940-2008, derived from the key."""
    days = ((F.col("c_custkey") * 7919) % 25000).cast("int")
    return customer.select("c_custkey", F.date_add(F.lit("1940-01-01").cast("date"), days)
                           .alias("dob"))


@query("age_from_dob", f"""
WITH d AS (SELECT c_custkey,
                  DATE '1940-01-01' + CAST((c_custkey * 7919) % 25000 AS INTEGER) AS dob
           FROM customer)
SELECT c_custkey, dob,
  CAST(date_diff('year', dob, DATE '{AS_OF_DATE}')
       - CASE WHEN month(DATE '{AS_OF_DATE}') * 100 + day(DATE '{AS_OF_DATE}')
                   < month(dob) * 100 + day(dob) THEN 1 ELSE 0 END AS INTEGER) AS age
FROM d
""")
def q_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = customers_with_dob(read_table(spark, sf_dir, "customer"))
    return d.withColumn("age", age_in_years(F.col("dob"), F.lit(AS_OF_DATE).cast("date")))


def fx_rates(nation: DataFrame) -> DataFrame:
    """One currency per nation, rate = 1 + nationkey/100 (exact decimal)."""
    return nation.select(
        "n_nationkey",
        F.concat(F.lit("CUR"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("currency"),
        (F.lit(1) + F.col("n_nationkey") * F.lit(0.01).cast("decimal(3,2)"))
        .cast("decimal(10,4)").alias("rate"))


def convert_currency(orders: DataFrame, customer: DataFrame, rates: DataFrame) -> DataFrame:
    """Order amounts in the customer's currency; the planner broadcasts
    the caller's rate table when it is small. Money stays decimal until the
    final rounding."""
    c = customer.select("c_custkey", "c_nationkey")
    j = (orders.select("o_orderkey", "o_custkey", "o_totalprice")
         .join(c, orders.o_custkey == c.c_custkey)
         .join(rates, F.col("c_nationkey") == rates.n_nationkey))
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return j.select("o_orderkey", "currency", F.col("rate").cast("double").alias("rate"),
                    F.col("o_totalprice").alias("amount"),
                    F.round(amount * F.col("rate"), 2).cast("double").alias("amount_converted"))


@query("currency_convert", """
WITH r AS (SELECT n_nationkey, 'CUR' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS currency,
                  CAST(1 + n_nationkey * 0.01 AS DECIMAL(10,4)) AS rate FROM nation)
SELECT o.o_orderkey, r.currency, CAST(r.rate AS DOUBLE) AS rate, o.o_totalprice AS amount,
       CAST(ROUND(CAST(o.o_totalprice AS DECIMAL(18,2)) * r.rate, 2) AS DOUBLE) AS amount_converted
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN r ON c.c_nationkey = r.n_nationkey
""")
def q_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_currency(read_table(spark, sf_dir, "orders"),
                            read_table(spark, sf_dir, "customer"),
                            fx_rates(read_table(spark, sf_dir, "nation")))


# ------------------------------------------------------------------ checks

_DIRTY_COLS = ["event_id", "user_id", "event_type", "event_value", "event_timestamp",
               "source_ip", "copy_no"]


@query("null_profile", f"WITH {DIRTY_EVENTS_SQL.strip()}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count, "
    f"COUNT(*) AS row_count FROM dirty_events" for c in _DIRTY_COLS))
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(dirty_events(spark, sf_dir), _DIRTY_COLS)


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS dup_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("row_reconcile", """
WITH s AS (SELECT COUNT(*) AS source_rows FROM lineitem),
t AS (SELECT COUNT(*) AS target_rows FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT source_rows, target_rows, source_rows - target_rows AS difference,
       source_rows = target_rows AS reconciled FROM s, t
""")
def q_row_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lineitem vs the loaded target (lineitem joined to its orders)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return reconcile_counts(li, li.join(o, "l_orderkey"))


_RI = [  # (relationship, child, child key, parent, parent key)
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
    ("orders.o_orderkey<-lineitem", "orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@query("ri_orphans", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS relationship, (SELECT COUNT(*) FROM {ch}) AS child_rows, "
    f"(SELECT COUNT(*) FROM {ch} x WHERE x.{ck} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {pa} y WHERE y.{pk} = x.{ck})) AS orphan_rows"
    for name, ch, ck, pa, pk in _RI))
def q_ri_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referential integrity per foreign key; the last line checks the
    reverse direction (orders that have no line items)."""
    out = None
    for name, ch, ck, pa, pk in _RI:
        part = orphan_summary(name, read_table(spark, sf_dir, ch).select(ck),
                              read_table(spark, sf_dir, pa).select(pk), [ck], [pk])
        out = part if out is None else out.unionByName(part)
    return out


QUARANTINE_RULES = [
    Rule("missing_event_id", "event_id IS NOT NULL", "drop"),
    Rule("missing_user_id", "user_id IS NOT NULL", "drop"),
    Rule("missing_timestamp", "event_timestamp IS NOT NULL", "drop"),
    Rule("non_positive_value", "event_value > 0", "drop"),
    Rule("bad_ip", ip_rule_sql(), "drop"),
]


@query("quarantine_split", f"WITH {DIRTY_EVENTS_SQL.strip()}" + f"""
, r AS (SELECT event_id, copy_no, user_id,
  concat_ws(',',
    CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN user_id IS NULL THEN 'missing_user_id' END,
    CASE WHEN event_timestamp IS NULL THEN 'missing_timestamp' END,
    CASE WHEN NOT COALESCE(event_value > 0, FALSE) THEN 'non_positive_value' END,
    CASE WHEN NOT COALESCE({IP_OK_SQL}, FALSE) THEN 'bad_ip' END) AS reasons
  FROM dirty_events)
SELECT event_id, copy_no, user_id, reasons,
       CASE WHEN reasons = '' THEN 'valid' ELSE 'quarantined' END AS status
FROM r
""")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quarantine(dirty_events(spark, sf_dir), QUARANTINE_RULES)
    return q.select("event_id", "copy_no", "user_id",
                    F.array_join("_reasons", ",").alias("reasons"),
                    F.col("_status").alias("status"))


EXPECTED_PROPS_FIELDS = ["k", "source"]


@query("schema_drift", """
WITH seen AS (SELECT f AS field, COUNT(*) AS rows_present
              FROM (SELECT unnest(json_keys(props)) AS f FROM events) GROUP BY f),
exp AS (SELECT * FROM (VALUES ('k'), ('source')) t(field))
SELECT COALESCE(s.field, e.field) AS field, COALESCE(s.rows_present, 0) AS rows_present,
       CASE WHEN e.field IS NULL THEN 'unexpected' WHEN s.field IS NULL THEN 'missing'
            ELSE 'ok' END AS status
FROM seen s FULL OUTER JOIN exp e ON s.field = e.field
""")
def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of the semi-structured ``props`` payload against its contract."""
    return json_field_drift(read_table(spark, sf_dir, "events"), "props", EXPECTED_PROPS_FIELDS)


# Nested variants of the events' JSON column: a plain object, one with an object
# and an array of mixed kinds, one whose field has another kind.
_NESTED_SQL = """
WITH e AS (SELECT event_id % 4 AS v, COUNT(*) AS n FROM events GROUP BY 1),
c AS (SELECT coalesce(sum(n) FILTER (v = 0), 0) AS a, coalesce(sum(n) FILTER (v = 1), 0) AS b,
             coalesce(sum(n) FILTER (v = 2), 0) AS c, coalesce(sum(n) FILTER (v = 3), 0) AS d FROM e)
SELECT path, kind, CAST(nodes AS BIGINT) AS nodes, status FROM (
  SELECT '$' AS path, 'object' AS kind, a + b + c AS nodes, 'ok' AS status FROM c
  UNION ALL SELECT '$', 'unparsable', d, 'type_mismatch' FROM c
  UNION ALL SELECT '$.k', 'bigint', a + b, 'ok' FROM c
  UNION ALL SELECT '$.k', 'string', c, 'type_mismatch' FROM c
  UNION ALL SELECT '$.ctx', 'object', b, 'ok' FROM c
  UNION ALL SELECT '$.ctx.tags', 'array', b, 'ok' FROM c
  UNION ALL SELECT '$.ctx.tags[]', 'bigint', b, 'type_mismatch' FROM c
  UNION ALL SELECT '$.ctx.tags[]', 'string', b, 'ok' FROM c
  UNION ALL SELECT '$.ctx.tags[]', 'null', b, 'ok' FROM c
  UNION ALL SELECT '$.ctx.tags[]', 'object', b, 'type_mismatch' FROM c
  UNION ALL SELECT '$.ctx.tags[].x', 'decimal', b, 'unexpected' FROM c
  UNION ALL SELECT '$.gone', NULL, 0, 'missing' FROM c)
"""


@query("nested_schema_drift", _NESTED_SQL)
def q_nested_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "props")
    kind = F.col("event_id") % 4
    body = F.regexp_extract("props", r"^\{(.*)\}$", 1)
    nested = F.concat(F.lit("{"), body, F.lit(', "ctx": {"tags": [1, "a", null, {"x": 1.5}]}}'))
    text = F.when(kind == 0, F.col("props")).when(kind == 1, nested).when(kind == 2, '{"k": "nine"}').otherwise("{broken")
    return nested_drift(e.select(text.alias("props")), "props", {
        "$": "object", "$.k": "bigint", "$.ctx": "object", "$.ctx.tags": "array", "$.ctx.tags[]": "string", "$.gone": "string"})
