"""Business KPIs on the order star schema.

Money is summed as exact decimals (price DECIMAL(18,2) x (1 - discount
DECIMAL(4,2))) and rounded once, so totals do not depend on summation order.
Line items are pre-aggregated per order before any join (one shuffle by
order key, map-side partial sums), which also makes "orders" counts plain
counts instead of distinct counts. Nation and region are fixed-size
dimensions and are broadcast; customer, part and orders grow with the data
and are left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.quantiles import exact_quantiles
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import materialize
from strata.sources.tables import read_table

# Fixed values of the KPI definitions.
# Customer segments by lifetime order value: at least 3,000,000 "platinum",
# at least 2,000,000 "gold", at least 1,000,000 "silver", otherwise "bronze".
SEGMENTS = ((3_000_000, "platinum"), (2_000_000, "gold"), (1_000_000, "silver"))
SEGMENT_ELSE = "bronze"
# Declared cost proxy (the data has no cost column): 70 % of gross sales.
COST_RATIO = "0.70"


def net_amount() -> Column:
    return (F.col("l_extendedprice").cast("decimal(18,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))


def money(c: Column) -> Column:
    """Round an exact decimal total to cents, then hand out a double."""
    return F.round(c, 2).cast("double")


def order_totals(lineitem: DataFrame) -> DataFrame:
    """One row per order: net revenue, gross, discount, tax and lines."""
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = gross * F.col("l_discount").cast("decimal(4,2)")
    return (lineitem.groupBy("l_orderkey")
            .agg(F.sum(net_amount()).alias("net"), F.sum(gross).alias("gross"),
                 F.sum(disc).alias("discount"),
                 F.sum(net_amount() * F.col("l_tax").cast("decimal(4,2)")).alias("tax"),
                 F.count(F.lit(1)).alias("lines")))


def orders_with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    t = order_totals(read_table(spark, sf_dir, "lineitem"))
    return o.join(t, o.o_orderkey == t.l_orderkey).drop("l_orderkey")


_ORDER_TOTALS_SQL = """
WITH t AS (
  SELECT l_orderkey,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
        * CAST(l_tax AS DECIMAL(4,2))) AS tax,
    COUNT(*) AS lines
  FROM lineitem GROUP BY l_orderkey),
ot AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, t.net, t.gross, t.discount, t.tax, t.lines
       FROM orders o JOIN t ON o.o_orderkey = t.l_orderkey)
"""


@query("revenue_daily", _ORDER_TOTALS_SQL + """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS orders,
       CAST(ROUND(SUM(net), 2) AS DOUBLE) AS revenue
FROM ot GROUP BY 1
""")
def q_revenue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (orders_with_totals(spark, sf_dir)
            .groupBy(F.to_date("o_orderdate").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("net")).alias("revenue")))


@query("revenue_monthly", _ORDER_TOTALS_SQL + """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders,
       CAST(ROUND(SUM(net), 2) AS DOUBLE) AS revenue,
       CAST(SUM(net) AS DOUBLE) / COUNT(*) AS avg_order,
       CAST(MIN(net) AS DOUBLE) AS min_order, CAST(MAX(net) AS DOUBLE) AS max_order
FROM ot GROUP BY 1
""")
def q_revenue_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM / COUNT / AVG / MIN / MAX of order value per month."""
    return (orders_with_totals(spark, sf_dir)
            .groupBy(F.trunc("o_orderdate", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("net")).alias("revenue"),
                 (F.sum("net").cast("double") / F.count(F.lit(1))).alias("avg_order"),
                 F.min("net").cast("double").alias("min_order"),
                 F.max("net").cast("double").alias("max_order")))


@query("avg_order_value", _ORDER_TOTALS_SQL + """
SELECT year(o_orderdate) AS order_year, COUNT(*) AS orders,
       CAST(ROUND(SUM(net), 2) AS DOUBLE) AS revenue,
       CAST(SUM(net) AS DOUBLE) / COUNT(*) AS avg_order_value
FROM ot GROUP BY 1
""")
def q_aov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (orders_with_totals(spark, sf_dir)
            .groupBy(F.year("o_orderdate").cast("bigint").alias("order_year"))
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("net")).alias("revenue"),
                 (F.sum("net").cast("double") / F.count(F.lit(1))).alias("avg_order_value")))


def customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (orders_with_totals(spark, sf_dir).groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("net")).alias("lifetime_value"),
                 F.min("o_orderdate").alias("first_order"),
                 F.max("o_orderdate").alias("last_order"))
            .withColumnRenamed("o_custkey", "c_custkey"))


@query("customer_ltv", _ORDER_TOTALS_SQL + """
SELECT o_custkey AS c_custkey, COUNT(*) AS orders,
       CAST(ROUND(SUM(net), 2) AS DOUBLE) AS lifetime_value,
       MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order
FROM ot GROUP BY 1
""")
def q_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_ltv(spark, sf_dir)


def segment(c: Column) -> Column:
    out = None
    for bound, label in SEGMENTS:
        out = F.when(c >= bound, label) if out is None else out.when(c >= bound, label)
    return out.otherwise(SEGMENT_ELSE)


@query("customer_segments", _ORDER_TOTALS_SQL + """
, s AS (SELECT o_custkey, CAST(ROUND(SUM(net), 2) AS DOUBLE) AS v FROM ot GROUP BY o_custkey)
SELECT c.c_custkey, COALESCE(s.v, 0.0) AS lifetime_value,
  CASE WHEN COALESCE(s.v, 0.0) >= 3000000 THEN 'platinum'
       WHEN COALESCE(s.v, 0.0) >= 2000000 THEN 'gold'
       WHEN COALESCE(s.v, 0.0) >= 1000000 THEN 'silver' ELSE 'bronze' END AS segment
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey
""")
def q_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer (also those without orders) in one tier of lifetime value."""
    v = customer_ltv(spark, sf_dir).select("c_custkey", "lifetime_value")
    j = read_table(spark, sf_dir, "customer").select("c_custkey").join(v, "c_custkey", "left")
    ltv = F.coalesce(F.col("lifetime_value"), F.lit(0.0))
    return j.select("c_custkey", ltv.alias("lifetime_value"), segment(ltv).alias("segment"))


@query("sales_per_customer", """
SELECT c.c_custkey, c.c_name, CAST(ROUND(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))), 2) AS DOUBLE)
       AS total_sales, COUNT(*) AS orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_name
""")
def q_sales_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate orders per customer key first, then attach the name: the
    join sees one row per customer instead of one per order."""
    per = (read_table(spark, sf_dir, "orders").groupBy("o_custkey")
           .agg(money(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("total_sales"),
                F.count(F.lit(1)).alias("orders")))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return per.join(c, per.o_custkey == c.c_custkey).select("c_custkey", "c_name",
                                                           "total_sales", "orders")


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: 25 rows whatever the scale, safe to broadcast."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def last_years(df: DataFrame, date_col: str, years: int) -> DataFrame:
    """Rows within ``years`` before the latest date in the data. The anchor
    is a scalar subquery (one aggregate job, its value fed into the filter):
    no join, nothing collected by hand."""
    anchor = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) > anchor - F.make_ym_interval(F.lit(years)))


@query("sales_by_country_5y", _ORDER_TOTALS_SQL + """
, a AS (SELECT MAX(o_orderdate) AS anchor FROM orders)
SELECT n.n_name, COUNT(*) AS orders, CAST(ROUND(SUM(ot.net), 2) AS DOUBLE) AS revenue
FROM ot JOIN customer c ON ot.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey, a
WHERE ot.o_orderdate > a.anchor - INTERVAL 60 MONTH
GROUP BY n.n_name
""")
def q_country_5y(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = last_years(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                             "o_orderdate"), "o_orderdate", 5)
    li = read_table(spark, sf_dir, "lineitem")
    # only lines of the orders in range reach the per-order aggregate
    t = order_totals(li.join(o, li.l_orderkey == o.o_orderkey, "left_semi"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = F.broadcast(geo(spark, sf_dir))
    j = (o.join(t, o.o_orderkey == t.l_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(g, F.col("c_nationkey") == g.n_nationkey))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"),
                                   money(F.sum("net")).alias("revenue"))


@query("top20_products_europe_3y", """
WITH a AS (SELECT MAX(o_orderdate) AS anchor FROM orders),
o AS (SELECT o_orderkey, o_custkey FROM orders, a
      WHERE o_orderdate > a.anchor - INTERVAL 36 MONTH),
eu AS (SELECT c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'EUROPE')
SELECT p.p_partkey, p.p_name,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))), 2)
       AS DOUBLE) AS revenue,
  CAST(SUM(l.l_quantity) AS DOUBLE) AS units
FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey
JOIN eu ON o.o_custkey = eu.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
ORDER BY revenue DESC, p.p_partkey
LIMIT 20
""")
def q_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k is the feature here: filter -> join -> aggregate per part ->
    ``orderBy().limit(20)`` (planned as TakeOrderedAndProject: each task
    keeps its own top 20, the driver merges 20 x tasks rows)."""
    o = last_years(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                             "o_orderdate"), "o_orderdate", 3)
    eu = F.broadcast(geo(spark, sf_dir).filter(F.col("r_name") == "EUROPE"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    eu_cust = c.join(eu, c.c_nationkey == eu.n_nationkey, "left_semi")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                     "l_extendedprice", "l_discount")
    per_part = (li.join(o.join(eu_cust, o.o_custkey == eu_cust.c_custkey, "left_semi"),
                        li.l_orderkey == o.o_orderkey, "left_semi")
                .groupBy("l_partkey")
                .agg(money(F.sum(net_amount())).alias("revenue"),
                     F.sum("l_quantity").alias("units")))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (per_part.join(p, per_part.l_partkey == p.p_partkey)
            .select("p_partkey", "p_name", "revenue", "units")
            .orderBy(F.desc("revenue"), F.asc("p_partkey")).limit(20))


@query("business_measures", _ORDER_TOTALS_SQL + f"""
, y AS (SELECT year(o_orderdate) AS order_year, SUM(gross) AS gross, SUM(discount) AS discount,
               SUM(net) AS net, SUM(tax) AS tax, SUM(gross) * {COST_RATIO} AS cost
        FROM ot GROUP BY 1)
SELECT order_year,
  CAST(ROUND(gross, 2) AS DOUBLE) AS gross_sales, CAST(ROUND(discount, 2) AS DOUBLE) AS discounts,
  CAST(ROUND(net, 2) AS DOUBLE) AS net_sales, CAST(ROUND(tax, 2) AS DOUBLE) AS tax,
  CAST(ROUND(net - cost, 2) AS DOUBLE) AS profit,
  CASE WHEN net = 0 THEN NULL ELSE CAST(net - cost AS DOUBLE) / CAST(net AS DOUBLE) END AS margin
FROM y
""")
def q_business_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, discount, net sales, tax, profit and margin per year (profit
    uses the declared cost proxy; margin is NULL when net sales are 0)."""
    y = (orders_with_totals(spark, sf_dir)
         .groupBy(F.year("o_orderdate").cast("bigint").alias("order_year"))
         .agg(F.sum("gross").alias("gross"), F.sum("discount").alias("discount"),
              F.sum("net").alias("net"), F.sum("tax").alias("tax")))
    cost = F.col("gross") * F.lit(COST_RATIO).cast("decimal(3,2)")
    return y.select(
        "order_year", money(F.col("gross")).alias("gross_sales"),
        money(F.col("discount")).alias("discounts"), money(F.col("net")).alias("net_sales"),
        money(F.col("tax")).alias("tax"), money(F.col("net") - cost).alias("profit"),
        F.when(F.col("net") == 0, F.lit(None).cast("double"))
         .otherwise((F.col("net") - cost).cast("double") / F.col("net").cast("double"))
         .alias("margin"))


@query("margin_trend", _ORDER_TOTALS_SQL + f"""
, y AS (SELECT year(o_orderdate) AS order_year, quarter(o_orderdate) AS order_quarter, SUM(net) AS net,
               SUM(net) - SUM(gross) * {COST_RATIO} AS profit FROM ot GROUP BY 1, 2),
m AS (SELECT *, order_year * 4 + order_quarter AS q,
             CASE WHEN net <> 0 THEN CAST(profit AS DOUBLE) / CAST(net AS DOUBLE) END AS margin FROM y)
SELECT b.order_year, b.order_quarter, b.margin, a.margin AS prev_margin, b.margin - a.margin AS margin_change
FROM m b LEFT JOIN m a ON a.q = b.q - 1
""")
def q_margin_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit margin per quarter and its change against the quarter before
    (NULL where that quarter has no orders)."""
    gross, net = F.sum("gross"), F.sum("net")
    m = (orders_with_totals(spark, sf_dir)
         .groupBy(F.year("o_orderdate").cast("bigint").alias("order_year"),
                  F.quarter("o_orderdate").cast("bigint").alias("order_quarter"))
         .agg(net.alias("net"), (net - gross * F.lit(COST_RATIO).cast("decimal(3,2)")).alias("profit")))
    m = m.select("order_year", "order_quarter", (F.col("order_year") * 4 + F.col("order_quarter")).alias("q"),
                 F.when(F.col("net") != 0, F.col("profit").cast("double") / F.col("net").cast("double")).alias("margin"))
    prev = m.select((F.col("q") + 1).alias("q"), F.col("margin").alias("prev_margin"))
    return m.join(prev, "q", "left").select("order_year", "order_quarter", "margin", "prev_margin",
                                            (F.col("margin") - F.col("prev_margin")).alias("margin_change"))


@query("monthly_retention", """
WITH cm AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
            FROM orders),
act AS (SELECT month, COUNT(*) AS active_customers FROM cm GROUP BY month),
ret AS (SELECT b.month, COUNT(*) AS retained_customers
        FROM cm a JOIN cm b ON a.o_custkey = b.o_custkey AND b.month = a.month + INTERVAL 1 MONTH
        GROUP BY b.month)
SELECT act.month, act.active_customers, COALESCE(ret.retained_customers, 0) AS retained_customers,
       prev.active_customers AS prev_active_customers,
       CAST(COALESCE(ret.retained_customers, 0) AS DOUBLE) / prev.active_customers AS retention_rate
FROM act LEFT JOIN ret ON act.month = ret.month
LEFT JOIN act prev ON prev.month = act.month - INTERVAL 1 MONTH
""")
def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers active in a month who were also active the month before.

    Distinct (customer, month) pairs, then each pair is flagged when the
    customer's previous active month is the calendar month before (``lag``
    per customer: after the distinct a customer has at most one row per
    month, so each window partition is bounded by the number of months).
    One monthly aggregate follows; the previous month's activity is an equi
    join of that result with itself on month + 1."""
    cm = (read_table(spark, sf_dir, "orders")
          .select("o_custkey", F.trunc("o_orderdate", "month").alias("month")).distinct())
    w = Window.partitionBy("o_custkey").orderBy("month")
    flagged = cm.withColumn(
        "_kept", (F.lag("month").over(w) == F.add_months("month", -1)).cast("int"))
    monthly = flagged.groupBy("month").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.coalesce(F.sum("_kept"), F.lit(0)).cast("bigint").alias("retained_customers"))
    prev = monthly.select(F.add_months("month", 1).alias("month"),
                          F.col("active_customers").alias("prev_active_customers"))
    return (monthly.join(prev, "month", "left")
            .select("month", "active_customers", "retained_customers", "prev_active_customers",
                    (F.col("retained_customers").cast("double") / F.col("prev_active_customers"))
                    .alias("retention_rate")))


@query("exact_percentiles", """
SELECT l_returnflag, l_linestatus, COUNT(l_extendedprice) AS n,
       quantile_disc(l_extendedprice, 0.05) AS p05, quantile_disc(l_extendedprice, 0.5) AS median,
       quantile_disc(l_extendedprice, 0.95) AS p95, quantile_disc(l_extendedprice, 0.99) AS p99
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact price percentiles of a few very large groups."""
    return exact_quantiles(read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
                           {"p05": "0.05", "median": "0.5", "p95": "0.95", "p99": "0.99"})


def cohort_bitmaps(orders: DataFrame) -> DataFrame:
    """cohort, month, bucket, customers: one bitmap of 32,768 customer numbers
    per cohort (month of the first order), month and bucket. Customers are
    distinct within a bitmap, so counts can be taken over any union of months."""
    per = orders.select("o_custkey", F.trunc("o_orderdate", "month").alias("month")).where("o_custkey is not null").groupBy(
        "o_custkey").agg(F.min("month").alias("cohort"), F.collect_set("month").alias("months"))
    active = per.select("o_custkey", "cohort", F.explode("months").alias("month"))
    return active.groupBy("cohort", "month", F.bitmap_bucket_number("o_custkey").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("o_custkey")).alias("customers"))


def union_count(bitmaps: DataFrame, *keys: Column) -> DataFrame:
    """Distinct customers per ``keys`` over the union of their bitmaps."""
    names = [f"_k{i}" for i in range(len(keys))]
    merged = bitmaps.groupBy(*[k.alias(n) for k, n in zip(keys, names)], "bucket").agg(
        F.bitmap_or_agg("customers").alias("customers"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("customers")).alias("customers"))


def stored_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(cohort_bitmaps(read_table(spark, sf_dir, "orders")), scratch_path(spark, "cohorts"))


_COHORT_SQL = """
WITH a AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
           WHERE o_custkey IS NOT NULL),
f AS (SELECT o_custkey, min(month) AS cohort FROM a GROUP BY 1),
x AS (SELECT a.o_custkey, cohort, month FROM a JOIN f USING (o_custkey))
"""


@query("cohort_retention", _COHORT_SQL + """
SELECT cohort, CAST(date_diff('month', cohort, month) AS INTEGER) AS months_after, COUNT(DISTINCT o_custkey) AS customers,
       COUNT(DISTINCT o_custkey) / CAST((SELECT COUNT(*) FROM f WHERE f.cohort = x.cohort) AS DOUBLE) AS retention
FROM x GROUP BY cohort, month
""")
def q_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort x month matrix: customers of a cohort who ordered so many months
    after their first order, and their share of the cohort."""
    n = union_count(stored_cohorts(spark, sf_dir), F.col("cohort"), F.col("month")).select(
        F.col("_k0").alias("cohort"), F.round(F.months_between("_k1", "_k0")).cast("int").alias("months_after"), "customers")
    size = n.where("months_after = 0").select("cohort", F.col("customers").alias("size"))
    return n.join(size, "cohort").select("cohort", "months_after", "customers",
                                         (F.col("customers") / F.col("size").cast("double")).alias("retention"))


@query("cohort_quarters", _COHORT_SQL + """
SELECT CAST(year(cohort) AS INTEGER) AS cohort_year, CAST(date_trunc('quarter', month) AS DATE) AS quarter,
       COUNT(DISTINCT o_custkey) AS customers
FROM x GROUP BY ALL
""")
def q_cohort_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bitmaps rolled up to cohort years and quarters: a customer who
    ordered in several months of a quarter counts once, which sums of the
    monthly counts could not give."""
    return union_count(stored_cohorts(spark, sf_dir), F.year("cohort"), F.trunc("month", "quarter")).select(
        F.col("_k0").alias("cohort_year"), F.col("_k1").alias("quarter"), "customers")
