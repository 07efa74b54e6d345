"""Normalisation, denormalisation, star and snowflake modelling.

A flat order sheet (line x order x customer x part) is split into
Customers / Orders / Products / OrderItems by projection + distinct, written
to the shared folder, and joined back. Surrogate keys are ``xxhash64`` of
the natural key, computed per row, or dense numbers (``dense_keys``); neither
needs the single-partition window of a ``dense_rank``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import fd_violations, minimal_dependencies
from strata.operators.surrogates import dense_keys
from strata.plans.kpi import geo, money, net_amount
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import materialize
from strata.sources.tables import read_table

ENTITIES = {
    "customers": (["c_custkey"], ["c_name", "c_mktsegment"]),
    "orders": (["o_orderkey"], ["o_custkey", "o_orderdate", "o_orderstatus"]),
    "products": (["p_partkey"], ["p_name", "p_brand"]),
    "order_items": (["o_orderkey", "l_linenumber", "p_partkey"], ["l_quantity", "l_extendedprice"]),
}


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                  "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # customers join at order grain, before the lines multiply the rows
    oc = o.join(c, F.col("o_custkey") == c.c_custkey)
    return (li.join(oc, li.l_orderkey == oc.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .drop("l_orderkey", "l_partkey"))


def surrogate(*cols: str):
    return F.xxhash64(*cols)


def normalise(flat: DataFrame, root: str) -> dict[str, DataFrame]:
    """Write each entity (2NF/3NF split: attributes that depend on part of a
    key or on a non-key move to their own table) and return them read back."""
    out = {}
    for name, (keys, attrs) in ENTITIES.items():
        t = flat.select(*keys, *attrs)
        if name != "order_items":
            t = t.distinct()
        t = t.withColumn("sk", surrogate(*keys))
        t.write.mode("overwrite").parquet(f"{root}/{name}")
        out[name] = flat.sparkSession.read.parquet(f"{root}/{name}")
    return out


def denormalise(tables: dict[str, DataFrame]) -> DataFrame:
    items, o = tables["order_items"].drop("sk"), tables["orders"].drop("sk")
    c, p = tables["customers"].drop("sk"), tables["products"].drop("sk")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    return items.join(oc, "o_orderkey").join(p, "p_partkey")


_FLAT_SQL = """
WITH flat AS (
  SELECT l.l_linenumber, l.l_quantity, l.l_extendedprice, o.o_orderkey, o.o_custkey,
         o.o_orderdate, o.o_orderstatus, c.c_custkey, c.c_name, c.c_mktsegment,
         p.p_partkey, p.p_name, p.p_brand
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)
"""


@query("normalise_orders", _FLAT_SQL + """
SELECT 'customers' AS entity, COUNT(*) AS row_count
  FROM (SELECT DISTINCT c_custkey, c_name, c_mktsegment FROM flat)
UNION ALL SELECT 'orders', COUNT(*)
  FROM (SELECT DISTINCT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM flat)
UNION ALL SELECT 'products', COUNT(*) FROM (SELECT DISTINCT p_partkey, p_name, p_brand FROM flat)
UNION ALL SELECT 'order_items', COUNT(*) FROM flat
""")
def q_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "normalised")
    flat_path = f"{root}/flat"
    flat_orders(spark, sf_dir).write.parquet(flat_path)  # the join runs once
    tables = normalise(spark.read.parquet(flat_path), root)
    out = None
    for name, t in tables.items():
        part = t.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("entity"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


@query("denormalise_orders", _FLAT_SQL + "SELECT * EXCLUDE (c_custkey) FROM flat")
def q_denormalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip: normalise, then join the four tables back to wide rows."""
    root = scratch_path(spark, "normalised")
    flat_path = f"{root}/flat"
    flat_orders(spark, sf_dir).write.parquet(flat_path)  # the join runs once
    tables = normalise(spark.read.parquet(flat_path), root)
    return denormalise(tables).drop("c_custkey")


@query("fd_violations", """
SELECT l_orderkey, l_linenumber, COUNT(DISTINCT l_partkey) AS distinct_rhs
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(DISTINCT l_partkey) > 1
""")
def q_fd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber) -> l_partkey should hold for a key; rows
    where it does not are candidates for splitting into their own table."""
    return fd_violations(read_table(spark, sf_dir, "lineitem"),
                         ["l_orderkey", "l_linenumber"], ["l_partkey"])


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact at line grain with dimension keys and measures."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_key"), F.col("l_partkey").alias("product_key"),
        (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100
         + F.dayofmonth("o_orderdate")).alias("date_key"),
        net_amount().alias("revenue"), F.col("l_quantity").alias("units"))


@query("star_fact_sales", """
SELECT r.r_name, CAST(year(o.o_orderdate) AS INTEGER) AS order_year, p.p_brand,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))), 2)
       AS DOUBLE) AS revenue,
  CAST(SUM(l.l_quantity) AS DOUBLE) AS units
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY r.r_name, year(o.o_orderdate), p.p_brand
""")
def q_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star join fact-first: fact -> customer (-> broadcast geography),
    fact -> product, date from the date key; then aggregate."""
    f = sales_fact(spark, sf_dir)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = F.broadcast(geo(spark, sf_dir))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (f.join(c, f.customer_key == c.c_custkey)
         .join(g, F.col("c_nationkey") == g.n_nationkey)
         .join(p, f.product_key == p.p_partkey))
    return (j.groupBy("r_name", (F.col("date_key") / 10000).cast("int").alias("order_year"),
                      "p_brand")
            .agg(money(F.sum("revenue")).alias("revenue"),
                 F.sum("units").alias("units")))


def incremental_dimension(current: DataFrame | None, batch: DataFrame, keys: list[str],
                          batch_no: int) -> DataFrame:
    """New keys only (``left_anti`` against the dimension), stamped with the
    batch that introduced them."""
    fresh = batch.select(*keys).distinct()
    if current is not None:
        fresh = fresh.join(current.select(*keys), keys, "left_anti")
    return fresh.withColumn("first_batch", F.lit(batch_no))


@query("star_incremental_dims", """
SELECT c_custkey, CAST(MIN(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END) AS INTEGER)
       AS first_batch
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey
""")
def q_incremental_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension grown from two sales batches (before / from 1998)."""
    root = scratch_path(spark, "dim-customer")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"),
                                                  "o_orderdate")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    incremental_dimension(None, o.filter(cut), ["c_custkey"], 1).write.parquet(root)
    dim = spark.read.parquet(root)
    incremental_dimension(dim, o.filter(~cut), ["c_custkey"], 2).write.mode("append").parquet(root)
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return spark.read.parquet(root).join(c, "c_custkey", "left_semi")


@query("snowflake_product", """
SELECT p.p_type, p.p_brand,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))), 2)
       AS DOUBLE) AS revenue,
  CAST(SUM(l.l_quantity) AS DOUBLE) AS units
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type, p.p_brand
""")
def q_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension snowflaked into product -> brand and product -> type
    outriggers, queried fact -> product -> outriggers. Joins on the hash
    surrogate also compare the natural key, so a hash collision cannot mix rows."""
    part = read_table(spark, sf_dir, "part")
    brand = part.select("p_brand").distinct().withColumn("brand_sk", surrogate("p_brand"))
    ptype = part.select("p_type").distinct().withColumn("type_sk", surrogate("p_type"))
    product = part.select("p_partkey", "p_brand", "p_type", surrogate("p_brand").alias("brand_sk"),
                          surrogate("p_type").alias("type_sk"))
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity",
                                                     "l_extendedprice", "l_discount")
    j = (li.join(product, li.l_partkey == product.p_partkey)
         .join(brand, ["brand_sk", "p_brand"]).join(ptype, ["type_sk", "p_type"]))
    return (j.groupBy("p_type", "p_brand")
            .agg(money(F.sum(net_amount())).alias("revenue"), F.sum("l_quantity").alias("units")))


@query("first_normal_form", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token,
       CAST(unnest(generate_series(1, len(string_split(p_name, ' ')))) AS INTEGER) AS position
FROM part
""")
def q_1nf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per cell: the multi-word ``p_name`` split into rows."""
    part = read_table(spark, sf_dir, "part")
    return part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "token")) \
        .select("p_partkey", "token", (F.col("pos") + 1).alias("position"))


def split_by_dependency(df: DataFrame, lhs: list[str], rhs: list[str]) -> tuple[DataFrame, DataFrame]:
    """2NF / 3NF split by the declared dependency ``lhs -> rhs``: (the rest,
    which keeps ``lhs``; the new table with one row per ``lhs``). A value of
    ``lhs`` with two values of ``rhs`` breaks the dependency and fails the
    query. Lossless: joining on ``lhs`` restores ``df``."""
    one = df.groupBy(*lhs).agg(F.count_distinct(F.struct(*rhs)).alias("_n"), F.max(F.struct(*rhs)).alias("_r"))
    checked = F.when(F.col("_n") == 1, F.col("_r")).otherwise(
        F.raise_error(F.lit(f"{lhs} does not determine {rhs}")))
    table = one.withColumn("_r", checked).select(*lhs, *[F.col(f"_r.{c}").alias(c) for c in rhs])
    return df.drop(*rhs), table


@query("split_by_dependency", _FLAT_SQL + """
SELECT o_orderkey, any_value(o_orderdate) AS o_orderdate, any_value(c_custkey) AS c_custkey,
       any_value(c_name) AS c_name, any_value(c_mktsegment) AS c_mktsegment, COUNT(*) AS lines
FROM flat GROUP BY o_orderkey
""")
def q_split_by_dependency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines to 2NF (order -> its date and customer), then the order
    table to 3NF (customer -> name and segment); shown joined, with the lines
    that stay in the rest."""
    root = scratch_path(spark, "split")
    flat_orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "c_custkey", "c_name", "c_mktsegment",
                                      "l_linenumber").write.parquet(root)
    rest, orders = split_by_dependency(spark.read.parquet(root), ["o_orderkey"],
                                       ["o_orderdate", "c_custkey", "c_name", "c_mktsegment"])
    orders, customers = split_by_dependency(orders, ["c_custkey"], ["c_name", "c_mktsegment"])
    lines = rest.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return orders.join(customers, "c_custkey").join(lines, "o_orderkey").select(
        "o_orderkey", "o_orderdate", "c_custkey", "c_name", "c_mktsegment", "lines")


def grow_dimension(spark: SparkSession, path: str, batch: DataFrame, key: list[str], batch_no: int) -> DataFrame:
    """Append the members of ``batch`` that the stored dimension lacks, with
    their attributes and a surrogate key; returns the dimension."""
    have = spark.read.parquet(path) if batch_no else None
    new = batch if have is None else batch.join(have.select(*key), key, "left_anti")
    new.withColumn("sk", surrogate(*key)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("star_incremental_load", """
SELECT c.c_mktsegment, p.p_brand, CAST(year(o.o_orderdate) AS INTEGER) AS sale_year,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))), 2)
       AS DOUBLE) AS revenue, COUNT(*) AS sales
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY c.c_mktsegment, p.p_brand, year(o.o_orderdate)
""")
def q_star_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sales batches (before / from 1998) grow the customer, product and
    date dimensions; the fact takes their surrogate keys by lookup on the
    natural keys and is appended batch by batch; then a star query."""
    root = scratch_path(spark, "star")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    for n, cond in enumerate((before, ~before)):
        b = o.filter(cond)
        sales = li.join(b, li.l_orderkey == b.o_orderkey).withColumn("day", F.to_date("o_orderdate"))
        dim_c = grow_dimension(spark, f"{root}/customer", cust.join(
            b, cust.c_custkey == b.o_custkey, "left_semi"), ["c_custkey"], n)
        dim_p = grow_dimension(spark, f"{root}/product", part.join(
            sales, part.p_partkey == sales.l_partkey, "left_semi"), ["p_partkey"], n)
        dim_d = grow_dimension(spark, f"{root}/date", b.select(F.to_date("o_orderdate").alias("day")).distinct()
                               .withColumn("year", F.year("day")), ["day"], n)
        fact = (sales.join(dim_c.select("c_custkey", F.col("sk").alias("customer_sk")),
                           F.col("o_custkey") == F.col("c_custkey"))
                .join(dim_p.select("p_partkey", F.col("sk").alias("product_sk")),
                      F.col("l_partkey") == F.col("p_partkey"))
                .join(dim_d.select("day", F.col("sk").alias("date_sk")), "day"))
        fact.select("customer_sk", "product_sk", "date_sk", net_amount().alias("revenue")).write.mode(
            "append").parquet(f"{root}/fact")
    star = (spark.read.parquet(f"{root}/fact")
            .join(dim_c.select(F.col("sk").alias("customer_sk"), "c_mktsegment"), "customer_sk")
            .join(dim_p.select(F.col("sk").alias("product_sk"), "p_brand"), "product_sk")
            .join(dim_d.select(F.col("sk").alias("date_sk"), F.col("year").alias("sale_year")), "date_sk"))
    return star.groupBy("c_mktsegment", "p_brand", "sale_year").agg(
        money(F.sum("revenue")).alias("revenue"), F.count(F.lit(1)).alias("sales"))


@query("dense_surrogate_keys", """
WITH o AS (SELECT c.c_nationkey, c.c_mktsegment, o.o_orderpriority, o.o_orderkey,
                  CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS load_no
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
k AS (SELECT c_nationkey, c_mktsegment, o_orderpriority, min(load_no) AS load_no FROM o GROUP BY ALL)
SELECT load_no, COUNT(*) AS members, COUNT(*) AS numbers,
       CASE WHEN load_no = 0 THEN 1 ELSE 1 + (SELECT COUNT(*) FROM k WHERE load_no = 0) END AS first_number,
       CASE WHEN load_no = 0 THEN COUNT(*) ELSE (SELECT COUNT(*) FROM k) END AS last_number,
       (SELECT COUNT(*) FROM o JOIN k USING (c_nationkey, c_mktsegment, o_orderpriority) WHERE k.load_no = x.load_no) AS facts
FROM k x GROUP BY load_no
""")
def q_dense_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a three-column natural key over two loads: dense, unique,
    unchanged for the members of the first load; facts find them by lookup."""
    key = ["c_nationkey", "c_mktsegment", "o_orderpriority"]
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    first = dense_keys(rows.where(before), key, "member")
    every = dense_keys(rows.where(~before), key, "member", first)
    load = F.when(F.col("old.member").isNotNull(), 0).otherwise(1).alias("load_no")
    members = every.alias("e").join(first.alias("old"), (F.col("e.member") == F.col("old.member")) & _same_key(key, "e", "old"),
                                    "left").select("e.*", load)
    facts = rows.alias("r").join(members.alias("e"), _same_key(key, "r", "e")).groupBy("load_no").agg(
        F.count(F.lit(1)).alias("facts"))
    return members.groupBy("load_no").agg(
        F.count(F.lit(1)).alias("members"), F.count_distinct("member").alias("numbers"), F.min("member").alias("first_number"),
        F.max("member").alias("last_number")).join(facts, "load_no")


def _same_key(key: list[str], a: str, b: str):
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


DEPENDENCY_COLUMNS = ["o_orderkey", "l_linenumber", "o_custkey", "o_orderdate", "o_orderpriority", "c_mktsegment"]


def _dependency_sql() -> str:
    """Every candidate with at most two columns on the left, by counting; minimal
    ones are those without a smaller one."""
    from itertools import combinations

    cols, parts = DEPENDENCY_COLUMNS, []
    text = lambda c: f"coalesce('=' || CAST({c} AS VARCHAR), 'null')"
    for n in range(3):
        for left in combinations(cols, n):
            for a in cols:
                if a not in left:
                    group = "GROUP BY " + ", ".join(left) if left else ""
                    parts.append(f"SELECT {list(left)}::VARCHAR[] AS lhs, '{a}' AS rhs WHERE NOT EXISTS (SELECT 1 FROM flat {group} "
                                 f"HAVING count(DISTINCT {text(a)}) > 1)")
    return ("WITH flat AS (SELECT o_orderkey, l_linenumber, o_custkey, o_orderdate, o_orderpriority, c_mktsegment "
            "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey), "
            "fd AS (" + " UNION ALL ".join(parts) + ") "
            "SELECT array_to_string(lhs, ',') AS lhs, rhs FROM fd x WHERE NOT EXISTS (SELECT 1 FROM fd y "
            "WHERE y.rhs = x.rhs AND len(y.lhs) < len(x.lhs) AND list_has_all(x.lhs, y.lhs))")


@query("find_dependencies", _dependency_sql())
def q_find_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal dependencies with up to two columns on the left in the flat
    order sheet, found by the level-wise search."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    flat = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    flat = materialize(flat.select(*DEPENDENCY_COLUMNS), scratch_path(spark, "flat-orders"))
    found = minimal_dependencies(flat, DEPENDENCY_COLUMNS, max_lhs=2)
    return spark.createDataFrame([(",".join(lhs), rhs) for lhs, rhs in found], "lhs string, rhs string")
