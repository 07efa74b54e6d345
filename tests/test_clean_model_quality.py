"""Worked examples from the concept documents, as tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.clean import (age_in_years, clean_text, fill_defaults, in_range,
                                    parse_timestamp, snake_case, split_to_rows,
                                    standardise_column_names)
from strata.operators.dedup import distinct_rows, keep_latest
from strata.operators.quality import (duplicate_keys, fd_violations, json_field_drift,
                                      null_profile, orphans, quarantine, reconcile_counts,
                                      schema_diff, split_quarantine)
from strata.operators.rules import Rule
from strata.plans.modeling import denormalise, incremental_dimension, normalise


def test_row_dedup(spark):
    df = spark.createDataFrame([(101, "Alice"), (101, "Alice")], "id int, name string")
    assert distinct_rows(df).count() == 1


def test_clean_fill_and_flag_age(spark):
    df = spark.createDataFrame([(101, "Alice", 30), (101, "Alice", 30), (102, None, 25),
                                (103, "Carol", -5)], "id int, name string, age int")
    out = fill_defaults(distinct_rows(df), {"name": "Unknown"}) \
        .withColumn("age_ok", in_range(F.col("age"), 0, 120))
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 3 and rows[102]["name"] == "Unknown" and rows[103]["age_ok"] is False
    q = quarantine(df, [Rule("age_range", "age BETWEEN 0 AND 120", "drop")])
    good, bad = split_quarantine(q)
    assert [r["id"] for r in bad.collect()] == [103]
    assert bad.first()["_reasons"] == ["age_range"] and good.count() == 3


def test_customer_totals(spark):
    sales = spark.createDataFrame([("Alice", 100), ("Alice", 200), ("Bob", 150)],
                                  "Customer string, Amount int")
    assert {r[0]: r[1] for r in sales.groupBy("Customer").sum("Amount").collect()} == \
        {"Alice": 300, "Bob": 150}


def test_schema_on_write_rejects_bad_type(spark):
    raw = spark.createDataFrame([("101", "Alice", "Thirty")], "id string, name string, age string")
    q = quarantine(raw, [Rule("age_is_int", "try_cast(age AS INT) IS NOT NULL", "drop")])
    assert q.first()["_status"] == "quarantined"


def test_first_normal_form(spark):
    df = spark.createDataFrame([("Anu", "Math, Science")], "student string, subjects string")
    got = sorted(r[0] for r in df.select(split_to_rows(F.col("subjects"))).collect())
    assert got == ["Math", "Science"]


def test_third_normal_form_split(spark):
    emp = spark.createDataFrame([(1, 10, "Sales"), (2, 10, "Sales"), (3, 20, "HR")],
                                "EmpID int, DeptID int, DeptName string")
    depts = emp.select("DeptID", "DeptName").distinct()
    assert depts.count() == 2
    assert fd_violations(emp, ["DeptID"], ["DeptName"]).count() == 0
    broken = emp.union(spark.createDataFrame([(4, 10, "Ops")], emp.schema))
    assert [r["DeptID"] for r in fd_violations(broken, ["DeptID"], ["DeptName"]).collect()] == [10]


def test_normalise_round_trip(spark, tmp):
    flat = spark.createDataFrame(
        [(1, 1, 11, 2.0, 20.0, 7, dt.datetime(2024, 1, 1), "O", 7, "Anu", "HOUSEHOLD", "pen", "B1"),
         (2, 1, 12, 1.0, 15.0, 7, dt.datetime(2024, 1, 2), "F", 7, "Anu", "HOUSEHOLD", "book", "B2")],
        "o_orderkey long, l_linenumber int, p_partkey long, l_quantity double, "
        "l_extendedprice double, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, "
        "c_custkey long, c_name string, c_mktsegment string, p_name string, p_brand string")
    t = normalise(flat, tmp)
    assert {k: v.count() for k, v in t.items()} == {
        "customers": 1, "orders": 2, "products": 2, "order_items": 2}
    back = denormalise(t).select(*flat.columns)
    assert back.exceptAll(flat).count() == 0 and flat.exceptAll(back).count() == 0


def test_incremental_dimension_adds_only_new_keys(spark):
    b1 = spark.createDataFrame([("BR1",), ("BR2",)], "branch string")
    dim = incremental_dimension(None, b1, ["branch"], 1)
    b2 = spark.createDataFrame([("BR2",), ("BR3",)], "branch string")
    new = incremental_dimension(dim, b2, ["branch"], 2)
    assert [r["branch"] for r in new.collect()] == ["BR3"]


def test_checks(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, "x"), (2, 1, "y")], "k int, l int, s string")
    assert {r["column_name"]: r["null_count"] for r in null_profile(df).collect()}["s"] == 1
    assert duplicate_keys(df, ["k", "l"]).first()["dup_count"] == 2
    assert reconcile_counts(df, df.limit(2)).first()["difference"] == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r["k"] for r in orphans(df, parent, ["k"], ["k"]).collect()] == [2]


def test_schema_diff_and_json_drift(spark):
    exp = spark.createDataFrame([], "a int, b string, c double").schema
    act = spark.createDataFrame([], "a int, b int, d string").schema
    got = {r["column_name"]: r["status"] for r in schema_diff(spark, exp, act).collect()}
    assert got == {"a": "ok", "b": "type_mismatch", "c": "missing", "d": "unexpected"}
    js = spark.createDataFrame([('{"k": 1}',), ('{"k": 2, "z": 3}',)], "p string")
    drift = {r["field"]: (r["rows_present"], r["status"])
             for r in json_field_drift(js, "p", ["k", "src"]).collect()}
    assert drift == {"k": (2, "ok"), "z": (1, "unexpected"), "src": (0, "missing")}


def test_standardise_names_text_age(spark):
    assert snake_case("Customer Name") == "customer_name"
    assert snake_case("Nation-Key") == "nation_key" and snake_case("AcctBal") == "acct_bal"
    df = spark.createDataFrame([("  hello   world ", dt.date(2000, 6, 16))], "`Raw Text` string, DOB date")
    out = standardise_column_names(df)
    assert out.columns == ["raw_text", "dob"]
    r = out.select(clean_text(F.col("raw_text"), "title").alias("t"),
                   age_in_years(F.col("dob"), F.lit(dt.date(2024, 6, 15))).alias("age")).first()
    assert r["t"] == "Hello World" and r["age"] == 23


def test_keep_latest_matches_row_number(spark):
    from pyspark.sql.window import Window
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (1, 7, "c"), (2, None, "d")],
                               "k int, ts int, v string")
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = keep_latest(df, ["k"], ["ts"])
    assert sorted(got.collect()) == sorted(ref.collect())


def test_parse_timestamp_formats(spark):
    df = spark.createDataFrame([("2024-03-01 10:00:00",), ("01/03/2024",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("s"), "dd/MM/yyyy")).collect()]
    assert got[1] is not None and got[2] is None


def test_keep_latest_with_map_column(spark):
    df = spark.createDataFrame([(1, 5, {"a": "x"}), (1, 7, {"b": "y"}), (2, None, None)],
                               "k int, ts int, m map<string,string>")
    got = {r["k"]: (r["ts"], r["m"]) for r in keep_latest(df, ["k"], ["ts"]).collect()}
    assert got == {1: (7, {"b": "y"}), 2: (None, None)}
