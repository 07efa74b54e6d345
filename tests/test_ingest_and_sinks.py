"""Idempotent loads, schema evolution, rescued values, inventory, table sinks."""

import os

import pytest
from pyspark.sql import types as T

from strata.sinks import tables as tb
from strata.sources import readers as rd
from strata.streaming.ingest import age_files, copy_into, load_with_schema_evolution, read_loaded

EMP_SCHEMA = T.StructType([T.StructField("ID", T.IntegerType()),
                           T.StructField("FirstName", T.StringType()),
                           T.StructField("Country", T.StringType()),
                           T.StructField("Role", T.StringType())])


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_copy_into_is_idempotent_by_path(spark, tmp):
    land = f"{tmp}/landing"
    write_text(f"{land}/employees.csv", "ID,FirstName,Country,Role\n1,Kristi,United States,"
               "Data Engineer\n2,Sophia,Germany,Data Analyst\n3,Peter,Canada,ML Engineer\n"
               "4,Zebi,India,Data Scientist\n")
    args = (spark, land, f"{tmp}/bronze", f"{tmp}/_ckpt", "csv", EMP_SCHEMA, {"header": True})
    assert copy_into(*args).rows_loaded == 4
    assert copy_into(*args).rows_loaded == 0                      # re-run
    write_text(f"{land}/employees.csv", "ID,FirstName,Country,Role\n9,X,Y,Z\n")
    assert copy_into(*args).rows_loaded == 0                      # same path, new content
    write_text(f"{land}/employees2.csv", "ID,FirstName,Country,Role\n5,Maria,Brazil,Data Engineer\n"
               "6,Aiden,Australia,Data Analyst\n")
    assert copy_into(*args).rows_loaded == 2                      # new file
    assert read_loaded(spark, f"{tmp}/bronze").count() == 6


def test_schema_evolution_add_new_columns(spark, tmp):
    land = f"{tmp}/land"
    write_text(f"{land}/a/1.json", '{"id": 1, "v": "x"}\n{"id": 2, "v": "y"}\n')
    load_with_schema_evolution(spark, f"{land}/*", f"{tmp}/t", f"{tmp}/state", glob="*.json")
    write_text(f"{land}/b/2.json", '{"id": 3, "v": "z", "extra": 7}\n')
    res = load_with_schema_evolution(spark, f"{land}/*", f"{tmp}/t", f"{tmp}/state", glob="*.json")
    assert res.rows_loaded == 1
    out = {r["id"]: r["extra"] for r in
           spark.read.option("mergeSchema", True).parquet(f"{tmp}/t").collect()}
    assert out == {1: None, 2: None, 3: 7}


def test_old_files_late_columns_and_type_changes_are_kept(spark, tmp):
    land, args = f"{tmp}/land", (spark, f"{tmp}/land/*", f"{tmp}/t", f"{tmp}/state")
    write_text(f"{land}/a/1.json", '{"a": 1}\n')
    assert load_with_schema_evolution(*args).rows_loaded == 1
    write_text(f"{land}/b/2.json", '{"a": "text", "late": "00123"}\n{"a": 3, "n": {"x": 1.5}}\nnot json\n')
    age_files(spark, f"{land}/b", 400)
    assert load_with_schema_evolution(*args).rows_loaded == 3
    rows = sorted(read_loaded(spark, f"{tmp}/t").collect(), key=str)
    assert {r.late for r in rows} == {None, "00123"} and {r.n for r in rows} == {None, '{"x":1.5}'}
    kept = [r._rescued_data for r in rows if r._rescued_data]
    assert sorted(kept, key=str) == [{"_corrupt_record": "not json"}, {"a": "text"}]


def test_row_count_is_exact_beyond_the_retained_progress(spark, tmp):
    for i in range(8):
        write_text(f"{tmp}/land/{i}.csv", f"ID,FirstName,Country,Role\n{i},a,b,c\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        res = copy_into(spark, f"{tmp}/land", f"{tmp}/t", f"{tmp}/ck", "csv", EMP_SCHEMA,
                        {"maxFilesPerTrigger": 1})
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (res.rows_loaded, res.batches) == (8, 8) and read_loaded(spark, f"{tmp}/t").count() == 8


def test_multi_line_array_with_surplus_bracket(spark, tmp):
    write_text(f"{tmp}/land/e.json", '[\n {"id": 1, "t": "x"},\n {"id": 2,\n "t": "y"}\n]\n]\n')
    write_text(f"{tmp}/land/f.json", '{"id": 3,\n "t": "z"}')
    res = copy_into(spark, f"{tmp}/land", f"{tmp}/t", f"{tmp}/ck", "json", options={"multiLine": True})
    rows = read_loaded(spark, f"{tmp}/t").collect()
    assert res.rows_loaded == 3 and sorted((r.id, r.t) for r in rows) == [(1, "x"), (2, "y"), (3, "z")]


def test_header_order_and_surplus_columns(spark, tmp):
    write_text(f"{tmp}/c/a.csv", 'name,id,extra\n"Li, Jo",1,e1\nBo,x2,e2,more,most\n')
    write_text(f"{tmp}/c/b.csv", "id,name\n3,Al\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    rows = {r.name: r for r in rd.read_csv_rescued(spark, f"{tmp}/c", schema).collect()}
    assert rows["Li, Jo"].id == 1 and rows["Li, Jo"]._rescued_data == {"extra": "e1"}
    assert rows["Bo"].id is None and rows["Bo"]._rescued_data == {
        "id": "x2", "extra": "e2", "_extra_3": "more", "_extra_4": "most"}
    assert rows["Al"].id == 3 and rows["Al"]._rescued_data is None


def test_rescued_data_and_type_check(spark, tmp):
    write_text(f"{tmp}/c.csv", "ID,Name,Age\n101,Alice,Thirty\n102,Bob,30\n")
    schema = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("Name", T.StringType()),
                           T.StructField("Age", T.IntegerType())])
    rows = {r["ID"]: r for r in rd.read_csv_rescued(spark, f"{tmp}/c.csv", schema).collect()}
    assert rows[101]["Age"] is None and rows[101]["_rescued_data"] == {"Age": "Thirty"}
    assert rows[102]["Age"] == 30 and rows[102]["_rescued_data"] is None


def test_csv_inferred_tsv_preview_inventory_provenance(spark, tmp):
    write_text(f"{tmp}/d/e.csv", "ID,FirstName\n1,Kristi\n2,Sophia\n")
    df = rd.read_csv(spark, f"{tmp}/d")
    assert dict(df.dtypes)["ID"] == "int" and df.count() == 2
    write_text(f"{tmp}/t/part-0.tsv", "a\t1\nb\t2\n")
    prev = rd.read_tsv(spark, f"{tmp}/t/part-*").limit(1)
    assert prev.dtypes == [("_c0", "string"), ("_c1", "string")] and prev.count() == 1
    inv = rd.file_inventory(spark, tmp).collect()
    assert {os.path.basename(r["path"]) for r in inv} >= {"e.csv", "part-0.tsv"}
    prov = rd.with_provenance(rd.read_csv(spark, f"{tmp}/d")).first()
    assert prov["source_file"].endswith("e.csv") and prov["ingest_time"] is not None


def test_corrupt_record_column(spark, tmp):
    write_text(f"{tmp}/j.json", '{"a": 1}\n{"a": "oops"}\n')
    df = rd.read_json(spark, f"{tmp}/j.json", "a int, _corrupt string",
                      columnNameOfCorruptRecord="_corrupt")
    rows = sorted(df.collect(), key=lambda r: r["_corrupt"] or "")
    assert rows[0]["a"] == 1 and rows[1]["_corrupt"] == '{"a": "oops"}'


def test_catalog_sinks(spark, tmp):
    tb.use_schema(spark, "sinks_test")
    assert spark.catalog.currentDatabase() == "sinks_test"
    tb.create_empty_table(spark, "gold", "Role STRING, TotalEmployees INT",
                          location=f"{tmp}/gold", comment="roles",
                          properties={tb.GUARD_PROPERTY: "false"})
    assert tb.table_exists(spark, "gold")
    src = spark.createDataFrame([("A", 2), ("B", 1)], "Role string, TotalEmployees bigint")
    tb.insert_overwrite(spark, "gold", src)
    assert dict(spark.table("gold").dtypes)["TotalEmployees"] == "int"
    assert spark.table("gold").count() == 2
    with pytest.raises(Exception):
        tb.insert_overwrite(spark, "gold", spark.createDataFrame(
            [("C", 2 ** 40)], "Role string, TotalEmployees bigint"))
    with pytest.raises(tb.RefreshNotAllowed):
        tb.guarded_refresh(spark, "gold", src)
    tb.append_rows(spark, "gold", spark.createDataFrame([("D",)], "Role string"))
    assert spark.table("gold").filter("Role = 'D'").first()["TotalEmployees"] is None
    # CTAS: skip if exists, replace on request
    tb.create_table_as_select(spark, "emp", src)
    tb.create_table_as_select(spark, "emp", src.limit(1))
    assert spark.table("emp").count() == 2
    tb.create_table_as_select(spark, "emp", src.limit(1), replace=True)
    assert spark.table("emp").count() == 1
    assert tb.table_properties(spark, "gold")[tb.GUARD_PROPERTY] == "false"
    assert "emp" in [t.name for t in spark.catalog.listTables("sinks_test")]
    tb.drop_table(spark, "emp")
    assert not tb.table_exists(spark, "emp")
    spark.catalog.setCurrentDatabase("default")


def test_partitioned_write_dynamic_overwrite(spark, tmp):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int")
    tb.write_table(df, f"{tmp}/p", partition_by=["d"])
    tb.write_table(spark.createDataFrame([("2024-01-02", 9)], "d string, v int"), f"{tmp}/p",
                   partition_by=["d"])
    got = {str(r["d"]): r["v"] for r in spark.read.parquet(f"{tmp}/p").collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 9}


def test_publish_keeps_old_contents_on_failure(spark, tmp):
    from strata.operators.rules import apply_rules, expect_or_fail
    path = f"{tmp}/view"
    assert tb.publish(spark.createDataFrame([(1,)], "x int"), path).count() == 1
    bad = apply_rules(spark.createDataFrame([(None,)], "x int"),
                      [expect_or_fail("x_ok", "x IS NOT NULL")])
    with pytest.raises(Exception):
        tb.publish(bad, path)
    assert [r.x for r in tb.read_current(spark, path).collect()] == [1]
    for i in range(2, 5):
        tb.publish(spark.createDataFrame([(i,)], "x int"), path)
    assert [r.x for r in tb.read_current(spark, path).collect()] == [4]
    assert sorted(d for d in os.listdir(path) if not d.startswith(".")) == ["v=2", "v=3"]
    with pytest.raises(FileNotFoundError):
        tb.read_current(spark, f"{tmp}/none")


def test_landing_export_roundtrip(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    tb.export_landing(df, f"{tmp}/land", "json")
    assert rd.read_json(spark, f"{tmp}/land", "id int, s string").first()["s"] == "a"
    assert rd.read_any(spark, "json", f"{tmp}/land", "id int, s string").count() == 1


def test_schema_evolution_mode_none_ignores_new_columns(spark, tmp):
    land = f"{tmp}/land"
    write_text(f"{land}/a/1.json", '{"id": 1}\n')
    load_with_schema_evolution(spark, f"{land}/*", f"{tmp}/t", f"{tmp}/state", mode="none",
                               glob="*.json")
    write_text(f"{land}/b/2.json", '{"id": 2, "extra": 7}\n')
    load_with_schema_evolution(spark, f"{land}/*", f"{tmp}/t", f"{tmp}/state", mode="none",
                               glob="*.json")
    out = read_loaded(spark, f"{tmp}/t")
    assert out.columns == ["id", "_rescued_data"] and out.count() == 2
    assert out.filter("_rescued_data IS NOT NULL").count() == 0


def test_read_table_if_exists(spark):
    assert tb.read_table_if_exists(spark, "no_such_table_xyz") is None
    spark.range(2).createOrReplaceTempView("probe_view")
    assert tb.read_table_if_exists(spark, "probe_view").count() == 2
