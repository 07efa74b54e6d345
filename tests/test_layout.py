"""Clustered files: how many a filter on each column has to open."""

from pyspark.sql import functions as F

from strata.sinks.layout import files_for, interleaved, write_clustered
from strata.sinks import tables as tb


def test_filters_on_either_column_skip_most_files(spark, tmp):
    df = spark.range(40_000).select(F.pmod(F.hash("id"), F.lit(1000)).cast("double").alias("a"),
                                    F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("t0"),
                                    F.pmod(F.hash(F.col("id") + 7), F.lit(1000)).alias("b"), "id")
    df = df.withColumn("t", F.expr("t0 + make_interval(0, 0, 0, cast(b as int))")).drop("t0")
    write_clustered(df, f"{tmp}/z", ["a", "t"], 64)
    df.repartitionByRange(16, "a").sortWithinPartitions("a").write.parquet(f"{tmp}/sorted")
    z, plain = spark.read.parquet(f"{tmp}/z"), spark.read.parquet(f"{tmp}/sorted")
    assert z.count() == 40_000 and z.exceptAll(df.select(*z.columns)).count() == 0
    a = "max_a >= 500 AND min_a <= 510"
    t = "max_t >= timestamp_ntz'2025-06-01 00:00:00' AND min_t <= timestamp_ntz'2025-06-10 00:00:00'"
    for cond in (a, t):
        read, files = files_for(z, cond, ["a", "t"])
        assert files >= 55 and read <= files // 2, (cond, read, files)
    read, files = files_for(plain, t, ["a", "t"])
    assert read == files                                       # a plain sort helps its first column only


def test_key_of_empty_and_null_columns(spark, tmp):
    df = spark.createDataFrame([(None, 1), (2.0, None), (None, None)], "a double, b int")
    assert df.select(interleaved(df, ["a", "b"]).alias("z")).where("z is null").count() == 0
    write_clustered(df.where("false"), f"{tmp}/none", ["a", "b"], 4)
    assert spark.read.schema(df.schema).parquet(f"{tmp}/none").count() == 0


def test_replacing_a_table_at_a_location(spark, tmp):
    name = "replaced_at_location"
    one, two = spark.range(3), spark.range(5)
    tb.create_table_as_select(spark, name, one, location=f"{tmp}/t")
    tb.create_table_as_select(spark, name, two, location=f"{tmp}/t")
    assert spark.table(name).count() == 3
    try:
        tb.create_table_as_select(spark, name, two.withColumn("id", F.raise_error(F.lit("no")).cast("bigint")),
                                  replace=True, location=f"{tmp}/t")
        raise AssertionError("must fail")
    except Exception as e:
        assert "must fail" not in str(e)
    assert spark.table(name).count() == 3
    tb.create_table_as_select(spark, name, two, replace=True, location=f"{tmp}/t", comment="second")
    assert spark.table(name).count() == 5
    tb.drop_table(spark, name)
