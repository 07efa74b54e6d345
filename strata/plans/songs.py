"""Song catalogue: headerless TSV landing -> prepared (renamed, pruned,
warn rules from SQL constraint clauses) -> top artists per year.

The test tables carry no songs, so a song file is derived from ``orders``
joined to ``customer`` (artist = customer, one song per order, release year =
order year, year 0 = unknown for the lowest priority) and landed as TSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.rules import Rule, apply_rules
from strata.plans.registry import query
from strata.session import scratch_path
from strata.sinks.tables import export_landing
from strata.sources.readers import read_tsv
from strata.sources.tables import read_table

SONG_SCHEMA = T.StructType([
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_lat", T.DoubleType()),
    T.StructField("artist_long", T.DoubleType()),
    T.StructField("artist_location", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("end_of_fade_in", T.DoubleType()),
    T.StructField("key", T.IntegerType()),
    T.StructField("key_confidence", T.DoubleType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("release", T.StringType()),
    T.StructField("song_hotnes", T.DoubleType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("start_of_fade_out", T.DoubleType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("time_signature", T.DoubleType()),
    T.StructField("time_signature_confidence", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("partial_sequence", T.IntegerType()),
])

SONG_RULES = [Rule.from_sql(t) for t in (
    "CONSTRAINT valid_artist_name EXPECT (artist_name IS NOT NULL)",
    "CONSTRAINT valid_title EXPECT (song_title IS NOT NULL)",
    "CONSTRAINT valid_duration EXPECT (duration > 0)",
)]

PREPARED_COLUMNS = ["artist_id", "artist_name", "duration", "release", "tempo",
                    "time_signature", "song_title", "year"]


def songs_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o, c = orders, customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    duration = F.col("o_totalprice") / 1000.0
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.lit("AR"), F.col("c_custkey").cast("string")).alias("artist_id"),
        (F.col("c_acctbal") / 100.0).alias("artist_lat"),
        F.col("c_nationkey").cast("double").alias("artist_long"),
        F.col("c_mktsegment").alias("artist_location"),
        F.col("c_name").alias("artist_name"),
        duration.alias("duration"),
        F.lit(0.5).alias("end_of_fade_in"),
        (F.month("o_orderdate") - 1).alias("key"),
        F.lit(0.5).alias("key_confidence"),
        F.lit(-10.0).alias("loudness"),
        F.col("o_orderpriority").alias("release"),
        F.lit(0.5).alias("song_hotnes"),
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("song_id"),
        (duration - 1.0).alias("start_of_fade_out"),
        F.lit(120.0).alias("tempo"),
        F.lit(4.0).alias("time_signature"),
        F.lit(1.0).alias("time_signature_confidence"),
        F.concat(F.lit("Song "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0))
         .otherwise(F.year("o_orderdate")).alias("year"),
        F.lit(0).alias("partial_sequence"),
    )


def songs_raw(spark: SparkSession, landing: str) -> DataFrame:
    return read_tsv(spark, landing, SONG_SCHEMA)


def songs_prepared(raw: DataFrame) -> DataFrame:
    shaped = raw.withColumnRenamed("title", "song_title").select(*PREPARED_COLUMNS)
    return apply_rules(shaped, SONG_RULES, dataset="songs_prepared")


def top_artists_by_year(prepared: DataFrame) -> DataFrame:
    return (prepared.filter(F.col("year") > 0)
            .groupBy("artist_name", "year")
            .agg(F.count(F.lit(1)).alias("total_number_of_songs"))
            .orderBy(F.desc("total_number_of_songs"), F.desc("year"), F.asc("artist_name")))


def land_songs(spark: SparkSession, sf_dir: str) -> str:
    landing = scratch_path(spark, "songs-landing")
    songs = songs_from_orders(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))
    export_landing(songs, landing, "csv", sep="\t", header=False)
    return landing


_SONGS_SQL = """
WITH songs AS (
  SELECT 'AR' || CAST(c.c_custkey AS VARCHAR) AS artist_id, c.c_name AS artist_name,
         o.o_totalprice / 1000.0 AS duration, o.o_orderpriority AS release,
         120.0::DOUBLE AS tempo, 4.0::DOUBLE AS time_signature,
         'Song ' || CAST(o.o_orderkey AS VARCHAR) AS song_title,
         CAST(CASE WHEN o.o_orderpriority = '5-LOW' THEN 0 ELSE year(o.o_orderdate) END AS INTEGER) AS year
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
"""


@query("tsv_songs_prepared", _SONGS_SQL + "SELECT * FROM songs")
def q_songs_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs_prepared(songs_raw(spark, land_songs(spark, sf_dir)))


@query("top_artists_by_year", _SONGS_SQL + """
SELECT artist_name, year, COUNT(*) AS total_number_of_songs FROM songs
WHERE year > 0 GROUP BY artist_name, year
ORDER BY total_number_of_songs DESC, year DESC, artist_name
""")
def q_top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_artists_by_year(songs_prepared(songs_raw(spark, land_songs(spark, sf_dir))))
