"""Incremental, loss-free file ingestion on the file stream source.

A load is a ``trigger(availableNow=True)`` stream of raw text records: it takes
every file whose path the checkpoint does not know, whatever its age, commits
and stops. A re-run loads 0 rows, a new file is loaded once, and a file
rewritten in place is not loaded again.

Within each micro-batch a record becomes a map of field name to text (JSON
lines or arrays; CSV by the header of its own file). Known fields are cast to
the table's types. What does not fit goes, as text, to ``_rescued_data``: failed
casts, surplus fields (unless the mode adds them) and unparsable records. With
``addNewColumns`` a batch with unknown fields widens the stored schema before
it is written, so no file is inspected ahead of its load and none is missed.

A batch is written to ``target/_batch_id=<n>``, which a replay overwrites with
the same rows; the rows it wrote are counted on that write.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.readers import CORRUPT, RESCUED, csv_records, json_records, rescue_fields

BATCH = "_batch_id"
ANY_AGE = "36500d"


@dataclass
class LoadResult:
    rows_loaded: int
    batches: int


def stream_files(spark: SparkSession, source: str, fmt: str, schema: T.StructType,
                 options: dict | None = None) -> DataFrame:
    """Files as a stream, old ones included (the source skips week-old files
    unless told otherwise)."""
    r = spark.readStream.format(fmt).schema(schema).option("maxFileAge", ANY_AGE)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(source)


# ------------------------------------------------------------ schemas

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``prefix<n>``; a missing path has none,
    any other failure is raised."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix)
                  and fs.exists(hadoop(f"{path}/{n}/_SUCCESS")))


def load_schema(spark: SparkSession, state: str) -> T.StructType | None:
    have = _numbered(spark, f"{state}/schemas", "v")
    if not have:
        return None
    rows = spark.read.text(f"{state}/schemas/v{have[-1]}", wholetext=True).collect()
    return T.StructType.fromJson(json.loads("".join(r[0] for r in rows)))


def save_schema(spark: SparkSession, state: str, schema: T.StructType) -> None:
    n = (_numbered(spark, f"{state}/schemas", "v") or [-1])[-1] + 1
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{state}/schemas/v{n}")


def widen(saved: T.StructType | None, found: T.StructType) -> T.StructType:
    """``addNewColumns``: keep every saved field and type, append new fields."""
    if saved is None:
        return found
    names = {f.name for f in saved.fields}
    extra = [T.StructField(f.name, f.dataType, True) for f in found.fields if f.name not in names]
    return T.StructType(list(saved.fields) + extra)


def infer_text(records: DataFrame, known: list[str]) -> T.StructType:
    """Types of the fields outside ``known``, from every record of the batch,
    by one aggregate per field (no sampling)."""
    pairs = records.where("rec is not null").select(F.explode("rec").alias("k", "v")).where(
        ~F.col("k").isin(known) if known else F.lit(True))
    fits = lambda t: F.bool_and(F.col("v").isNull() | F.col("v").try_cast(t).isNotNull())
    typed = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    rows = pairs.groupBy("k").agg(*[fits(t).alias(t) for t in typed],
                                  F.count("v").alias("n")).orderBy("k").collect()   # one per field
    kind = lambda r: next((typed[t] for t in typed if r.n and r[t]), T.StringType())
    return T.StructType([T.StructField(r.k, kind(r)) for r in rows])


# ------------------------------------------------------------ loads

def copy_into(spark: SparkSession, source: str, target: str, checkpoint: str, fmt: str,
              schema: T.StructType | None = None, options: dict | None = None, transform=None,
              partition_by: list[str] | None = None, mode: str = "rescue",
              glob: str | None = None) -> LoadResult:
    """Idempotent incremental load of JSON or CSV files (``COPY INTO``): files
    already loaded are skipped; returns the rows this call wrote.

    ``schema``: the table's columns; inferred from the first batch when absent.
    ``mode``: what happens to fields outside the schema — ``rescue`` (kept in
    ``_rescued_data``), ``addNewColumns`` or ``none`` (dropped). The option
    ``multiLine`` reads a JSON file as one value, and CSV fields with line breaks.
    """
    options = dict(options or {})
    multi_line = str(options.pop("multiLine", False)).lower() == "true"
    sep = options.pop("sep", ",")
    header = str(options.pop("header", True)).lower() == "true"
    if multi_line:
        options |= {"wholetext": True} if fmt == "json" else {"lineSep": "\n"}
    if glob:
        options["pathGlobFilter"] = glob
    raw = stream_files(spark, source, "text", T.StructType([T.StructField("value", T.StringType())]), options)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"))
    state = f"{checkpoint}/_table"
    wrote: dict[int, int] = {}

    def one(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        recs = json_records(batch, multi_line) if fmt == "json" else csv_records(
            batch, sep, header, schema.names if schema is not None else None, multi_line)
        have = load_schema(session, state) or schema
        now = have
        if now is None or mode == "addNewColumns":
            now = widen(now, infer_json(recs, now) if fmt == "json" else
                        infer_text(recs, now.names if now else []))
        if now != load_schema(session, state):
            save_schema(session, state, now)
        rec = F.coalesce("rec", F.create_map(F.lit(CORRUPT), F.col("value")))
        out = rescue_fields(recs.select(rec.alias("rec")), now, keep_unknown=mode != "none")
        if transform is not None:
            out = transform(out)
        seen = Observation(f"load_{batch_id}_{id(out)}")
        w = out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.option("partitionOverwriteMode", "static").parquet(f"{target}/{BATCH}={batch_id}")
        wrote[batch_id] = seen.get["n"]

    q = (raw.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(one).start())
    q.awaitTermination()
    return LoadResult(sum(wrote.values()), sum(1 for n in wrote.values() if n))


def infer_json(records: DataFrame, known: T.StructType | None) -> T.StructType:
    """Types of unknown JSON fields from the values as written: a quoted number
    stays text, whole numbers are bigint, other numbers double; fields with
    values of several kinds, and nested values, are text."""
    names = known.names if known else []
    one = records.where("rec is not null")
    keys = one.select(F.explode(F.map_keys("rec")).alias("k"))
    keys = keys.where(~F.col("k").isin(names)) if names else keys
    rows = keys.distinct().orderBy("k").collect()              # one per field
    if not rows:
        return T.StructType([])
    v = F.try_parse_json(F.col("value"))
    kinds = one.select(v.alias("v")).agg(F.schema_of_variant_agg("v").alias("s")).first().s or ""
    if kinds.startswith("ARRAY<"):
        kinds = kinds[len("ARRAY<"):-1]
    found = dict(top_fields(kinds))
    return T.StructType([T.StructField(r.k, found.get(r.k, T.StringType())) for r in rows])


def top_fields(described: str) -> list[tuple[str, T.DataType]]:
    """(name, type) of the fields in ``OBJECT<a: BIGINT, ...>``."""
    body = described[len("OBJECT<"):-1] if described.startswith("OBJECT<") else ""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(body):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append(body[start:i])
            start = i + 1
    parts.append(body[start:])
    out = []
    for p in parts:
        if ": " in p:
            name, kind = p.strip().split(": ", 1)
            number = re.match(r"DECIMAL|DOUBLE|FLOAT", kind)
            out.append((name.strip("`"), T.DoubleType() if number else
                        {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType()}.get(kind, T.StringType())))
    return out


def load_with_schema_evolution(spark: SparkSession, source: str, target: str, state: str,
                               fmt: str = "json", mode: str = "addNewColumns",
                               base_schema: T.StructType | None = None, glob: str | None = None,
                               options: dict | None = None) -> LoadResult:
    """Incremental load whose schema grows with new columns in new files."""
    return copy_into(spark, source, target, f"{state}/checkpoint", fmt, base_schema, options,
                     mode=mode, glob=glob)


def age_files(spark: SparkSession, path: str, days: int) -> None:
    """Set the files directly under ``path`` back by ``days`` (drops that reach
    the landing zone with an old date)."""
    fs, p = _fs(spark, path)
    for f in fs.listStatus(p):
        if f.isFile():
            fs.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """The loaded table: all batches, columns of every schema version."""
    return spark.read.option("mergeSchema", True).parquet(target).drop(BATCH)
