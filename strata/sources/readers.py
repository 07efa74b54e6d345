"""File and table readers: CSV/TSV/JSON/Parquet scans, provenance columns,
directory inventory, rescued-data parsing and a JDBC extract.

All readers return lazy DataFrames; explicit schemas are preferred so that no
inference pass scans the data first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path
from strata.sinks.tables import materialize

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, header: bool = True, infer_schema: bool = True,
             sep: str = ",", schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Delimited text. ``infer_schema`` costs one extra pass; pass ``schema``
    for production loads."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer_schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = False) -> DataFrame:
    """Headerless tab-separated files; without a schema every column is a
    string (untyped preview)."""
    r = spark.read.option("sep", "\t").option("header", header)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multi_line: bool = False, **options) -> DataFrame:
    """JSON lines by default; ``multi_line=True`` for documents or a
    pretty-printed array (one value per file)."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.json(path)


def read_any(spark: SparkSession, fmt: str, path: str | None = None,
             schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Any built-in or installed source (parquet, json, csv, orc, xml, text,
    binaryFile; avro/kafka when their packages are on the classpath)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path is not None else r.load()


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel extract: ``num_partitions`` range queries on ``partition_column``."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties or {})


def with_provenance(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add ``source_file`` (from the hidden ``_metadata`` column of a file
    scan) and ``ingest_time``. Call directly on the scan's DataFrame."""
    return df.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "ingest_time": F.current_timestamp() if clock is None else clock,
    })


def file_inventory(spark: SparkSession, path: str, glob: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """``LIST dir``: path, size, modification time; contents are not read
    (only the selected metadata columns survive pruning)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def json_records(raw: DataFrame, multi_line: bool = False) -> DataFrame:
    """``value`` (text) -> ``value``, ``rec``: field -> text of every JSON
    record, null where unparsable. ``multi_line``: a value is a whole file that
    holds one object or one array of objects; text after the end of the value
    (a surplus bracket) is not part of it."""
    raw = raw.where(F.length(F.trim("value")) > 0)
    if multi_line:
        each = F.explode(F.transform(F.from_json("value", "array<variant>"), lambda v: F.to_json(v)))
        array = F.coalesce(F.ltrim("value").startswith("["), F.lit(False)) & F.from_json(
            "value", "array<variant>").isNotNull()
        raw = raw.where(array).select(each.alias("value")).union(raw.where(~array).select("value"))
    return raw.select("value", F.from_json("value", "map<string,string>").alias("rec"))


def quoted_records(raw: DataFrame, quote: str = '"', max_lines: int = 10_000) -> DataFrame:
    """``value`` (a line), ``file``, ``start`` (offset of the split) -> the same
    with whole records as values: lines between which a quote is open belong
    together. Doubled quotes cancel out, so a line keeps a quote open if it has an
    odd number of them.

    No file is read in one task: every split counts its quotes, a prefix sum of
    these parities over a file's splits (one row each) tells each split whether
    it starts inside a field, and so its lines can be cut by themselves. Lines at
    the start of a split that go on with a record join the last record begun in
    the splits before. A record of more than ``max_lines`` lines, which a quote
    that is never closed makes of the rest of a file, fails the read and names
    the file."""
    # numbered once: every pass below must see the same order
    lines = materialize(raw.select("value", "file", "start", F.monotonically_increasing_id().alias("at")),
                        scratch_path(raw.sparkSession, "csv-lines"))
    lines = lines.withColumn("odd", F.pmod(F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit(""))), F.lit(2)))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = lines.groupBy("file", "start").agg(F.sum("odd").alias("odd"))
    splits = splits.select("file", "start", before("odd", Window.partitionBy("file").orderBy("start")).alias("carried"))
    # a split's lines: at most spark.sql.files.maxPartitionBytes of text
    split = Window.partitionBy("file", "start").orderBy("at")
    lines = lines.join(splits, ["file", "start"]).withColumn("open", F.pmod(F.col("carried") + before("odd", split), F.lit(2)))
    place = F.struct("start", "at")
    lines = lines.withColumn("begun", F.max(F.when(F.col("open") == 0, place)).over(
        split.rowsBetween(Window.unboundedPreceding, 0)))
    alone = lines.where("open = 0 AND odd = 0").select("value", "file", "start", "at")
    parts = lines.where("NOT (open = 0 AND odd = 0) AND NOT (open = 1 AND value IS NULL)")
    ends = parts.groupBy("file", "start").agg(F.max("begun").alias("last"))
    ends = ends.select("file", "start", F.max("last").over(Window.partitionBy("file").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1)).alias("from_before"))
    parts = parts.join(ends, ["file", "start"]).withColumn("record", F.coalesce("begun", "from_before"))
    long = parts.groupBy("file", "record").count().where(F.col("count") > max_lines).limit(1).collect()
    if long:
        raise ValueError(f"{long[0].file}: a quote opened in the split at {long[0].record.start} is not closed "
                         f"within {max_lines} lines")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", "value"))), lambda x: x["value"]), "\n")
    whole = parts.groupBy("file", "record").agg(text.alias("value")).select(
        "value", "file", F.col("record.start").alias("start"), F.col("record.at").alias("at"))
    return alone.unionByName(whole).withColumn("value", F.regexp_replace("value", "\r$", ""))


def csv_records(raw: DataFrame, sep: str = ",", header: bool = True,
                names: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """``value``, ``file``, ``start`` (offset of the split) -> ``value``,
    ``rec``: column -> text of every line, by the header of its own file or, for
    headerless files, by ``names``. Surplus columns are ``_extra_<n>``. Files
    with one layout are parsed together: one plan branch per distinct header.
    ``multi_line``: quoted fields may hold line breaks; a quote inside a field is
    doubled."""
    lines = quoted_records(raw) if multi_line else raw.select(
        "value", "file", "start", F.monotonically_increasing_id().alias("at"))
    width = F.max(F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit("")))).alias("seps")
    if header:
        heads = lines.where("start = 0").groupBy("file").agg(F.min(F.struct("at", "value")).alias("h")).select(
            "file", F.col("h.at").alias("head_at"), F.col("h.value").alias("head"))
        rows = lines.join(heads, "file").where("at <> head_at")
    else:
        rows = lines.withColumn("head", F.lit(sep.join(names or [])))
    rows = rows.where(F.length(F.trim("value")) > 0)
    out = raw.select("value", F.lit(None).cast("map<string,string>").alias("rec")).where("false")
    for r in rows.groupBy("head").agg(width).collect():       # one row per layout
        cols: list[str] = []
        for c in (r.head.split(sep) if r.head else []):
            c = c.strip().strip('"')
            cols.append(c if c not in cols else f"{c}_{len(cols)}")
        cols += [f"_extra_{i}" for i in range(len(cols), max(len(cols), r.seps * len(sep) + 1))]
        row = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(cols))),
                         {"sep": sep} | ({"escape": '"', "multiLine": "true"} if multi_line else {}))
        part = rows.where(F.col("head") == r.head).withColumn("_row", row)
        pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                  F.array(*[F.col(f"_row.c{i}") for i in range(len(cols))]))
        out = out.unionByName(part.select("value", F.map_filter(
            pairs, lambda k, v: v.isNotNull() | ~k.startswith("_extra_")).alias("rec")))
    return out


def rescue_fields(records: DataFrame, schema: T.StructType, keep_unknown: bool = True) -> DataFrame:
    """``rec`` (field -> text) to typed columns; what does not fit — failed
    casts, fields outside the schema, unparsable records — stays, as text, in
    ``_rescued_data`` (NULL when clean)."""
    rec, typed, bad = F.col("rec"), [], []
    for f in schema.fields:
        src = F.element_at(rec, f.name)
        if isinstance(f.dataType, T.StringType):
            val = src
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            val = F.from_json(src, f.dataType)
        else:
            val = src.try_cast(f.dataType)
        typed.append(val.alias(f.name))
        bad.append(F.when(src.isNotNull() & val.isNull(), F.lit(f.name)))
    failed = F.array_compact(F.array(*bad, F.lit(None).cast("string")))
    unknown = lambda k, v: v.isNotNull() & ~k.isin(schema.names) if schema.names else v.isNotNull()
    keep = F.map_filter(rec, lambda k, v: F.array_contains(failed, k) | (
        unknown(k, v) if keep_unknown else k == CORRUPT))
    return records.select(*typed, F.when(F.size(keep) > 0, keep).alias(RESCUED))


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType,
                     header: bool = True, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Typed CSV load that never loses a value: columns are matched by header
    name (by position without a header); values that fail their cast and
    surplus columns are kept in ``_rescued_data``."""
    raw = spark.read.text(path, lineSep="\n" if multi_line else None).select("value", F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("start"))
    return rescue_fields(csv_records(raw, sep, header, schema.names, multi_line), schema)
