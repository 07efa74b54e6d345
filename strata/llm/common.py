"""Helpers shared by the training-text operators: shared-folder tables, free
column names, one-row-per-text selection and vectorised word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: ASCII white space as the contracts list it: space and U+0009..U+000D.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def store(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts
    lineage, and a lost executor does not lose the rows."""
    spark = df.sparkSession
    path = path or scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the folders of stored tables that no later plan reads."""
    jvm = spark._jvm
    for df in frames:
        for d in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(d)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"{n}_{uuid.uuid4().hex[:6]}"
        taken.add(n.lower())
        out.append(n)
    return out


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, WHITE_RUN), "")


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits of a text as two longs (two seeds of one hash)."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def keep_rows(docs: DataFrame, keep: DataFrame, key: Callable[[], Column]) -> DataFrame:
    """Rows of ``docs`` named by ``keep`` (columns ``k_id`` and ``k_text``, no
    two rows alike), where ``key()`` computes ``k_text`` from a document. Of
    rows tied on both (repeated rows) one stays. Columns are those of ``docs``.
    """
    (kt,) = fresh(docs, "k_text_of_row")
    tagged = docs.withColumn(kt, key())
    k = keep.select(F.col("k_id").alias("__k_id"), F.col("k_text").alias("__k_text"))
    kept = tagged.join(k, F.col("doc_id").eqNullSafe(F.col("__k_id"))
                       & (F.col(kt) == F.col("__k_text")), "left_semi")
    repeated = (tagged.select("doc_id", kt).groupBy("doc_id", kt).count().where("count > 1"))
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", kt])
    return kept.select(*docs.columns)


def spread(df: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Repeat each row ``n`` times with a copy number ``copy_no`` from 1, in
    blocks, so that no row ever holds one huge array."""
    block = 10_000
    return (df.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.expr(f"({n} - 1) div {block}"))))
            .withColumn("copy_no", F.explode(F.sequence(
                F.col("__b") * block + 1, F.least((F.col("__b") + 1) * block, F.col(n)))))
            .select(*keys, "copy_no"))


# --- vectorised words and hashes over UTF-8 buffers ------------------------

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
U = np.uint64
_POW: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept and grown per process)."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            a = np.full(max(n, 4096), base, U)
            a[0] = 1
            have = _POW[base] = np.cumprod(a, dtype=U)
    return have[:n]


def arrow_texts(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls count as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def doc_chunks(offsets: np.ndarray, limit: int):
    """Ranges (i, j) of documents of at most ``limit`` bytes, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the index of
    its first word (one more entry than documents)."""
    ns = ~_WS[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    first = first[:len(buf)]
    before = np.empty(len(buf), bool)
    after = np.empty(len(buf), bool)
    if len(buf):
        before[0], before[1:] = True, ~ns[:-1]
        after[-1], after[:-1] = True, ~ns[1:] | first[1:]
    starts = np.flatnonzero(ns & (before | first))
    ends = np.flatnonzero(ns & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int,
                block: int = 1 << 21) -> np.ndarray:
    """64-bit hash of each word, ``block`` bytes at a time."""
    lens = ends - starts
    cum = np.concatenate(([0], np.cumsum(lens)))
    out = np.empty(len(starts), U)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(cum, cum[i] + block, "right")) - 1)
            at = cum[i:j] - cum[i]
            pos = np.arange(cum[j] - cum[i]) - np.repeat(at, lens[i:j])
            byte = buf[np.repeat(starts[i:j], lens[i:j]) + pos].astype(U) + U(1)
            out[i:j] = np.add.reduceat(byte * powers(base, int(lens[i:j].max()))[pos], at)
            i = j
        return mix(out ^ lens.astype(U))


def window_hashes(wh: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(wh) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        if k <= 8:
            h = np.zeros(n, U)
            for j, p in enumerate(powers(base, k)):
                h += wh[j:j + n] * p
        else:  # differences of prefix sums, moved back to exponent 0
            pre = np.concatenate((np.zeros(1, U), np.cumsum(wh * powers(base, len(wh)), dtype=U)))
            h = (pre[k:] - pre[:-k]) * powers(pow(base, -1, 1 << 64), n)
        return mix(h)
