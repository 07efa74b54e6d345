"""Operator 8: removal of long word spans that an earlier document has.

A window is ``WINDOW`` consecutive words; it goes when a document with a
smaller doc_id has the same window. Windows are too many to shuffle, so the
De Bruijn graph of the corpus would be too; minimiser runs stand in for its
compacted paths, and no edge between k-mers is ever joined:

* **k-mers and paths.** Of the ``WINDOW - K + 1`` k-mers in a window the least
  hash stands for it. Consecutive windows with the same k-mer occurrence are one
  nonbranching path: its k-mer, its words and its windows are one row, about
  one for twenty words.
* **Compaction by aggregation and joins.** Paths with equal k-mer and words
  are one edge; partial aggregation keeps its least and greatest document. A
  k-mer with one edge does not branch: all its windows have the edge's least
  document as source.
* **Branches.** Only where one k-mer has several edges are single windows
  looked at, once per distinct edge rather than per occurrence: the least
  document over all edges that contain the window (k-mer and window hash, 128
  bits together).
* **Source coordinates.** Every occurrence then joins its edge's sources; those
  with a smaller id than its document give the spans to remove, with the
  source document of each.

A passage in a third of all documents is one edge or one window group, which is
aggregated before it is shuffled; joins on it may be split. No pairs of
documents are ever formed and nothing is capped.

Defined results: a null text has no words; texts of any length are cut into
windows whole. Null ids count as greater than
all: such a row is never a source, not even for other null ids. Rows repeated
with the same id are judged alike and are no source for each other. Texts under
``WINDOW`` words keep all. Empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (U, arrow_texts, discard, doc_chunks, mix, powers, store, word_hashes,
                               window_hashes, word_spans)

WINDOW = 50
K = 10
BASE, BASE_K, BASE_P = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F
CHUNK = 2 << 20
LAST = (1 << 63) - 1          # rank of a null doc_id
PLACE = U((1 << 24) - 1)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each run of ``n`` values, by doubling."""
    step = 1
    while 2 * step <= n:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = n - step
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def range_hashes(wh: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start..end-1 for arrays of ranges."""
    with np.errstate(over="ignore"):
        pre = np.concatenate((np.zeros(1, U), np.cumsum(wh * powers(BASE_P, len(wh)), dtype=U)))
        back = powers(pow(BASE_P, -1, 1 << 64), len(wh) + 1)
        return mix((pre[end] - pre[start]) * back[start] ^ mix((end - start).astype(U)))


def paths(buf: np.ndarray, offsets: np.ndarray, window: int, k: int):
    """Of a chunk: document, k-mer hash, path hash, first window, windows (all
    arrays; first windows count words from the document's start)."""
    starts, ends, first = word_spans(buf, offsets)
    wh = word_hashes(buf, starts, ends, BASE)
    if len(wh) < window:
        return (np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
    kh = window_hashes(wh, k, BASE_K)
    at = np.arange(len(kh), dtype=U)
    least = sliding_min((kh & ~PLACE) | (at & PLACE), window - k + 1)
    i = np.arange(len(least))
    p = i + ((least - at[:len(least)]) & PLACE).astype(np.int64)      # of ties the leftmost
    doc = np.searchsorted(first, i, "right") - 1
    ok = i + window <= first[doc + 1]
    i, p, doc = i[ok], p[ok], doc[ok]
    if not len(i):
        return doc, np.zeros(0, U), np.zeros(0, U), i, i
    new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (doc[1:] != doc[:-1]))))
    n = np.diff(np.concatenate((new, [len(i)])))
    s0, p, doc = i[new], p[new], doc[new]
    body = range_hashes(wh, s0, s0 + n - 1 + window)
    with np.errstate(over="ignore"):
        body = mix(body ^ mix((p - s0).astype(U) * U(1 << 20) + n.astype(U)))
    return doc, kh[p], body, s0 - first[doc], n


def _occurrences(docs: DataFrame, window: int, k: int) -> DataFrame:
    def emit(batches):
        import pyarrow as pa

        for b in batches:
            buf, off = arrow_texts(b.column(2))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            keys = b.column(1).to_numpy(zero_copy_only=False)
            for i, j in doc_chunks(off, CHUNK):
                d, m, e, s0, n = paths(buf[off[i]:off[j]], off[i:j + 1] - off[i], window, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i + d]), pa.array(keys[i + d]), pa.array(m.view(np.int64)), pa.array(e.view(np.int64)),
                     pa.array(s0, pa.int32()), pa.array(n, pa.int32())], ["rank", "t", "kmer", "edge", "s0", "n"])

    return docs.mapInArrow(emit, "rank long, t long, kmer long, edge long, s0 int, n int")


def _windows(found: DataFrame, window: int) -> DataFrame:
    """kmer, edge, j, hash, least of every window of the listed paths.

    ``found``: text, at (array of kmer, edge, s0, n, least)."""
    def emit(batches):
        import pyarrow as pa

        for b in batches:
            buf, off = arrow_texts(b.column(0))
            lists = b.column(1)
            for i, j in doc_chunks(off, CHUNK):
                starts, ends, first = word_spans(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                wh = word_hashes(buf[off[i]:off[j]], starts, ends, BASE)
                per = lists.slice(i, j - i)
                x = per.flatten()
                if not len(x):
                    continue
                doc = np.repeat(np.arange(j - i), per.value_lengths().to_numpy(zero_copy_only=False).astype(int))
                col = {f: x.field(q).to_numpy(zero_copy_only=False) for q, f in enumerate(("kmer", "edge", "s0", "n", "least"))}
                n = col["n"].astype(np.int64)
                pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = np.repeat(first[doc] + col["s0"], n) + pos
                h = range_hashes(wh, s, s + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(col["kmer"], n)), pa.array(np.repeat(col["edge"], n)), pa.array(pos, pa.int32()),
                     pa.array(h.view(np.int64)), pa.array(np.repeat(col["least"], n))],
                    ["kmer", "edge", "j", "hash", "least"])

    return found.select("text", "at").mapInArrow(emit, "kmer long, edge long, j int, hash long, least long")


def sources(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """rank, t, at: per document row with something to remove, its paths as
    (s0, n, least, sources): the least document of every window, or of all.

    ``docs``: rank, t (text key), text."""
    spark = docs.sparkSession
    occ = store(_occurrences(docs, window, k), "debruijn-paths")
    edges = occ.groupBy("kmer", "edge").agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
    per = edges.groupBy("kmer").agg(F.count(F.lit(1)).alias("edges"), F.min("least").alias("lo"),
                                    F.max("most").alias("hi")).where("lo < hi")   # in two documents
    edges = store(edges.join(per.select("kmer", "edges"), "kmer").select(
        "kmer", "edge", "least", "most", (F.col("edges") > 1).alias("branch")), "debruijn-edges")
    branch = edges.where("branch").select("kmer", "edge", "least")
    # one occurrence of each branching edge, in its least document
    one = occ.join(branch, ["kmer", "edge"]).where("rank = least").groupBy("kmer", "edge", "least").agg(
        F.min(F.struct("rank", "t", "s0", "n")).alias("o"))
    listed = one.groupBy(F.col("o.rank").alias("rank"), F.col("o.t").alias("t")).agg(
        F.collect_list(F.struct("kmer", "edge", F.col("o.s0").alias("s0"), F.col("o.n").alias("n"), "least")).alias("at"))
    texts = docs.join(listed, ["rank", "t"]).select("rank", "t", "text", "at").dropDuplicates(["rank", "t"])
    win = store(_windows(texts, window), "debruijn-windows")
    best = win.groupBy("kmer", "hash").agg(F.min("least").alias("src"))
    branched = (win.join(best, ["kmer", "hash"]).groupBy("kmer", "edge")
                .agg(F.array_sort(F.collect_list(F.struct("j", "src"))).alias("w"))
                .select("kmer", "edge", F.transform("w", lambda x: x["src"]).alias("sources")))
    none = F.lit(None).cast("array<long>")
    plain = edges.where("not branch and least < most")
    info = plain.select("kmer", "edge", "least", none.alias("sources")).union(
        branched.select("kmer", "edge", F.array_min("sources").alias("least"), "sources"))
    hit = occ.join(info, ["kmer", "edge"]).where("least < rank")
    out = store(hit.groupBy("rank", "t").agg(F.collect_set(F.struct("s0", "n", "least", "sources")).alias("at")),
                "debruijn-hits")
    discard(spark, occ, edges, win)
    return out


def deduplicate(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, end, source in words), kept_text:
    one row per document."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("rank"),
                       F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text"))
    found = sources(rows.select("rank", "t", "text"), window, k)

    def cut(batches):
        import pyarrow as pa

        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64())])
        for b in batches:
            buf, off = arrow_texts(b.column(2))
            raw = buf.tobytes()
            hits = b.column(3)
            n_words, n_removed, spans, kept = [], [], [], []
            for d in range(b.num_rows):
                words = raw[off[d]:off[d + 1]].split()
                rank = b.column(1)[d].as_py()
                n = len(words)
                out = []
                if hits[d].is_valid:
                    for h in hits[d].as_py():
                        src = h["sources"] or [h["least"]] * h["n"]
                        out += [(h["s0"] + j, s) for j, s in enumerate(src) if s < rank]
                if out:
                    src_of = np.full(n, LAST)
                    for a, s in out:
                        np.minimum(src_of[a:a + window], s, out=src_of[a:a + window])
                    gone = src_of < LAST
                    edge = np.flatnonzero(np.concatenate(([True], src_of[1:] != src_of[:-1], [True])))
                    spans.append([(int(a), int(z), int(src_of[a])) for a, z in zip(edge[:-1], edge[1:]) if gone[a]])
                    words = [w for w, g in zip(words, gone) if not g]
                else:
                    spans.append([])
                n_words.append(n)
                n_removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([[dict(zip(("start", "end", "source"), s)) for s in x] for x in spans], pa.list_(span)),
                 pa.array([x.decode() for x in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return rows.join(found, ["rank", "t"], "left").select("doc_id", "rank", "text", "at").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, "
             "spans array<struct<start:long,end:long,source:long>>, kept_text string")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return deduplicate(docs, window).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
