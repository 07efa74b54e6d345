"""Operator 1: near-duplicate classes by consistent weighted sampling.

* **Weights.** A document is the bag of its five-word shingles (a text of one
  to four words is one shingle), hashed from its UTF-8 bytes. Weight =
  (1 + ln tf) * idf. Document frequencies are counted over all documents in
  2**18 hashed counters; a shingle is rare, idf 1, below the share ``RARE`` of
  documents. From there idf falls with ln(1/share) to ``IDF_FLOOR`` at share 1,
  so boilerplate counts for less, but a group of copies that makes up a third
  of the corpus does not lose its own links.
* **Sampling.** Improved consistent weighted sampling: of each document
  ``SAMPLES`` (shingle, t) pairs with the least ln a = ln c - r (t - beta) - r,
  t = floor(ln w / r + beta). r and c (Gamma(2, 1)) and beta (uniform) come from
  fixed tables, picked by two separate slices of the shingle's hash.
* **Bands** of ``ROWS`` samples; documents that share a band are candidates. A
  pair at similarity 0.8 is missed by all bands with probability 2e-4.
* **Verification** by weighted Jaccard >= ``THRESHOLD`` on the whole bags.
* **No pairs of a group.** Texts with equal bags collapse first. Then rounds:
  in every bucket that still holds several components the members outside its
  largest component lead, smallest component first, 4 in the first round, 16
  in the next, and so on up to 1000; each is verified against all members of
  other components, then leaves the bucket. It ends when each bucket is one
  component, or all others have led.
* **Exact bounds.** A pair is skipped where its similarity is known to be below
  the threshold: the part two bags share is at most the lesser of their
  shareable weights, and the rest of both counts against it. In buckets of
  more than ``CROWD`` members only shingles that another member of such a bucket
  has are shareable (their counts are exact, over all those bags); members
  whose shareable part is under the threshold leave, and those with the least
  weight of their own lead first, as they are nearest to what the group has in
  common. A pair that shares several such buckets is taken in its first band
  only, and only if bitmaps of the two bags' hashes leave it in reach: a slot
  that one has and the other has not holds a shingle the pair does not share,
  of weight 1 or ``IDF_FLOOR`` at least. So every candidate pair is verified,
  already connected or out of reach, and a group of n near copies costs about
  n pairs. No cap.

Texts with a common 64-bit bag hash are taken as equal (one chance pair in six
billion texts). Defined results: texts without a word, null ones too, are
classes of their own; texts of any length are compared by their whole bags. The class id is the least doc_id of the class; null ids
count as greater than all, and a class of null ids only has a null id. Repeated
rows are one class. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (U, arrow_texts, discard, doc_chunks, keep_rows, mix, store, text_key,
                               text_or_empty, window_hashes, word_hashes, word_spans)
from strata.llm.components import components

WORDS = 5
THRESHOLD = 0.8
SAMPLES, ROWS = 64, 4
BUCKETS_DF = 1 << 18
RARE, IDF_FLOOR = 0.01, 0.8
SLOT_BITS = 13
SLOTS = 1 << SLOT_BITS
CHUNK = 2 << 20
BASE = 0x9E3779B97F4A7C15
LEADERS, MOST_LEADERS = 4, 1000     # in one round; up to 1000 Spark cuts a window's rows before the sort
CROWD = 8
BITS = 1 << 11

_TABLES: dict = {}


def variates(n: int) -> tuple[np.ndarray, ...]:
    """ln c by slot; r and beta by slot; and ln a for weight 1, split in two."""
    if n not in _TABLES:
        rng = np.random.default_rng(20240229 + n)
        lnc = np.log(rng.gamma(2, 1, (SLOTS, n))).astype(np.float32)
        r = rng.gamma(2, 1, (SLOTS, n)).astype(np.float32)
        beta = rng.random((SLOTS, n), np.float32)
        _TABLES[n] = lnc, r, beta, r * beta - r
    return _TABLES[n]


def shingles(buf: np.ndarray, offsets: np.ndarray):
    """For each document of a chunk its shingle hashes with repeats, in order."""
    starts, ends, first = word_spans(buf, offsets)
    wh = word_hashes(buf, starts, ends, BASE)
    all5 = window_hashes(wh, WORDS, BASE | 1)
    for d in range(len(offsets) - 1):
        a, b = first[d], first[d + 1]
        if b - a >= WORDS:
            yield all5[a:b - WORDS + 1]
        elif b > a:
            yield window_hashes(wh[a:b], int(b - a), BASE | 1)
        else:
            yield all5[:0]


def bags(buf: np.ndarray, offsets: np.ndarray, idf: np.ndarray):
    """(distinct hashes ascending, weights) of each document."""
    for sh in shingles(buf, offsets):
        h, tf = np.unique(sh, return_counts=True)
        w = idf[(h & U(BUCKETS_DF - 1)).astype(np.int64)]
        if len(h) != len(sh):
            w = w * (1 + np.log(tf)).astype(np.float32)
        yield h, w


def sample(h: np.ndarray, w: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """``n`` hashes, each of the (shingle, t) with the least ln a."""
    lnc, r, beta, at_one = variates(n)
    s1 = (h >> U(64 - SLOT_BITS)).astype(np.int64)
    s2 = ((h >> U(36)) & U(SLOTS - 1)).astype(np.int64)
    ln_a = lnc[s1] + at_one[s2]                      # t = 0 for weight 1
    other = np.flatnonzero(w != 1)
    t = None
    if len(other):
        rr, bb = r[s2[other]], beta[s2[other]]
        t = np.floor(np.log(w[other])[:, None] / rr + bb)
        ln_a[other] = lnc[s1[other]] - rr * (t - bb) - rr
    best = ln_a.argmin(0)
    out = h[best]
    if t is not None:
        place = np.full(len(h), -1)
        place[other] = np.arange(len(other))
        k = np.flatnonzero(place[best] >= 0)
        t = t[place[best[k]], k].astype(np.int64)
        k, t = k[t != 0], t[t != 0]                  # t = 0 has the bare hash, whatever the weight
        out[k] = mix(out[k] ^ mix(t.astype(U)))
    return mix(out + np.arange(n, dtype=U) * U(BASE))


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf by counter. All documents are counted; only counters of frequent
    shingles (share above ``RARE``), at most ``BUCKETS_DF``, reach the driver."""
    def count(batches):
        import pyarrow as pa

        total = np.zeros(BUCKETS_DF, np.int64)
        n = 0
        for b in batches:
            buf, off = arrow_texts(b.column(0))
            n += b.num_rows
            for i, j in doc_chunks(off, CHUNK):
                for sh in shingles(buf[off[i]:off[j]], off[i:j + 1] - off[i]):
                    total[np.unique((sh & U(BUCKETS_DF - 1)).astype(np.int64))] += 1
        at = np.flatnonzero(total)
        for k in range(0, len(at), 1 << 16):
            p = at[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(total[p])], ["slot", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([n], pa.int64())], ["slot", "n"])

    df = store(docs.select(F.col("text").cast("string")).mapInArrow(count, "slot long, n long")
               .groupBy("slot").agg(F.sum("n").alias("n")), "neardup-df")
    n = df.where("slot = -1").agg(F.sum("n")).first()[0] or 0
    idf = np.ones(BUCKETS_DF, np.float32)
    for r in df.where((F.col("slot") >= 0) & (F.col("n") > RARE * n)).collect():
        idf[r.slot] = IDF_FLOOR + (1 - IDF_FLOOR) * math.log(n / r.n) / math.log(1 / RARE)
    discard(docs.sparkSession, df)
    return idf


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, t1, t2 (text key), node (bag hash, null without words), weight, bands."""
    def sign(batches):
        import pyarrow as pa

        table = idf.value
        for b in batches:
            buf, off = arrow_texts(b.column(3))
            node, has, weight, bands = [], [], [], []
            for i, j in doc_chunks(off, CHUNK):
                for h, w in bags(buf[off[i]:off[j]], off[i:j + 1] - off[i], table):
                    has.append(len(h) > 0)
                    weight.append(float(w.sum(dtype=float)))
                    if not len(h):
                        node.append(0)
                        bands.append(np.zeros(SAMPLES // ROWS, np.int64))
                        continue
                    s = sample(h, w).reshape(-1, ROWS)
                    bands.append(mix((s * np.array([1, 3, 5, 7], U)[:ROWS]).sum(1, dtype=U)).view(np.int64))
                    # the multiset: hashes and weights, in the order of hashes
                    node.append(int(mix(mix(h ^ w.view(np.uint32).astype(U)).sum(dtype=U)[None] ^ U(len(h)))[0].view(np.int64)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(node) + 1) * (SAMPLES // ROWS), pa.int32()),
                pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(node, pa.int64(), mask=~np.array(has, bool)),
                 pa.array(weight, pa.float64()), lists],
                ["doc_id", "t1", "t2", "node", "weight", "bands"])

    t1, t2 = text_key(text_or_empty())
    return docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, t1 long, t2 long, node long, weight double, bands array<long>")


def bag_table(docs: DataFrame, wanted: DataFrame, idf) -> DataFrame:
    """node, h, w (buffers) of the texts ``wanted`` names: node, t1, t2."""
    def make(batches):
        import pyarrow as pa

        for b in batches:
            buf, off = arrow_texts(b.column(1))
            hs, ws = [], []
            for i, j in doc_chunks(off, CHUNK):
                for h, w in bags(buf[off[i]:off[j]], off[i:j + 1] - off[i], idf.value):
                    hs.append(h.tobytes())
                    ws.append(w.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hs, pa.binary()), pa.array(ws, pa.binary())],
                                             ["node", "h", "w"])

    t1, t2 = text_key(text_or_empty())
    texts = docs.select(t1.alias("t1"), t2.alias("t2"), F.col("text").cast("string").alias("text")).where(
        "text is not null")
    # equal texts collapse before and in the same shuffle that the join needs
    texts = texts.dropDuplicates(["t1", "t2"])
    return wanted.join(texts, ["t1", "t2"]).select("node", "text").mapInArrow(make, "node long, h binary, w binary")


def crowded(members: DataFrame, bag: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """``members`` (bucket, no, node, shared, alone) with exact shareable weights
    in crowded buckets, less the members that no other can reach there. Members
    of crowded buckets carry all their bands and two bitmaps of their hashes,
    those of weight 1 or more and all; others null."""
    def weights(batches):
        import pyarrow as pa

        for b in batches:
            for n, h, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                h = np.frombuffer(h.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), n)), pa.array(h), pa.array(np.frombuffer(w.as_buffer(), np.float32))],
                    ["node", "h", "w"])

    def mark(batches):
        import pyarrow as pa

        for b in batches:
            sets = np.zeros((2, b.num_rows, BITS), bool)
            for i, (h, w) in enumerate(zip(b.column(1), b.column(2))):
                slot = (np.frombuffer(h.as_buffer(), U) >> U(20) & U(BITS - 1)).astype(np.int64)
                sets[0, i, slot[np.frombuffer(w.as_buffer(), np.float32) >= 1]] = True
                sets[1, i, slot] = True
            at = pa.array(np.arange(b.num_rows + 1) * (BITS // 64), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.ListArray.from_arrays(at, pa.array(np.packbits(x, axis=1).view(np.int64).ravel()))
                                for x in sets)], ["node", "ones", "all"])

    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > CROWD).select(
        "bucket", F.lit(True).alias("full"))
    tagged = store(members.join(full, "bucket", "left").withColumn("full", F.coalesce("full", F.lit(False))),
                   "neardup-crowds")
    nodes = tagged.where("full").select("node").distinct()
    their = bag.join(nodes, "node", "left_semi").dropDuplicates(["node"])
    each = their.mapInArrow(weights, "node long, h long, w float")
    marks = their.mapInArrow(mark, "node long, ones array<long>, all array<long>")
    own = (each.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"), F.min("w").alias("w"))
           .where("c = 1").groupBy("node").agg(F.sum("w").alias("own")))
    out = tagged.where("full").join(own, "node", "left")
    out = out.withColumn("alone", F.coalesce("own", F.lit(0.0))).withColumn("shared", F.col("shared") - F.col("alone"))
    out = out.where(F.col("shared") >= (threshold - 1e-6) * (F.col("shared") + F.col("alone")))
    out = out.join(reps.select("node", "bands"), "node").join(marks, "node")
    cols = ["bucket", "no", "node", "shared", "alone"]
    few = tagged.where("not full").select(*cols, *(F.lit(None).cast("array<long>").alias(c)
                                                   for c in ("bands", "ones", "all")))
    return store(few.union(out.select(*cols, "bands", "ones", "all")), "neardup-members")


def lost(ones: str, every: str, other: str) -> Column:
    """At least so much weight of a bag is not in the other: by slot, at most one shingle counts."""
    count = lambda a: F.aggregate(F.zip_with(a, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
                                  F.lit(0), lambda n, x: n + x)
    return IDF_FLOOR * count(every) + (1 - IDF_FLOOR) * count(ones)


def verified(pairs: DataFrame, bag: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) with weighted Jaccard >= threshold."""
    def jaccard(batches):
        import pyarrow as pa

        for b in batches:
            ok = []
            for ha, wa, hb, wb in zip(*(b.column(k).to_pylist() for k in range(2, 6))):
                ha, hb = np.frombuffer(ha, U), np.frombuffer(hb, U)
                wa, wb = np.frombuffer(wa, np.float32), np.frombuffer(wb, np.float32)
                at = np.searchsorted(hb, ha)
                at[at == len(hb)] = 0
                hit = hb[at] == ha
                both = float(np.minimum(wa[hit], wb[at[hit]]).sum(dtype=float))
                either = float(wa.sum(dtype=float) + wb.sum(dtype=float)) - both
                ok.append(both >= (threshold - 1e-6) * either)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    left = bag.select(F.col("node").alias("a"), F.col("h").alias("ha"), F.col("w").alias("wa"))
    right = bag.select(F.col("node").alias("b"), F.col("h").alias("hb"), F.col("w").alias("wb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "wa", "hb", "wb")
            .mapInArrow(jaccard, "a long, b long"))


def more(leaders: int) -> int:
    """Leaders of the next round."""
    return min(4 * leaders, MOST_LEADERS)


def link(members: DataFrame, bag: DataFrame, threshold: float) -> DataFrame | None:
    """node, root of all nodes whose component has a lesser node; see above for
    the rounds. ``members``: as ``crowded`` returns them."""
    spark = members.sparkSession
    roots = led = None
    leaders = LEADERS
    while True:
        if roots is None:
            state = members.withColumn("comp", F.col("node"))
        else:
            state = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
        state = store(state.select("bucket", "no", "node", "comp", "shared", "alone", "bands", "ones", "all"),
                      "neardup-state")
        sizes = state.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"))
        top = (sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"),
                                           F.max(F.struct("size", "comp")).alias("top"))
               .where("comps > 1").select("bucket", F.col("top.comp").alias("top")))
        out = state.join(top, "bucket").where("comp <> top").join(sizes, ["bucket", "comp"])
        if led is not None:
            out = out.join(led, ["bucket", "node"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("size", F.col("alone") / F.col("shared"), "node"))
        now = store(out.withColumn("rank", rank).where(F.col("rank") <= leaders)
                    .select("bucket", F.col("node").alias("lead"), F.col("comp").alias("lead_comp"),
                            F.col("shared").alias("lead_shared"), F.col("alone").alias("lead_alone"),
                            *(F.col(c).alias(f"lead_{c}") for c in ("bands", "ones", "all"))),
                    "neardup-lead")
        if now.isEmpty():
            return roots
        reach = F.least("shared", "lead_shared") >= (threshold - 1e-6) * (
            F.greatest("shared", "lead_shared") + F.col("alone") + F.col("lead_alone"))
        same = F.zip_with("bands", "lead_bands", lambda x, y: x == y)
        total, lead_total = F.col("shared") + F.col("alone"), F.col("lead_shared") + F.col("lead_alone")
        most = F.least(total - lost("ones", "all", "lead_all"), lead_total - lost("lead_ones", "lead_all", "all"))
        near = most >= (threshold - 2e-6) * (total + lead_total - most)
        first = F.col("bands").isNull() | ((F.array_position(same, True) == F.col("no") + 1) & near)
        pairs = (state.join(now, "bucket").where((F.col("comp") != F.col("lead_comp")) & reach & first)
                 .select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct())
        good = store(verified(pairs, bag, threshold), "neardup-links")
        led = now.select("bucket", F.col("lead").alias("node")) if led is None else led.union(
            now.select("bucket", F.col("lead").alias("node")))
        if not good.isEmpty():
            old = roots
            e = good.select(F.col("a").alias("u"), F.col("b").alias("v"))
            if old is not None:
                e = e.union(old.select(F.col("node").alias("u"), F.col("root").alias("v")))
            roots = components(e)
            if old is not None:
                discard(spark, old)
        discard(spark, state)
        leaders = more(leaders)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes). rows: doc_id, t1, t2, node per document row; nodes: node,
    class_id, class_size, k_id and k_text (the row of the class that stays)."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(docs))     # 1 MB, always
    sig = store(signatures(docs, idf), "neardup-signatures")
    has = sig.where("node is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")).alias("first")
    reps = store(has.groupBy("node").agg(first, F.count(F.lit(1)).alias("n"),
                                         F.max("weight").alias("weight"), F.first("bands").alias("bands")),
                 "neardup-bags")
    band = reps.select("node", "weight", F.posexplode("bands").alias("no", "hash")).select(
        "node", "weight", "no", F.xxhash64("no", "hash").alias("bucket"))
    shared = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    members = store(band.join(shared, "bucket").select(
        "bucket", "no", "node", F.col("weight").alias("shared"), F.lit(0.0).alias("alone")), "neardup-buckets")
    wanted = reps.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("first.t1").alias("t1"), F.col("first.t2").alias("t2"))
    bag = store(bag_table(docs, wanted, idf), "neardup-texts")
    roots = link(crowded(members, bag, reps, threshold), bag, threshold)
    of = reps.select("node", "first", "n")
    of = of.withColumn("root", F.col("node")) if roots is None else of.join(roots, "node", "left").select(
        "node", "first", "n", F.coalesce("root", "node").alias("root"))
    per = of.groupBy("root").agg(F.min("first").alias("f"), F.sum("n").alias("class_size"))
    nodes = store(of.select("node", "root").join(per, "root").select(
        "node", F.col("f.doc_id").alias("class_id"), "class_size", F.col("f.doc_id").alias("k_id"),
        F.struct(F.col("f.t1").alias("t1"), F.col("f.t2").alias("t2")).alias("k_text")), "neardup-classes")
    discard(spark, members, bag)
    return sig.select("doc_id", "t1", "t2", "node"), nodes


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept."""
    rows, nodes = classes(docs, threshold)
    t = F.struct("t1", "t2")
    out = rows.join(nodes, "node", "left")
    one = F.lit(1).cast("long")
    return out.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", one).alias("class_size"),
        (F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("k_id")) & (t == F.col("k_text")))).alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays; texts without words stay."""
    rows, nodes = classes(docs)

    def key():
        a, b = text_key(text_or_empty())
        return F.struct(a.alias("t1"), b.alias("t2"))

    alone = rows.where("node is null").select(F.col("doc_id").alias("k_id"), F.struct("t1", "t2").alias("k_text"))
    return keep_rows(docs, nodes.select("k_id", "k_text").union(alone).distinct(), key)
