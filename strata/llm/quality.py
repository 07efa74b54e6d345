"""Operator 3: quality rules with risk-controlled thresholds (SQL functions only).

Each text gets counts (words, symbols, repeated lines, words in repeated
five-word windows) and from them ``FEATURES`` in steps of one percent. Labelled
documents are the holdout. The rules that may be chosen for a stratum (language)
form one chain, each rejecting all that the one before rejects and more; the
loss of a rule, the share of good documents that the union of its cutoffs
rejects, only grows along the chain. With n good labels, of which k are lost,
the exact binomial test rejects "more than ``alpha`` of good documents are lost"
if P(Bin(n, alpha) <= k) is at most delta / strata. Rules are tested in the
chain's order up to the first that fails, so one level serves the whole chain
(fixed-sequence testing), and dividing delta by the strata corrects for those.
With probability 1 - delta no stratum loses more than ``alpha`` of its good
documents. A chain must not depend on the labels that test it:

* A stratum with enough good labels is split in two halves by a digest of the
  id. The one half picks for each feature the cutoff that removes the most bad
  documents, less ``good_cost`` times the good ones (and at most a tenth of what
  may be lost), and orders the features by that gain; the chain adds one
  feature's cutoff after the other, and the other half tests it.
* A stratum with fewer good labels (the half would be too small to pass with no
  loss) has a chain that is fixed beforehand: all features are cut at the same
  level, which falls from 100; all its labels test it, and of the levels that
  pass the one with the greatest gain is taken.

Defined results: a null text has no words; texts under 10 words fail the base
rule; texts of any length are counted whole. Null and empty languages are one
stratum. A stratum with too few labels, or none,
gets no cutoff, so only the base rule holds there. Labels of ids without a
document, and null labels, do not count; a document row joined by several
labels counts once per label. Repeated rows are judged alike. Empty tables give
empty results. Other columns pass through ``stage`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WHITE, fresh, store, text_or_empty, word_array

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
ALPHA = 0.02       # good documents that may be lost per stratum
DELTA = 0.05       # chance that the guarantee fails anywhere
GOOD_COST = 5.0    # bad documents one lost good document must buy
FEATURES = ("symbol_rate", "repeat_rate", "dup_line_rate", "long_words", "short_words")

COUNT_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with the five counts; ``names`` maps them to free column names."""
    names = names or {c: c for c in COUNT_COLUMNS}
    t, w, h, s, d, i = fresh(docs, "__text", "__words", "__hashes", "__sorted", "__twice", "__at")
    keep = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.withColumn(t, text_or_empty())
    df = df.withColumn(w, word_array(F.col(t)))
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    (ln,) = fresh(df, "__lines")
    df = df.withColumn(ln, lines)
    windows = F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda p: F.xxhash64(*[F.get(F.col(w), p + j) for j in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(h, windows)
    # only texts with a repeated window are sorted, with the window's place
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn(s, F.when(repeats, F.sort_array(F.transform(
        F.col(h), lambda x, p: F.struct(x.alias("h"), p.alias("p"))))))
    twin = lambda p: F.get(F.col(s), p)["h"]
    df = df.withColumn(i, F.when(F.col(s).isNotNull(), F.sort_array(F.transform(
        F.filter(F.col(s), lambda x, p: x["h"].eqNullSafe(twin(p + 1))
                 | x["h"].eqNullSafe(twin(p - 1))), lambda x: x["p"]))))
    covered = F.when(F.size(i) > 0, F.aggregate(
        F.zip_with(F.slice(F.col(i), 2, F.size(i)), F.col(i), lambda nxt, cur: nxt - cur),
        F.lit(0).cast("long"),
        lambda acc, gap: acc + F.least(F.coalesce(gap, F.lit(WINDOW)), F.lit(WINDOW)))).otherwise(0)
    counts = {
        "n_words": F.size(w), "word_chars": F.length(F.translate(F.col(t), WHITE, "")),
        "n_symbols": F.length(t) - F.length(F.translate(F.col(t), SYMBOLS, "")),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)), "n_repeat_words": covered,
    }
    return df.select(*keep, *[counts[c].cast("long").alias(names[c]) for c in COUNT_COLUMNS],
                     F.size(ln).cast("long").alias(names.get("n_lines", "n_lines")))


def base_failed(names: dict[str, str] | None = None) -> Column:
    n = names or {c: c for c in COUNT_COLUMNS}
    return (F.col(n["n_words"]) < MIN_WORDS) | (
        100 * F.col(n["n_repeat_words"]) > MAX_REPEAT_PERCENT * F.col(n["n_words"]))


def levels(n: dict[str, str]) -> dict[str, Column]:
    """Each feature as a whole number of steps, 0..100; more is worse."""
    share = lambda a, b: F.least(F.lit(100), F.when(b > 0, F.floor(100 * a / b)).otherwise(0)).cast("int")
    c = lambda k: F.col(n[k])
    mean = F.when(c("n_words") > 0, c("word_chars") / c("n_words"))
    return {
        "symbol_rate": share(c("n_symbols"), c("word_chars")),
        "repeat_rate": share(c("n_repeat_words"), c("n_words")),
        "dup_line_rate": share(c("n_dup_lines"), c("n_lines")),
        "long_words": F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(F.floor(10 * mean) - 40, F.lit(0)))).cast("int"),
        "short_words": F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(60 - F.floor(10 * mean), F.lit(0)))).cast("int"),
    }


def most_lost(n: Column, alpha: float, level: Column) -> Column:
    """Largest k with P(Bin(n, alpha) <= k) <= level, or -1: an exact sum of
    binomial terms, in logarithms while the terms are tiny."""
    odds = math.log(alpha) - math.log1p(-alpha)
    start = F.struct(n.cast("double").alias("n"), (n * math.log1p(-alpha)).alias("lp"),
                     F.lit(0.0).alias("cdf"), F.lit(-1).cast("long").alias("k"))

    def step(a, i):
        lp = F.when(i == 0, a["lp"]).otherwise(
            a["lp"] + F.log((a["n"] - i + 1) / F.greatest(i, F.lit(1))) + odds)
        cdf = a["cdf"] + F.exp(lp)
        return F.struct(a["n"].alias("n"), lp.alias("lp"), cdf.alias("cdf"),
                        F.when(cdf <= level, i.cast("long")).otherwise(a["k"]).alias("k"))

    up_to = F.least(n, F.ceil(n * alpha)).cast("long")
    return F.aggregate(F.sequence(F.lit(0).cast("long"), up_to), start, step, lambda a: a["k"])


def learning(doc_id: Column) -> Column:
    """Which labels pick the chain; the others test it."""
    return F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 1) < "8"


def cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            good_cost: float = GOOD_COST) -> DataFrame:
    """stratum, feature, cutoff: one row per stratum and feature with a cutoff.

    ``counted``: doc_id, stratum, the levels named ``FEATURES``, and failed
    (documents the base rule rejects anyway are no holdout)."""
    y = labels.select(F.col("doc_id").alias("l_id"), F.col("quality").alias("good")).where(
        "l_id is not null and good in (0, 1)")
    held = store(counted.where(~F.col("failed")).join(y, F.col("doc_id") == F.col("l_id")).select(
        "stratum", "good", learning(F.col("doc_id")).alias("learn"), *FEATURES), "quality-holdout")
    good = F.col("good")
    # one row per stratum: good labels, level of the tests, which chain
    per = held.groupBy("stratum").agg(
        F.sum("good").alias("n"), F.sum(F.when(F.col("learn"), good).otherwise(0)).alias("n_learn"),
        F.sum(F.when(~F.col("learn"), good).otherwise(0)).alias("n_test"))
    per = store(per, "quality-strata")
    level = F.lit(delta / max(1, per.count()))
    per = per.withColumn("split", F.col("n_test") * math.log1p(-alpha) <= F.log(level)).withColumn(
        "most", most_lost(F.when(F.col("split"), F.col("n_test")).otherwise(F.col("n")), alpha, level))
    gain = F.col("caught") - good_cost * F.col("lost")
    sums = [F.sum("good").alias("lost"), F.sum(1 - good).alias("caught")]

    # chain picked by the one half: at most 101 levels in a window
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("cutoff")) for f in FEATURES])).alias("x")
    down = Window.partitionBy("stratum", "feature").orderBy(F.col("cutoff").desc())
    hist = held.where("learn").select("stratum", "good", each).select("stratum", "good", "x.*").groupBy(
        "stratum", "feature", "cutoff").agg(*sums)
    tail = hist.withColumns({"lost": F.sum("lost").over(down), "caught": F.sum("caught").over(down)})
    picked = (tail.join(per.where("split"), "stratum")
              .where((gain > 0) & (10 * F.col("lost") <= alpha * F.col("n_learn")))
              .groupBy("stratum", "feature").agg(F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("b"))
              .withColumn("step", F.row_number().over(
                  Window.partitionBy("stratum").orderBy(F.col("b.gain").desc(), "feature")))
              .select("stratum", "feature", "b.cutoff", "step"))
    picked = store(picked, "quality-chain")
    wide = picked.groupBy("stratum").agg(*[
        F.max(F.when(F.col("feature") == f, F.struct("cutoff", "step"))).alias(f"c_{f}") for f in FEATURES])
    first = F.least(*[F.when(F.col(f) >= F.col(f"c_{f}.cutoff"), F.col(f"c_{f}.step")) for f in FEATURES])
    lost = (held.where("NOT learn").join(wide, "stratum").select("stratum", "good", first.alias("step"))
            .where("step is not null").groupBy("stratum", "step").agg(F.sum("good").alias("lost")))
    steps = picked.select("stratum", "step").join(lost, ["stratum", "step"], "left").withColumn(
        "lost", F.sum(F.coalesce("lost", F.lit(0))).over(Window.partitionBy("stratum").orderBy("step")))
    passed = steps.join(per, "stratum").where(F.col("lost") <= F.col("most")).select("stratum", "step")
    learned = picked.join(passed, ["stratum", "step"], "left_semi").select("stratum", "feature", "cutoff")

    # the fixed chain
    worst = held.withColumn("cutoff", F.greatest(*FEATURES)).groupBy("stratum", "cutoff").agg(*sums)
    down = Window.partitionBy("stratum").orderBy(F.col("cutoff").desc())
    worst = worst.withColumns({"lost": F.sum("lost").over(down), "caught": F.sum("caught").over(down)})
    fixed = (worst.join(per.where("NOT split"), "stratum").where((F.col("lost") <= F.col("most")) & (gain > 0))
             .groupBy("stratum").agg(F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("b"))
             .select("stratum", F.explode(F.array(*map(F.lit, FEATURES))).alias("feature"), "b.cutoff"))
    return learned.unionByName(fixed)


def judge(docs: DataFrame, labels: DataFrame, names: dict[str, str] | None = None,
          carry: list[str] | None = None, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all by default) with the five counts,
    ``base_failed`` and ``kept``. Counts are made once and stored: the holdout
    and the verdicts both read them."""
    n = {c: c for c in (*COUNT_COLUMNS, "n_lines", "base_failed", "kept")} | (names or {})
    carry = docs.columns if carry is None else carry
    feat = dict(zip(FEATURES, fresh(docs, *[f"__{f}" for f in FEATURES])))
    stratum, row_id = fresh(docs, "__stratum", "__doc")
    df = with_counts(docs, n).withColumns({
        n["base_failed"]: base_failed(n), row_id: F.col("doc_id"),
        stratum: F.coalesce(F.col("lang").cast("string"), F.lit(""))})
    df = df.withColumns({feat[f]: x for f, x in levels(n).items()})
    df = store(df.drop(*[c for c in docs.columns if c not in carry]), "quality-counts")
    held = df.select(F.col(row_id).alias("doc_id"), F.col(stratum).alias("stratum"),
                     F.col(n["base_failed"]).alias("failed"),
                     *[F.col(c).alias(f) for f, c in feat.items()])
    chosen = store(cutoffs(held, labels, alpha, delta), "quality-cutoffs")
    wide = chosen.groupBy(F.col("stratum").alias("__cut_stratum")).agg(*[
        F.max(F.when(F.col("feature") == f, F.col("cutoff"))).alias(f"__cut_{f}") for f in FEATURES])
    bad = F.lit(False)
    for f in FEATURES:
        bad = bad | F.coalesce(F.col(feat[f]) >= F.col(f"__cut_{f}"), F.lit(False))
    out = df.join(wide, F.col(stratum) == F.col("__cut_stratum"), "left")
    return out.withColumn(n["kept"], ~F.col(n["base_failed"]) & ~bad).select(
        *[F.col(f"`{c}`") for c in carry], *[F.col(n[c]) for c in (*COUNT_COLUMNS, "base_failed", "kept")])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    all_names = (*COUNT_COLUMNS, "n_lines", "base_failed", "kept")
    names = dict(zip(all_names, fresh(docs, *[f"__q_{c}" for c in all_names])))
    return judge(docs, labels, names).where(F.col(names["kept"])).select(*docs.columns)
