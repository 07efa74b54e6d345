"""Operator 4: URL filter by host rules and mined association rules (SQL and
Spark FP-growth only; no Python on the executors).

Host rules fit a host and its subdomains when the path starts with theirs; the
longest wins. Where none fits, the mined rules judge. A URL becomes a set of
tokens (words of the host and path, query keys; digits become ``#``).
Frequent tokens that stand in exactly the same labelled URLs are merged to one
item; labelled URLs, with the label ``toxic`` or low ``quality`` as one more item,
go through Spark's FP-growth. A rule *tokens -> bad* is kept with a support of
``MIN_SUPPORT``, a confidence of ``MIN_CONFIDENCE`` and a lift of ``MIN_LIFT``,
and pruned when a kept rule with fewer tokens covers it at no less confidence.

Matching uses an inverted index: each rule is listed under its rarest token,
so common tokens have short lists; a URL looks up each of its tokens and
a hit is checked for the rule's other tokens. Equal URLs are looked up once.

Defined results: a null url, or one without ``://``, has an empty host and path
and no tokens, so it is allowed. Urls of any length are read whole. Rows are judged alike however often they
repeat; null page ids pass through. A page counts as labelled by the label
whose id equals its page id. Without labels or pages nothing is mined and all
unruled URLs are allowed. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import store

# The rules of the contract, (action, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.7
MIN_LIFT = 2.0
BAD = "label=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text or null, action or null), the longest rule first."""
    text = action = F.lit(None).cast("string")
    for act, rh, rp in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        text = F.when(fits, F.lit(rh + rp)).otherwise(text)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; digits are masked so that ids do not count."""
    h, p = host(url), path(url)
    q = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    words = lambda c, cut, tag: F.transform(
        F.filter(F.split(F.regexp_replace(F.lower(c), "[0-9]+", "#"), cut), lambda x: x != ""),
        lambda x: F.concat(F.lit(tag), x))
    keys = F.transform(F.filter(F.split(F.lower(q), "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1)))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(F.concat(
        words(h, "[-.]", "h:"), words(p, "[^a-z#]+", "p:"), keys))).otherwise(
        F.array().cast("array<string>"))


def mine(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> tuple[DataFrame, DataFrame]:
    """(tokens, confidence, support of the kept rules, pruned; the frequent
    tokens as ``together`` merges them)."""
    spark = pages.sparkSession
    y = labels.where("doc_id is not null").select(
        F.col("doc_id").alias("l_id"), ((F.coalesce("toxic", F.lit(0)) == 1)
                                        | (F.coalesce("quality", F.lit(1)) == 0)).alias("bad"))
    items = pages.select("page_id", F.col("url").cast("string").alias("url")).join(
        y, F.col("page_id") == F.col("l_id")).select(
        F.when(F.col("bad"), F.concat(tokens(F.col("url")), F.array(F.lit(BAD))))
        .otherwise(tokens(F.col("url"))).alias("items")).where(F.size("items") > 0)
    items = store(items.withColumn("row_id", F.monotonically_increasing_id()), "url-items")
    empty = spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    n = items.count()
    if not n:
        return empty, spark.createDataFrame([], "token string, first string")
    same = together(items, min_support * n)
    merged = items.withColumn("token", F.explode("items")).join(F.broadcast(same), "token").groupBy("row_id").agg(
        F.collect_set("first").alias("found"))
    bad = F.array_contains("items", BAD)
    items = items.join(merged, "row_id", "left").select(F.concat(
        F.coalesce("found", F.array().cast("array<string>")), F.when(bad, F.array(F.lit(BAD))).otherwise(
            F.array().cast("array<string>"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        store(items, "url-merged-items"))
    found = (model.associationRules.where(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift))
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    found = store(found, "url-rules")
    # a rule goes when a rule on a subset of its tokens is at least as sure:
    # subsets meet in an index on their first token
    small = found.select(F.col("tokens").alias("s"), F.col("confidence").alias("c"),
                         F.col("tokens")[0].alias("key"))
    big = found.select("tokens", "confidence", F.explode("tokens").alias("key"))
    covered = big.join(small, "key").where(
        (F.size("s") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
        & (F.size(F.array_except("s", "tokens")) == 0)).select("tokens").distinct()
    return store(found.join(covered, "tokens", "left_anti"), "url-kept-rules"), same


def together(items: DataFrame, least: float) -> DataFrame:
    """token -> first: frequent tokens (in ``least`` rows or more), where those
    that stand in the same rows share the first of them. Merged, they are one
    item: twenty tokens of one site's URLs would otherwise be 2^20 frequent
    sets. Rows are compared by their count and 128 bits of their ids. There are
    at most (tokens of a row) / (support) frequent tokens, which bounds the
    broadcast."""
    rows = items.select(F.explode("items").alias("token"), "row_id").where(F.col("token") != BAD)
    seen = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row_id")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), "row_id")).alias("b")).where(F.col("n") >= least)
    seen = store(seen, "url-frequent-tokens")
    first = seen.groupBy("n", "a", "b").agg(F.min("token").alias("first"))
    return store(seen.join(first, ["n", "a", "b"]).select("token", "first"), "url-merged-tokens")


def matches(urls: DataFrame, rules: DataFrame, same: DataFrame | None = None) -> DataFrame:
    """The distinct ``url`` values of ``urls`` that some rule's tokens are in; of
    tokens merged by ``same`` any one will do, as each alone makes a rule that is
    as sure."""
    t = urls.select("url", tokens(F.col("url")).alias("have"))
    if same is not None:
        t = t.select("url", F.explode("have").alias("token")).join(F.broadcast(same), "token").groupBy("url").agg(
            F.collect_set("first").alias("have"))
    held = rules.select(F.monotonically_increasing_id().alias("rule_id"), F.col("tokens").alias("need"))
    held = store(held, "url-index")
    listed = held.select("rule_id", F.explode("need").alias("token"))
    seen = t.select(F.explode("have").alias("token")).join(
        listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = listed.join(seen, "token").groupBy("rule_id").agg(
        F.min(F.struct("n", "token"))["token"].alias("token")).join(held, "rule_id")
    return (t.select("url", "have", F.explode("have").alias("token")).join(index, "token")
            .where(F.size(F.array_except("need", "have")) == 0).select("url").distinct())


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict: one row per page."""
    mined, same = mine(pages, labels, **mining)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    open_urls = rows.where(rule_of(host(F.col("url")), path(F.col("url")), rules)[0].isNull()
                           & F.col("url").isNotNull()).select("url").distinct()
    hit = matches(open_urls, mined, same).withColumn("mined", F.lit("block"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    return (rows.join(hit, "url", "left")
            .select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "mined")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(action, F.col("mined"), F.lit("allow")).alias("verdict")))
