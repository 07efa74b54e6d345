"""Query keys of the training-text operators, with DuckDB SQL where SQL can
express the whole result."""

from __future__ import annotations

import importlib.util
import os

from strata.llm import (bytebpe, exact_dedup, licenses, linededup, neardup, packing, quality, repair, secrets,
                        sentencepiece, substrings, urlfilter, whitening)

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def public_tokenizers():
    """The module that lies beside those files: ``path`` and ``PATTERN``."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{TOKENIZERS}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


QUERIES = {}
ORACLE_SQL = {}


def _query(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_near_duplicates")
def op1(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query("op2_secret_scan")
def op2(spark, sf_dir):
    return secrets.report(_table(spark, sf_dir, "documents"))


#: The counts by list functions; the holdout by windows; the exact binomial
#: sum by logarithms of factorials.
OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ln
  FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
dup AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY r),
c AS (
  SELECT d.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ln) AS BIGINT) AS n_lines,
         CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.r = rep.r),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         [CASE WHEN word_chars > 0 THEN least(100, floor(100.0 * n_symbols / word_chars)) ELSE 0 END,
          CASE WHEN n_words > 0 THEN least(100, floor(100.0 * n_repeat_words / n_words)) ELSE 0 END,
          CASE WHEN n_lines > 0 THEN least(100, floor(100.0 * n_dup_lines / n_lines)) ELSE 0 END,
          CASE WHEN n_words > 0 THEN least(100, greatest(0, floor(10.0 * (word_chars / n_words)) - 40)) ELSE 0 END,
          CASE WHEN n_words > 0 THEN least(100, greatest(0, 60 - floor(10.0 * (word_chars / n_words)))) ELSE 0 END
         ] AS lv
  FROM c),
held AS (
  SELECT row_number() OVER () AS h, stratum, lv, quality AS good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS learn
  FROM f JOIN labels USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1)),
per AS (
  SELECT *, 0.05 / count(*) OVER () AS q, n_test * ln(0.98) <= ln(0.05 / count(*) OVER ()) AS split
  FROM (SELECT stratum, sum(good) AS n, sum(good) FILTER (WHERE learn) AS n_learn,
               coalesce(sum(good) FILTER (WHERE NOT learn), 0) AS n_test FROM held GROUP BY stratum)),
risk AS (
  SELECT stratum, split, n_learn, (
    SELECT max(k) FROM (
      SELECT k, sum(exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) + k * ln(0.02) + (m - k) * ln(0.98)))
                  OVER (ORDER BY k) AS p
      FROM (SELECT unnest(range(0, CAST(least(m, ceil(m * 0.02)) AS BIGINT) + 1)) AS k)) WHERE p <= q) AS most
  FROM (SELECT *, CASE WHEN split THEN n_test ELSE n END AS m FROM per)),
k AS (SELECT * FROM (VALUES (1, 'symbol_rate'), (2, 'repeat_rate'), (3, 'dup_line_rate'), (4, 'long_words'),
                            (5, 'short_words')) x(k, feature)),
tail AS (
  SELECT stratum, k, feature, c, sum(lost) OVER d AS lost, sum(caught) OVER d AS caught
  FROM (SELECT stratum, k, feature, lv[k] AS c, sum(good) AS lost, sum(1 - good) AS caught
        FROM held, k WHERE learn GROUP BY ALL) WINDOW d AS (PARTITION BY stratum, k ORDER BY c DESC)),
picked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, feature) AS step FROM (
    SELECT stratum, k, feature, c, caught - 5.0 * lost AS gain FROM tail JOIN risk USING (stratum)
    WHERE split AND caught - 5.0 * lost > 0 AND 10 * lost <= 0.02 * n_learn
    QUALIFY row_number() OVER (PARTITION BY stratum, k ORDER BY gain DESC, c DESC) = 1)),
gone AS (
  SELECT h, held.stratum, good, min(step) AS step FROM held JOIN picked ON held.stratum = picked.stratum AND lv[picked.k] >= c
  WHERE NOT learn GROUP BY ALL),
passed AS (
  SELECT p.stratum, p.k, p.c FROM picked p JOIN risk USING (stratum)
  WHERE (SELECT coalesce(sum(good), 0) FROM gone WHERE gone.stratum = p.stratum AND gone.step <= p.step) <= most),
worst AS (
  SELECT stratum, c, sum(lost) OVER d AS lost, sum(caught) OVER d AS caught
  FROM (SELECT stratum, list_max(lv) AS c, sum(good) AS lost, sum(1 - good) AS caught FROM held GROUP BY ALL)
  WINDOW d AS (PARTITION BY stratum ORDER BY c DESC)),
cut AS (
  SELECT stratum, k, c AS cutoff FROM passed
  UNION ALL
  SELECT stratum, k.k, c FROM (
    SELECT stratum, c, caught - 5.0 * lost AS gain FROM worst JOIN risk USING (stratum)
    WHERE NOT split AND lost <= most AND caught - 5.0 * lost > 0
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, c DESC) = 1), k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
         SELECT 1 FROM cut WHERE cut.stratum = f.stratum AND f.lv[cut.k] >= cut.cutoff) AS kept
FROM f
"""


@_query("op3_quality_rules", OP3_SQL)
def op3(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, _table(spark, sf_dir, "labels"), carry=["doc_id"])


@_query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return packing.best_fit(_table(spark, sf_dir, "documents"))


@_query("op9_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
""")
def op9(spark, sf_dir):
    return exact_dedup.dedup(_table(spark, sf_dir, "documents"))


#: Frequent token sets by listing the subsets of each URL's few tokens.
OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_extract(url, '\?([^#]*)', 1), '') AS q,
         coalesce(contains(url, '://'), false) AS whole
  FROM pages),
t AS (
  SELECT page_id, url, host, path, list_sort(list_distinct(CASE WHEN whole THEN list_concat(
           ['h:' || x FOR x IN regexp_split_to_array(regexp_replace(lower(host), '[0-9]+', '#', 'g'), '[-.]') IF x <> ''],
           ['p:' || x FOR x IN regexp_split_to_array(regexp_replace(lower(path), '[0-9]+', '#', 'g'), '[^a-z#]+') IF x <> ''],
           ['q:' || regexp_extract(x, '^([^=]*)', 1) FOR x IN string_split(lower(q), '&') IF x <> '']
         ) ELSE [] END)) AS tok
  FROM p),
y AS (
  SELECT tok, coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 AS bad
  FROM t JOIN labels ON page_id = doc_id
  WHERE len(tok) > 0 OR coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE bad) AS b FROM y),
sub AS (
  SELECT [tok[k] FOR k IN range(1, len(tok) + 1) IF (m >> CAST(k - 1 AS INTEGER)) & 1 = 1] AS s, bad
  FROM (SELECT tok, bad, unnest(range(1, CAST(pow(2, len(tok)) AS BIGINT))) AS m FROM y)),
good_rules AS (
  SELECT s FROM sub, tot GROUP BY s, tot.n, tot.b
  HAVING count(*) FILTER (WHERE bad) >= ceil(0.005 * tot.n)
     AND count(*) FILTER (WHERE bad) >= 0.7 * count(*)
     AND count(*) FILTER (WHERE bad) * tot.n >= 2.0 * count(*) * tot.b),
hit AS (SELECT DISTINCT url FROM t, good_rules WHERE list_has_all(tok, s)),
r AS (
  SELECT t.page_id, t.url, t.host, t.path, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM t)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN url IN (SELECT url FROM hit WHERE url IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@_query("op4_url_filter", OP4_SQL)
def op4(spark, sf_dir):
    return urlfilter.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


@_query("op6_sentencepiece")
def op6(spark, sf_dir):
    return sentencepiece.report(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@_query("op7_line_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, 'null') AS site,
         string_split(coalesce(text, ''), chr(10)) AS ln FROM documents),
x AS (
  SELECT r, site, i, ln[i] AS line,
         regexp_replace(ln[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k
  FROM (SELECT r, site, ln, unnest(range(1, len(ln) + 1)) AS i FROM d)),
bad AS (SELECT k FROM x WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 8),
k AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n
      FROM x WHERE k NOT IN (SELECT k FROM bad) GROUP BY r)
SELECT doc_id, CAST(len(ln) AS BIGINT) AS n_lines, CAST(len(ln) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
""")
def op7(spark, sf_dir):
    return linededup.report(_table(spark, sf_dir, "documents"))


@_query("op8_substring_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
win AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
least_doc AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
g AS (SELECT r, p FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM win JOIN least_doc USING (h)
                        WHERE m < doc_id OR (doc_id IS NULL AND m IS NOT NULL)) GROUP BY r, p),
x AS (SELECT r, w[p] AS word, p FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.p) AS t, count(*) AS n
      FROM x ANTI JOIN g ON x.r = g.r AND x.p = g.p GROUP BY x.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
""")
def op8(spark, sf_dir):
    return substrings.report(_table(spark, sf_dir, "documents"))


def _op10_sql():
    rows = ",\n    ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES.items())
    words = r"[x FOR x IN regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"
    gram = "w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4]"
    return rf"""
WITH tpl(name, text) AS (VALUES
    {rows}),
ts AS (SELECT DISTINCT name, {gram} AS g
       FROM (SELECT name, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT name, {words.format('text')} AS w FROM tpl))),
m AS (SELECT name, count(*) AS m FROM ts GROUP BY name),
d AS (SELECT row_number() OVER () AS r, doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
h AS (SELECT r, i - 1 AS p, {gram} AS g, n
      FROM (SELECT r, w, len(w) - 4 AS n, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT r, p, n, name, g, m,
               CASE WHEN m < 4 THEN 1 ELSE 8 END AS width, CASE WHEN m < 4 THEN 1 ELSE 4 END AS step
        FROM h JOIN ts USING (g) JOIN m USING (name)),
core AS (SELECT DISTINCT r, name, unnest(range(CAST(greatest(0, ceil((p - width + 1) / step)) AS BIGINT),
                                               CAST(floor(p / step) AS BIGINT) + 1)) * step AS pos, width, m
         FROM hit),
found AS (SELECT DISTINCT core.r, core.name FROM core JOIN hit
            ON hit.r = core.r AND hit.name = core.name AND hit.p >= pos - core.m AND hit.p < pos + core.width + core.m
          GROUP BY core.r, core.name, pos, core.m HAVING count(DISTINCT g) >= 0.8 * core.m)
SELECT doc_id, count(name) AS n_licenses, coalesce(string_agg(name, ',' ORDER BY name), '') AS licenses
FROM d LEFT JOIN found USING (r) GROUP BY r, doc_id
"""


@_query("op10_license_scan", _op10_sql())
def op10(spark, sf_dir):
    return licenses.report(_table(spark, sf_dir, "documents")).select("doc_id", "n_licenses", "licenses")


@_query("op11_byte_bpe")
def op11(spark, sf_dir):
    files = public_tokenizers()
    return bytebpe.report(_table(spark, sf_dir, "documents"), files.path("byte_bpe_multi_50k.tiktoken"), files.PATTERN)


@_query("op12_embedding_whitening")
def op12(spark, sf_dir):
    return whitening.report(_table(spark, sf_dir, "embeddings"))


@_query("op13_conversation_repair")
def op13(spark, sf_dir):
    return repair.report(_table(spark, sf_dir, "conversations"))
