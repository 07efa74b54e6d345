"""The stages one after the other on a small corpus, against brute force."""

import collections
import random
import re

import corpus_pipeline as C
import __spark_entry__ as E
from strata.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    rows = [(i, text(rnd.randint(20, 120))) for i in range(80)]
    a, b = rows[0][1], text(150)
    rows += [(200 + i, a) for i in range(4)] + [(210, a.replace(" ", "\n"))]
    rows += [(300 + i, re.sub(r"\w+", "edit%d" % i, b, count=1)) for i in range(5)]
    rows += [(400, "too short"), (401, None), (402, ""), (403, "x y z w v " * 40), (404, rows[5][1]), (404, rows[5][1]),
             (None, rows[6][1]), (None, text(40)), (500, text(30) + " password: correcthorse1 " + text(5)), (501, text(9000))]
    return [(d, t, "en", f"s{k % 5}", len(t or "")) for k, (d, t) in enumerate(rows)]


def write(spark, rows, tmp):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{tmp}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows if r[0] is not None and r[0] < 80]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")


def test_every_stage_on_what_the_one_before_kept(spark, tmp):
    rows = corpus()
    write(spark, rows, tmp)
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    ids, seen = collections.Counter(r[0] for r in rows), {}
    for k, (name, stage) in enumerate(C.STAGES):
        docs = common.store(stage(spark, docs, tmp), "test-stage")
        if k < len(C.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r.doc_id: r for r in docs.collect()}, collections.Counter(r.doc_id for r in docs.collect())
    q, x, n, s, p = (seen[name][1] for name, _ in C.STAGES)
    assert ids - q == collections.Counter([400, 401, 402, 403])                   # base rules
    assert q - x == collections.Counter([200, 201, 202, 203, 210, 404, 404, None])  # equal texts: least id stays
    assert x - n == collections.Counter([301, 302, 303, 304])                     # near copies of 300
    assert s == n and seen["secret_scan"][0][500].text.count("<SECRET>") == 1
    changed = [d for d in n if seen["near_duplicates"][0][d].text != seen["secret_scan"][0][d].text]
    assert changed == [500]
    assert set(p) == set(s) and p[501] == 5
    length = collections.Counter()
    for r in docs.collect():
        length[r.doc_id] += r.length
    assert length == collections.Counter({d: len((seen["secret_scan"][0][d].text or "").split()) for d in s})


def test_run_and_registration(spark, tmp):
    write(spark, corpus()[:30], tmp)
    out = E.queries()["pipeline"](spark, tmp)
    assert out.count() == 30 and "pipeline" not in E.oracle_sql()
    assert len([k for k in E.queries() if re.match(r"op\d+_", k)]) == 13


def test_empty_tables(spark, tmp):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    assert C.run(spark, tmp).count() == 0
