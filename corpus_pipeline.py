"""Corpus preparation: quality rules, exact dedup, near-duplicate removal,
secret masking and packing, each stage over all rows the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes every stage's rows to the
shared folder and reads them back for the next. SQL cannot express the weighted
sampling and packing stages, so ``ORACLE_SQL`` is None; tests compare each
stage with a brute-force version. Empty tables, null and very long texts and
repeated rows have the results that the operators' docstrings state.
"""

from __future__ import annotations

from strata.llm import exact_dedup, neardup, packing, quality, secrets
from strata.llm.common import store

STAGES = [
    ("quality_rules", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_duplicates", neardup.stage),
    ("secret_scan", secrets.stage),
    ("best_fit_packing", packing.stage),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows: where every piece of every kept document goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
