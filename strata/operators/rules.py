"""Data-quality expectations: warn, drop or fail.

A rule is a name, a boolean SQL expression and a policy. Semantics (fixed):

* a row passes a rule iff the expression is TRUE; FALSE and NULL both violate;
* all rules of a dataset are evaluated on the same, undropped output of the
  dataset function, in one pass; a row breaking two rules counts for both;
* fail rules abort the action on the first violating row; drop rules remove
  violating rows; warn rules only count.

Everything stays in Catalyst: counting uses ``DataFrame.observe`` (no extra
scan) or a plain aggregate, dropping is a ``filter`` on the bare predicate so
Parquet pushdown still applies, and failing is ``assert_true`` inside the
filter condition (a projected ``assert_true`` column would be pruned away
when unused).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"
_POLICIES = (WARN, DROP, FAIL)


@dataclass(frozen=True)
class Rule:
    name: str
    sql: str
    policy: str = WARN

    def __post_init__(self):
        if self.policy not in _POLICIES:
            raise ValueError(f"unknown policy {self.policy!r}")

    @property
    def predicate(self) -> Column:
        return F.expr(self.sql)

    @property
    def passed(self) -> Column:
        """TRUE/FALSE, never NULL."""
        return F.coalesce(self.predicate, F.lit(False))

    @classmethod
    def from_sql(cls, text: str) -> "Rule":
        """Parse the SQL constraint clause form:
        ``CONSTRAINT name EXPECT (predicate) [ON VIOLATION DROP ROW | FAIL UPDATE]``.
        """
        m = re.match(r"\s*CONSTRAINT\s+(\w+)\s+EXPECT\s*\((.*)\)\s*"
                     r"(ON\s+VIOLATION\s+(DROP\s+ROW|FAIL\s+UPDATE))?\s*$",
                     text, flags=re.IGNORECASE | re.DOTALL)
        if not m:
            raise ValueError(f"not a constraint clause: {text!r}")
        action = (m.group(4) or "").upper()
        policy = DROP if action.startswith("DROP") else FAIL if action.startswith("FAIL") else WARN
        return cls(m.group(1), m.group(2).strip(), policy)


def expect(name: str, sql: str) -> Rule:
    return Rule(name, sql, WARN)


def expect_or_drop(name: str, sql: str) -> Rule:
    return Rule(name, sql, DROP)


def expect_or_fail(name: str, sql: str) -> Rule:
    return Rule(name, sql, FAIL)


def failed_count(rule: Rule) -> Column:
    return F.sum(F.when(rule.passed, 0).otherwise(1)).alias(rule.name)


def apply_rules(df: DataFrame, rules: list[Rule], observation: Observation | str | None = None,
                dataset: str = "dataset") -> DataFrame:
    """Attach rules to a dataset's output.

    ``observation`` (optional) collects ``rows`` and one failed-count per rule
    from the same pass that produces the data: an ``Observation`` for batch
    (read it after the action), or a name for streams (the counts appear per
    micro-batch in the query progress under ``observedMetrics``).
    """
    if not rules:
        return df
    out = df
    fails = [r for r in rules if r.policy == FAIL]
    if fails:
        cond = None
        for r in fails:
            msg = f"expectation {r.name} on {dataset} failed: {r.sql}"
            # "OR spark_partition_id() < 0" is never true but makes the check
            # non-deterministic, so the optimizer cannot push it below the
            # dataset's own filters or aggregates, where it would see rows the
            # dataset never outputs. (A rand() comparison would be folded away.)
            c = F.assert_true(r.passed | (F.spark_partition_id() < 0), F.lit(msg)).isNull()
            cond = c if cond is None else cond & c
        out = out.filter(cond)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"),
                          *[failed_count(r) for r in rules])
    drops = [r for r in rules if r.policy == DROP]
    if drops:
        cond = drops[0].predicate
        for r in drops[1:]:
            cond = cond & r.predicate
        out = out.filter(cond)
    return out


def observed_metrics(observation: Observation, rules: list[Rule], dataset: str) -> list[dict]:
    """Driver-side view of an observation (one small row per rule)."""
    got = observation.get
    rows = got.get("rows", 0) or 0
    return [{"dataset": dataset, "rule": r.name, "policy": r.policy,
             "passed": rows - (got.get(r.name) or 0), "failed": got.get(r.name) or 0}
            for r in rules]


def rule_metrics(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """Pass/fail counts per rule as a DataFrame, one aggregate pass.

    Output ``(dataset, rule, policy, passed, failed)``, one row per rule.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.sum(F.when(r.passed, 0).otherwise(1)).alias(f"_f{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.policy).alias("policy"),
                 F.coalesce(F.col(f"_f{i}"), F.lit(0)).cast("bigint").alias("failed"))
        for i, r in enumerate(rules)])
    return (wide.select(F.col("_rows"), F.inline(entries))
            .select(F.lit(dataset).alias("dataset"), "rule", "policy",
                    (F.col("_rows") - F.col("failed")).alias("passed"), "failed"))
