import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators.rules import (Rule, apply_rules, expect, expect_or_drop, expect_or_fail,
                                    observed_metrics, rule_metrics)


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [(1, 10.0, "a"), (2, -1.0, "b"), (3, None, "c"), (None, 5.0, "d")],
        "id int, v double, s string")


def test_null_violates_and_warn_keeps_rows(df):
    out = apply_rules(df, [expect("pos", "v > 0")])
    assert out.count() == 4
    m = {r["rule"]: (r["passed"], r["failed"]) for r in
         rule_metrics(df, [expect("pos", "v > 0")], "t").collect()}
    assert m["pos"] == (2, 2)  # -1 fails, NULL fails


def test_drop_removes_false_and_null(df):
    out = apply_rules(df, [expect_or_drop("pos", "v > 0"), expect_or_drop("id", "id IS NOT NULL")])
    assert sorted(r["id"] for r in out.collect()) == [1]


def test_fail_raises_on_violation(df):
    out = apply_rules(df, [expect_or_fail("has_id", "id IS NOT NULL")], dataset="t")
    with pytest.raises(Exception, match="has_id"):
        out.collect()


def test_fail_passes_clean_data(df):
    out = apply_rules(df.filter("id IS NOT NULL"), [expect_or_fail("has_id", "id IS NOT NULL")])
    assert out.count() == 3


def test_fail_rule_is_not_pushed_below_aggregate(spark):
    """Fail rules on group keys of an aggregate must see only the rows the
    dataset outputs, not the pre-filter input."""
    raw = spark.createDataFrame([(1, "x"), (None, "y"), (2, "x")], "k int, t string")
    dataset = raw.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    out = apply_rules(dataset, [expect_or_fail("k_ok", "k IS NOT NULL")])
    assert out.count() == 2


def test_fail_rule_unused_column_still_checked(df):
    out = apply_rules(df, [expect_or_fail("v_ok", "v IS NOT NULL")]).select("s")
    with pytest.raises(Exception, match="v_ok"):
        out.collect()


def test_observation_counts_every_rule_before_drops(df):
    rules = [expect("pos", "v > 0"), expect_or_drop("id", "id IS NOT NULL")]
    obs = Observation("t")
    rows = apply_rules(df, rules, obs).collect()
    assert len(rows) == 3
    m = {x["rule"]: x for x in observed_metrics(obs, rules, "t")}
    assert m["pos"]["failed"] == 2 and m["id"]["failed"] == 1
    assert all(x["passed"] + x["failed"] == 4 for x in m.values())


def test_sql_constraint_clause():
    r = Rule.from_sql("CONSTRAINT valid_title EXPECT (song_title IS NOT NULL)")
    assert (r.name, r.sql, r.policy) == ("valid_title", "song_title IS NOT NULL", "warn")
    assert Rule.from_sql("CONSTRAINT a EXPECT (x > 0) ON VIOLATION DROP ROW").policy == "drop"
    assert Rule.from_sql("constraint a expect (f(x) > 0) on violation fail update").policy == "fail"
    with pytest.raises(ValueError):
        Rule.from_sql("EXPECT x")
    with pytest.raises(ValueError):
        Rule("a", "x", "ignore")
