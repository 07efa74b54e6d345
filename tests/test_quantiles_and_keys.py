"""Exact quantiles of hot groups, dense surrogate keys, cohort bitmaps."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import quantiles as Q
from strata.operators.quantiles import exact_quantiles
from strata.operators.surrogates import dense_keys
from strata.plans import kpi

SHARES = {"low": "0.01", "median": "0.5", "p95": "0.95", "all": "1", "none": "0"}


def brute(values, share):
    v = sorted((x for x in values if x is not None), key=lambda x: (math.isnan(x), x))
    return v[max(1, math.ceil(round(float(share) * len(v), 9))) - 1] if v else None


@pytest.mark.parametrize("bins", [4096, 2])
def test_quantiles_equal_a_sort(spark, monkeypatch, bins):
    monkeypatch.setattr(Q, "BINS", bins)
    rnd = random.Random(1)
    inf, nan = float("inf"), float("nan")
    groups = {"normal": [rnd.gauss(0, 1) for _ in range(500)], "hot": [7.5] * 400 + [1.0, 9.0], "one": [3.0], "null": [None] * 4,
              None: [1.0, 2.0, None], "wide": [10.0 ** rnd.randint(-300, 300) * rnd.choice([1, -1]) for _ in range(60)],
              "odd": [nan, inf, -inf, 0.0, 1.0, nan, 5e-324, 0.0], "ends": [-inf, inf], "huge": [1.7e308, -1.7e308, 0.0]}
    if bins == 2:
        groups = {k: groups[k] for k in ("hot", "one", "null", "odd", "ends", None)}
    df = spark.createDataFrame([(k, x, 1) for k, v in groups.items() for x in v], "g string, x double, n int").repartition(4)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "x", SHARES).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert got[k].n == sum(x is not None for x in v)
        for name, share in SHARES.items():
            want = brute(v, share)
            have = got[k][name]
            assert have == want or (want is not None and math.isnan(want) and math.isnan(have)), (k, name, have, want)


def test_quantiles_of_a_table_without_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, x double"), ["g"], "x", SHARES).count() == 0


def test_a_group_of_200_000_is_never_in_one_task(spark):
    df = spark.range(200_000, numPartitions=8).select(F.lit("g").alias("g"), F.hash("id").cast("double").alias("x"))
    r = exact_quantiles(df, ["g"], "x", {"p95": "0.95"}).first()
    want = sorted(x[0] for x in df.select("x").collect())
    assert (r.n, r.p95) == (200_000, want[190_000 - 1])
    plan = df.groupBy("g", Q._bin(F.col("x"), F.lit(-1e9), F.lit(1e9)).alias("b")).count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2                     # counted before the shuffle


def test_dense_keys_stay_and_grow_without_gaps(spark):
    rows = lambda ids: spark.createDataFrame([(i % 7 if i % 11 else None, f"k{i}") for i in ids], "a long, b string").repartition(5)
    first = dense_keys(rows([*range(50), *range(20)]), ["a", "b"], "sk")
    second = dense_keys(rows(range(30, 90)), ["a", "b"], "sk", first)
    one, two = ({(r.a, r.b): r.sk for r in df.collect()} for df in (first, second))
    assert sorted(one.values()) == list(range(1, 51)) and sorted(two.values()) == list(range(1, 91))
    assert all(two[k] == v for k, v in one.items())
    again = dense_keys(rows(range(90)), ["a", "b"], "sk", second)
    assert {(r.a, r.b): r.sk for r in again.collect()} == two
    assert dense_keys(rows([]).where("false"), ["a", "b"], "sk").count() == 0


def test_cohort_bitmaps_over_bucket_borders(spark):
    import datetime as dt
    rnd = random.Random(5)
    rows = [(rnd.choice([rnd.randrange(200_000), rnd.randrange(40), None]), dt.datetime(2020 + rnd.randrange(2), rnd.randint(1, 12), 3))
            for _ in range(3000)]
    orders = spark.createDataFrame(rows, "o_custkey long, o_orderdate timestamp_ntz")
    first, active = {}, set()
    for c, d in rows:
        if c is not None:
            first[c] = min(first.get(c, d), d)
            active.add((c, d))
    want = {}
    for c, d in active:
        k = (first[c].date().replace(day=1), d.date().replace(day=1))
        want[k] = want.get(k, 0) + 1
    got = kpi.union_count(kpi.cohort_bitmaps(orders), F.col("cohort"), F.col("month")).collect()
    assert {(r._k0, r._k1): r.customers for r in got} == want
    total = kpi.union_count(kpi.cohort_bitmaps(orders), F.lit(1)).first().customers
    assert total == len(first)
