"""Hot-key joins, nested drift, dependency search against brute force."""

import itertools
import json
import random
import re
from collections import Counter

import pytest

from strata.operators.quality import minimal_dependencies, nested_drift, nested_types
from strata.operators.skew import hot_keys, join_hot


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("few", [100_000, 1])
def test_hot_join_equals_the_plain_join(spark, how, few):
    rnd = random.Random(3)
    left = [(rnd.choice([1, 1, 1, 2, 2, None, rnd.randrange(3, 400)]), i) for i in range(3000)]
    right = [(k, f"r{k}-{c}") for k in range(1, 300) for c in range(1 + (k == 2) * 3)] + [(None, "null")]
    a = spark.createDataFrame(left, "k long, i int").repartition(4)
    b = spark.createDataFrame(right, "k long, name string")
    assert {1, 2} <= set(hot_keys(a, "k", 0.05)) and len(hot_keys(a, "k", 0.05)) < 5
    assert rows_of(join_hot(a, b, "k", how, 0.05, few)) == rows_of(a.join(b, "k", how))


def test_cold_rows_alone_are_shuffled(spark):
    """One key with a third of the rows: what is left for the shuffle is even."""
    a = spark.range(90_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id")
    assert hot_keys(a, "k") == [7]
    left = a.where("NOT k <=> 7").groupBy("k").count().agg({"count": "max"}).first()[0]
    assert left == 1
    b = spark.range(100).selectExpr("id AS k", "'n' AS name")
    assert join_hot(a, b, "k", "inner").count() == 30_001 + a.where("k < 100 AND k <> 7").count()
    with pytest.raises(ValueError):
        join_hot(a, b, "k", "full")


def brute_types(texts):
    out = Counter()

    def walk(path, v):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", int: "bigint", float: "decimal",
                type(None): "null"}[type(v)]
        out[path, kind] += 1
        if isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{k}", x)
        elif isinstance(v, list):
            for x in v:
                walk(path + "[]", x)

    for t in texts:
        if t is not None:
            try:
                walk("$", json.loads(t))
            except ValueError:
                out["$", "unparsable"] += 1
    return out


def test_nested_types_at_any_depth(spark):
    texts = ['{"a": {"b": [1, 2.5, "x", {"c": [[]]}]}, "d": null}', "[1, [2, {}], true]", '"text"', "{bad", None, "7", "{}",
             '{"a": {"b": 1}}', '{"a": []}'] * 3
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    assert Counter({(r.path, r.kind): r.nodes for r in nested_types(df, "j").collect()}) == brute_types(texts)
    drift = {(r.path, r.kind): r.status for r in nested_drift(df, "j", {"$.a": "object", "$.d": "string", "$.z": "bigint"}).collect()}
    assert drift["$.a", "object"] == "ok" and drift["$.a", "array"] == "type_mismatch" and drift["$.d", "null"] == "ok"
    assert drift["$.z", None] == "missing" and drift["$", "array"] == "unexpected"
    assert nested_types(df.where("false"), "j").count() == 0


def brute_dependencies(rows, columns, most):
    found = []
    for n in range(most + 1):
        for left in itertools.combinations(columns, n):
            for a in columns:
                if a in left or any(b == a and set(x) <= set(left) for x, b in found):
                    continue
                seen = {}
                if all(seen.setdefault(tuple(r[c] for c in left), r[a]) == r[a] for r in rows):
                    found.append((left, a))
    return set(found)


@pytest.mark.parametrize("seed", range(3))
def test_dependencies_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(60):
        a, b = rnd.randrange(6), rnd.choice([None, 1, 2])
        rows.append({"a": a, "b": b, "c": a % 3 if seed else rnd.randrange(2), "d": (a * 7 + (b or 0)) % 5, "e": 1,
                     "f": i if seed == 2 else rnd.randrange(4)})
    cols = list("abcdef")
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} int" for c in cols))
    assert set(minimal_dependencies(df, cols, 3)) == brute_dependencies(rows, cols, 3)
    assert minimal_dependencies(df, cols, 1) == [x for x in minimal_dependencies(df, cols, 3) if len(x[0]) <= 1]


def test_dependency_levels_group_once_per_left_side(spark, monkeypatch):
    """No row is multiplied by the sets of a level, and no left side is grouped
    that has a column which depends on its others."""
    rnd = random.Random(5)
    rows = [(a, a % 7, rnd.randrange(9), rnd.randrange(9)) for a in (rnd.randrange(30) for _ in range(300))]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    plans, collect = [], type(df).collect

    def collected(self):
        plans.append(self._jdf.queryExecution().toString())
        return collect(self)

    monkeypatch.setattr(type(df), "collect", collected)
    assert minimal_dependencies(df, list("abcd"), 2) == [(("a",), "b")]
    assert plans and not any("Generate" in p for p in plans)
    grouped = Counter(re.sub(r"#\d+", "", k) for p in plans for k in re.findall(
        r"HashAggregate\(keys=\[([^]]*)\], functions=\[partial_min", p.partition("== Physical Plan ==")[2]))
    assert grouped == Counter(["", "a", "b", "c", "d", "a, c", "a, d", "b, c", "b, d", "c, d"])


def test_dependencies_of_many_left_sides_and_of_equal_digests(spark):
    rnd = random.Random(8)
    cols = list("abcdefg")
    rows = [{c: rnd.choice([None, "x", "null", "=x", str(rnd.randrange(4))]) for c in cols} | {"g": rnd.randrange(40)} for _ in range(25)]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} {'long' if c == 'g' else 'string'}" for c in cols))
    assert set(minimal_dependencies(df, cols, 2)) == brute_dependencies(rows, cols, 2)
    # NULL has the digest of this number; k determines neither, l determines both
    same = spark.sql("SELECT xxhash64('null')").first()[0]
    df = spark.createDataFrame([(1, 1, None, 5), (1, 2, same, 5), (2, 3, 7, 5)], "k int, l int, v long, w long")
    assert minimal_dependencies(df, list("klvw"), 1) == [((), "w"), (("l",), "k"), (("l",), "v"), (("v",), "k"), (("v",), "l")]


def test_dependencies_by_type_and_without_rows(spark):
    """Zeros of either sign, also nested, dates, times and decimals; a key and no rows."""
    df = spark.sql("""SELECT * FROM VALUES (1, 0D, array(0D), DATE'2020-01-01', TIMESTAMP_NTZ'2020-01-01 00:00:00', 1.50),
        (1, -0D, array(-0D), DATE'2020-01-01', TIMESTAMP_NTZ'2020-01-01 00:00:01', 1.50),
        (2, 1D, array(1D), NULL, NULL, NULL) AS t(k, z, n, d, t, m)""")
    assert set(minimal_dependencies(df, ["k", "z", "n", "d", "t", "m"], 1)) == {
        *[((x,), y) for x in "kzndm" for y in "kdm" if x != y], *[(("t",), y) for y in "kdm"], (("z",), "n"), (("n",), "z"),
        (("t",), "z"), (("t",), "n")}
    assert minimal_dependencies(df.where("false"), ["k", "z"], 2) == [((), "k"), ((), "z")]
    assert minimal_dependencies(df.limit(1), ["k", "z"], 2) == [((), "k"), ((), "z")]
