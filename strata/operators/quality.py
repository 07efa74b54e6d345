"""Data-quality checks as DataFrame operators (one scan each where possible)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.rules import Rule
from strata.session import scratch_path
from strata.sinks.tables import materialize


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, null_count, row_count)`` for every column, one scan."""
    cols = columns or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"_z{i}")
                    for i, c in enumerate(cols)])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.coalesce(F.col(f"_z{i}"), F.lit(0)).cast("bigint").alias("null_count"))
                        for i, c in enumerate(cols)])
    return wide.select(F.inline(entries), F.col("_n").alias("row_count"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their count (partial aggregation
    collapses a hot key map-side)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_rows, target_rows, difference, reconciled`` (the
    target count is a scalar subquery)."""
    return (source.agg(F.count(F.lit(1)).alias("source_rows"))
            .select("source_rows", target.agg(F.count(F.lit(1))).scalar().alias("target_rows"))
            .select("source_rows", "target_rows",
                    (F.col("source_rows") - F.col("target_rows")).alias("difference"),
                    (F.col("source_rows") == F.col("target_rows")).alias("reconciled")))


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str],
            parent_keys: list[str]) -> DataFrame:
    """Child rows whose foreign key has no parent (``NOT EXISTS``). NULL keys
    are not orphans (they reference nothing)."""
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)])
    notnull = F.lit(True)
    for ck in child_keys:
        notnull = notnull & F.col(ck).isNotNull()
    return child.filter(notnull).join(p, child_keys, "left_anti")


def orphan_summary(name: str, child: DataFrame, parent: DataFrame, child_keys: list[str],
                   parent_keys: list[str]) -> DataFrame:
    """``(relationship, child_rows, orphan_rows)`` for one foreign key: child
    rows are counted per key before they are shuffled (a hot key sends one row
    per task), then joined to the distinct parent keys and summed."""
    p = (parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)])
         .distinct().withColumn("_hit", F.lit(True)))
    present = F.lit(True)
    for ck in child_keys:
        present = present & F.col(ck).isNotNull()
    miss = present & F.col("_hit").isNull()
    per_key = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.join(p, child_keys, "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(miss, F.col("_n"))), F.lit(0)).alias("orphan_rows")).select(
        F.lit(name).alias("relationship"), "child_rows", "orphan_rows")


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Validate -> store / reject in one pass: adds ``_reasons`` (names of the
    broken rules, in rule order) and ``_status`` (``valid``/``quarantined``).
    Split with ``split_quarantine``; persist or checkpoint the annotated frame
    first if both halves are written."""
    reasons = F.filter(F.array(*[F.when(~r.passed, F.lit(r.name)) for r in rules]),
                       lambda x: x.isNotNull())
    return (df.withColumn("_reasons", reasons)
            .withColumn("_status", F.when(F.size("_reasons") == 0, "valid")
                        .otherwise("quarantined")))


def split_quarantine(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (annotated.filter(F.col("_status") == "valid"),
            annotated.filter(F.col("_status") == "quarantined"))


def schema_diff(spark: SparkSession, expected: T.StructType, actual: T.StructType) -> DataFrame:
    """Expected vs actual columns: ok / missing / unexpected / type_mismatch
    (schema metadata only, no data scan)."""
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for name in list(exp) + [n for n in act if n not in exp]:
        e, a = exp.get(name), act.get(name)
        status = ("missing" if a is None else "unexpected" if e is None
                  else "ok" if e == a else "type_mismatch")
        rows.append((name, e, a, status))
    return spark.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, status string")


def json_field_drift(df: DataFrame, column: str, expected_fields: list[str]) -> DataFrame:
    """Schema drift of a semi-structured column: for every field seen in the
    data or expected, ``rows_present`` and ``status`` (``ok``, ``missing``
    when expected but never present, ``unexpected`` when not expected)."""
    seen = (df.select(F.explode(F.json_object_keys(F.col(column))).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("rows_present")))
    exp = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(f) for f in expected_fields])).alias("field"),
        F.lit(True).alias("_expected"))
    j = seen.join(exp, "field", "full_outer")
    return j.select(
        "field", F.coalesce("rows_present", F.lit(0)).cast("bigint").alias("rows_present"),
        F.when(F.col("_expected").isNull(), "unexpected")
         .when(F.col("rows_present").isNull(), "missing").otherwise("ok").alias("status"))


def nested_types(df: DataFrame, column: str) -> DataFrame:
    """path, kind, nodes: every path of a JSON text column with the kinds of
    value found there, at any depth. Objects add ``.name``, arrays ``[]``; text
    that is no JSON is the kind ``unparsable`` of the root, NULL text is left
    out. One round per level of nesting: containers are exploded into the rows
    of the next level, which is stored; nothing but its emptiness reaches the
    driver."""
    spark = df.sparkSession
    level = df.where(F.col(column).isNotNull()).select(
        F.lit("$").alias("path"), F.try_parse_json(F.col(column)).alias("v"))
    described = F.schema_of_variant("v")
    kind = (F.when(F.col("v").isNull(), "unparsable").when(F.is_variant_null("v"), "null")
            .when(described.startswith("OBJECT"), "object").when(described.startswith("ARRAY"), "array")
            .when(described.startswith("DECIMAL"), "decimal").otherwise(F.lower(described)))
    counts = None
    while True:
        level = materialize(level.withColumn("kind", kind), scratch_path(spark, "nested-level"))
        found = level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("nodes"))
        counts = found if counts is None else counts.unionByName(found)
        inner = level.where("kind IN ('object', 'array')")
        if inner.isEmpty():
            return counts
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
        level = inner.select("path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            F.concat("path", step).alias("path"), F.col("value").alias("v"))


def nested_drift(df: DataFrame, column: str, expected: dict[str, str]) -> DataFrame:
    """``nested_types`` against the expected kind of each path: ``ok``,
    ``type_mismatch``, ``unexpected`` path, or ``missing`` (never present; no
    kind). A JSON null fits any kind."""
    seen = nested_types(df, column)
    exp = df.sparkSession.createDataFrame(sorted(expected.items()), "path string, expected string")
    status = (F.when(F.col("expected").isNull(), "unexpected").when(F.col("kind").isNull(), "missing")
              .when(F.col("kind").isin("null") | (F.col("kind") == F.col("expected")), "ok").otherwise("type_mismatch"))
    return seen.join(exp, "path", "full_outer").select(
        "path", "kind", F.coalesce("nodes", F.lit(0)).cast("bigint").alias("nodes"), status.alias("status"))


def minimal_dependencies(df: DataFrame, columns: list[str], max_lhs: int = 3) -> list[tuple[tuple[str, ...], str]]:
    """All minimal functional dependencies ``X -> a`` with at most ``max_lhs``
    columns on the left (NULL counts as a value), by a level-wise search.

    ``X -> a`` holds when no group of X has two values of a. A level groups by
    each of its left sides once and judges all its columns a there: their 64-bit
    digests differ within a group only if the values do, so the smallest and the
    largest digest are compared, and one row per left side reaches the driver.
    Left out are sets that contain a smaller dependency's left side for the same
    column, and sets one of whose columns depends on the others, as they determine
    no more than those do. Each dependency found by digests is then confirmed by
    grouping on its columns themselves."""
    from itertools import combinations

    found: list[tuple[tuple[str, ...], str]] = []
    holds = lambda s, a: any(b == a and set(x) <= set(s) for x, b in found)
    for level in range(0, max_lhs + 1):
        tests = {}
        for s in combinations(columns, level):
            if not any(holds(set(s) - {b}, b) for b in s):
                tests[s] = [a for a in columns if a not in s and not holds(s, a)]
        tests = {s: rhs for s, rhs in tests.items() if rhs}
        if not tests:
            break
        for s, rhs in _undisputed(df, tests).items():
            # digests may collide
            if rhs and not fd_violations(df, list(s), rhs).isEmpty():
                rhs = [a for a in rhs if fd_violations(df, list(s), [a]).isEmpty()]
            found += [(s, a) for a in rhs]
    return found


def _undisputed(df: DataFrame, tests: dict[tuple[str, ...], list[str]]) -> dict[tuple[str, ...], list[str]]:
    """For each left side those of its columns whose digests are the same
    throughout every group; 16 left sides in a job."""
    def part(i, s, rhs):
        digests = [_digest(df, a) for a in rhs]
        groups = df.groupBy(*[_told(df, c) for c in s]).agg(F.array(*[F.min(d) != F.max(d) for d in digests]).alias("_differ"))
        # without rows there is no group, and nothing differs
        differ = [F.coalesce(F.max(F.col("_differ")[k]), F.lit(False)) for k in range(len(rhs))]
        return groups.agg(F.array(*differ).alias("differ")).select(F.lit(i).alias("i"), "differ")

    parts, rows = [part(i, s, rhs) for i, (s, rhs) in enumerate(tests.items())], {}
    for k in range(0, len(parts), 16):
        rows |= {r["i"]: r["differ"] for r in reduce(DataFrame.unionAll, parts[k:k + 16]).collect()}
    return {s: [a for a, differs in zip(rhs, rows[i], strict=True) if not differs]
            for i, (s, rhs) in enumerate(tests.items())}


def _told(df: DataFrame, c: str) -> Column:
    """The column itself where different text means another value, else its
    text (zeros of either sign are equal but not the same, also nested ones)."""
    kind = df.select(c).schema[0].dataType
    if isinstance(kind, T.StringType):
        return F.col(c).cast("string")
    plain = isinstance(kind, T.IntegralType | T.DecimalType | T.BooleanType | T.BinaryType | T.DateType
                       | T.TimestampType | T.TimestampNTZType)
    return F.col(c) if plain else _cell(c)


def _digest(df: DataFrame, c: str) -> Column:
    """64 bits, the same for the same value: whole numbers themselves, else a hash."""
    if isinstance(df.select(c).schema[0].dataType, T.IntegralType):
        return F.coalesce(F.col(c).cast("bigint"), F.xxhash64(F.lit("null")))
    return F.xxhash64(_told(df, c))


def _cell(c: str):
    """A value that tells NULL from every other value, as text."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def fd_violations(df: DataFrame, lhs: list[str], rhs: list[str]) -> DataFrame:
    """Functional dependency ``lhs -> rhs`` violations: lhs values that map to
    more than one rhs value (NULL counts as a value)."""
    return (df.groupBy(*lhs).agg(F.count_distinct(F.struct(*rhs)).alias("distinct_rhs"))
            .filter(F.col("distinct_rhs") > 1))


def type_check(df: DataFrame, column: str, to: T.DataType | str) -> Column:
    """TRUE when the raw value is present but does not convert."""
    return F.col(column).isNotNull() & F.col(column).try_cast(to).isNull()
