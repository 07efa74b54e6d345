"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from strata.plans import registry  # noqa: E402

E.queries()                          # registers the plan modules
QUERIES = registry.QUERIES
SQL = registry.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    plan = plan_text(df)
    # no all-pairs operators anywhere
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key not in SQL:
        assert len(rows) > 0
        return
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, res.fetchall())


@pytest.mark.parametrize("key, order", [
    ("bronze_dq_summary", lambda r: r["event_type"]),
    ("top_artists_by_year", lambda r: (-r["total_number_of_songs"], -r["year"])),
    ("top20_products_europe_3y", lambda r: (-r["revenue"], r["p_partkey"]))])
def test_result_order(spark, key, order):
    rows = QUERIES[key](spark, SF_SMALL).collect()
    assert [order(r) for r in rows] == sorted(order(r) for r in rows) and len(rows) > 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "event_count" in df.columns
