"""Every registered query with an oracle matches DuckDB on the sf0.001 tables."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
# the facts of the model queries train 300-round models; tools/oracle_check.py and the driver run them
NAMES = sorted(n for n in E.oracle_sql() if not n.endswith("_facts"))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["checkpoint", "snapshot_day", "metric", "value", "target", "met", "margin"]


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
