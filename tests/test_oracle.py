"""Every registered query against its SQL, on the smallest data set."""

import pytest
from oracle import compare, connect

from catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
# Only these read files that need Python inside tasks.
PYTHON_SCANS = {
    "delimited_preamble", "delimited_multiline", "payload_kinds", "workbook_scan", "archive_scan", "multi_file_consolidate", "file_verdicts",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert name in PYTHON_SCANS or ("InPandas" not in plan and "Python" not in plan)
    rows, difference = compare(df, con, ORACLE[name])
    assert not difference
    assert rows > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
