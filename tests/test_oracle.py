import pytest

import __spark_entry__ as registered
from checks.queries import QUERIES
from tests.compare import both, oracle_connection

FOLDER = "/root/testdata/sf0.01"

# Row counts the provided tables must give.
ROWS = {
    "deleted_keys": 11_058,
    "live_rows": 10_638,
    "global_ordinal": 15_000,
    "running_count": 10_000,
    "latest_per_key": 150,
    "latest_live": 203,
    "quality_report": 75 + 100,
    "union_fill": 1_600,
    "message_envelope": 536,
    "epoch_to_text": 10_000,
}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    (columns, rows), (sql_columns, sql_rows) = both(spark, name, FOLDER, con)
    assert columns == sql_columns
    assert len(rows) == len(sql_rows)
    assert rows == sql_rows
    assert len(rows) == ROWS.get(name, len(rows))
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registered.oracle_sql()) <= set(registered.queries())
