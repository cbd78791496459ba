import pytest

import __spark_entry__ as contract
from check import compare, connect
from crestline.catalog.oracles import ORACLES
from crestline.catalog.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[0] == "item_id"


def test_sql_exists_for_registered_queries_only():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) - set(ORACLES) == {"ridge_train", "training_job"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, SMALL)
    assert ok, note
