"""Every registered query against its SQL, at the scale of the correctness gate."""

import __spark_entry__ as contract
import pytest

from siltframe.session import scratch
from workload.oracle import compare, oracle_connection
from workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["ID_SITE", "ID_ENTITY", "site_name", "entity_name", "dates", "samples", "age_model", "pollen_counts"]
    assert df.count() > 0


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, con, key):
    with scratch(spark):
        fault = compare(contract.queries()[key](spark, SF), con.sql(contract.oracle_sql()[key]))
    assert fault == ""
