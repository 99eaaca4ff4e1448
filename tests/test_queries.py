import pytest

import __spark_entry__ as contract
from brindle.plans.catalog import QUERIES
from brindle.plans.oracles import ORACLES
from oracle import difference

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).columns == ["items", "freq"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, name):
    assert difference(spark, SF_DIR, QUERIES[name], ORACLES[name]) == ""
