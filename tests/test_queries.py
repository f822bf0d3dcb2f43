"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import compare, duck

from goldweft.oracles import ORACLES
from goldweft.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    compare(spark, con, name, QUERIES[name], ORACLES[name], SF)


def test_feed_has_the_expected_counts(spark):
    row = QUERIES["class_counts"](spark, SF).first()
    assert (row.personal_records, row.bank_records, row.location_records) == (150, 1500, 135)
    assert (row.professional_records, row.network_records) == (128, 120)
    assert (row.unknown_records, row.empty_data_count) == (2, 2)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 146
