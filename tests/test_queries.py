"""Every query of the catalogue against its SQL, on the smallest tables."""

import compare
import pytest
from tallyspark.plans import builds, catalogue, records  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare.differences(spark, catalogue.QUERIES[name], catalogue.ORACLES[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows_only(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4
