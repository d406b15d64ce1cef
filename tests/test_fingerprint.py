"""Counts worked out before anything was built."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

EXPECTED = {
    "sf0.001": (1500, 1500, 936, 450, 211, 66, 89),
    "sf0.01": (15000, 15000, 9375, 1905, 2619, 653, 883),
    "sf0.1": (150000, 150000, 93750, 19038, 26195, 6522, 8824),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_view_counts(spark, sf):
    view = contract.queries()["view_county"](spark, f"/root/testdata/{sf}")
    found = view.agg(
        F.count(F.lit(1)),
        F.countDistinct("npi"),
        F.count_if(F.col("county_name").isNull()),
        F.count_if(F.col("classification").isNull()),
        F.count_if(F.col("specialization") == ""),
        F.count_if(F.col("entity_name") == ""),
        F.count_if(F.col("entity_type_code").isNull()),
    ).first()
    assert tuple(found) == EXPECTED[sf]


@pytest.mark.parametrize("name", ["zip_primary_county", "zip_primary_county_numeric"])
@pytest.mark.parametrize("sf", EXPECTED)
def test_one_county_per_zip(spark, sf, name):
    assert contract.queries()[name](spark, f"/root/testdata/{sf}").count() == 60


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
