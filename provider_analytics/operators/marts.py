"""County-level aggregates of the provider view.

Each takes providers, one per row, or groups of providers with a
``provider_count``. Counts combine on the map side, so the county, or the missing
county, that holds most providers costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPECIALTY = ["grouping", "classification", "specialization"]


def provider_groups(subset: DataFrame, *keys: str) -> DataFrame:
    """Providers counted per lookup key, so that lookups are joined with few rows.

    ``keys`` are ``zip_code`` and, for specialties, ``primary_taxonomy_code``.
    """
    return subset.groupBy(*keys).agg(F.count(F.lit(1)).alias("provider_count"))


def _provider_count(providers: DataFrame) -> Column:
    if "provider_count" in providers.columns:
        return F.sum("provider_count")
    return F.count(F.lit(1))


def county_provider_counts(providers: DataFrame) -> DataFrame:
    """Providers per county; those without a county are a group of their own."""
    return providers.groupBy("county_name").agg(
        _provider_count(providers).alias("provider_count")
    )


def county_specialty_distribution(providers: DataFrame) -> DataFrame:
    """Providers per county and specialty, and their share of the county.

    County totals come from the counts, whose shuffle both sides of the join use,
    so no task holds all specialties of a county.
    """
    counts = providers.groupBy("county_name", *SPECIALTY).agg(
        _provider_count(providers).alias("provider_count")
    )
    totals = counts.groupBy(F.col("county_name").alias("total_of")).agg(
        F.sum("provider_count").alias("county_total")
    )
    share = F.col("provider_count") / F.col("county_total")
    return (
        counts.join(totals, F.col("county_name").eqNullSafe(F.col("total_of")))
        .withColumn("county_share", share)
        .drop("total_of", "county_total")
    )


def providers_per_capita(providers: DataFrame) -> DataFrame:
    """Providers per 100,000 inhabitants of each county, NULL without a population."""
    inhabitants = F.nullif(F.col("population").try_cast("bigint"), F.lit(0).cast("bigint"))
    return (
        providers.groupBy("fipscounty", "county_name", "population")
        .agg(_provider_count(providers).alias("provider_count"))
        .withColumn(
            "providers_per_100k", F.col("provider_count") * F.lit(100000.0) / inhabitants
        )
    )
