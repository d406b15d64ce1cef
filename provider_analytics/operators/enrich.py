"""Providers with their county and taxonomy details, one row per provider."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VIEW_COLUMNS = [
    "npi",
    "entity_type_code",
    "entity_name",
    "practice_address",
    "county_name",
    "classification",
    "grouping",
    "specialization",
]

# Number of groups among which providers without a taxonomy code are shared out.
NULL_KEY_SPREAD = 4096


def taxonomy_lookup(nucc: DataFrame) -> DataFrame:
    """One row per code, so that joining it cannot multiply providers.

    Of several rows with one code the first by classification, grouping and
    specialization stays. ``min`` combines on the map side, so copies of a code
    collapse before the shuffle.
    """
    details = F.struct("classification", "grouping", "specialization")
    return (
        nucc.where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.min(details).alias("details"))
        .select("code", "details.*")
    )


def with_county(providers: DataFrame, zips: DataFrame) -> DataFrame:
    """LEFT JOIN ``geography.zip_lookup``: unmatched providers keep NULLs.

    The lookup has under 120,000 short rows by the form of its key, hence the
    broadcast: providers are not shuffled.
    """
    return providers.join(F.broadcast(zips), "zip_code", "left")


def with_taxonomy(
    providers: DataFrame, taxonomy: DataFrame, spread_by: str = "npi"
) -> DataFrame:
    """LEFT JOIN ``taxonomy_lookup``: unmatched providers keep NULLs.

    Nothing bounds the length of this list, so there is no broadcast hint. Spark
    broadcasts it when its size is under ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles both sides otherwise. The second key serves that case: it spreads
    the providers without a code, which match nothing, by ``spread_by``, and it
    has the list shuffled for the join itself, as adaptive execution requires
    before it splits the partition of a code that many providers share.
    """
    row_spread = F.when(
        F.col("primary_taxonomy_code").isNull(),
        F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEY_SPREAD)) + 1,
    ).otherwise(F.lit(0).cast("bigint"))
    # Always 0. A literal would be folded into the join and the key be lost.
    code_spread = F.pmod(F.xxhash64("code"), F.lit(1).cast("bigint"))
    return (
        providers.withColumn("row_spread", row_spread)
        .join(
            taxonomy.withColumn("code_spread", code_spread),
            (F.col("primary_taxonomy_code") == F.col("code"))
            & (F.col("row_spread") == F.col("code_spread")),
            "left",
        )
        .drop("code", "row_spread", "code_spread")
    )


FULL_COLUMNS = [*VIEW_COLUMNS, "fipscounty", "population"]


def provider_rows(subset: DataFrame, zips: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The subset's columns and the details of county and taxonomy, a row per subset row."""
    enriched = with_taxonomy(with_county(subset, zips), taxonomy)
    return enriched.select(*subset.columns, *[c for c in FULL_COLUMNS if c not in subset.columns])


def provider_county_full(
    subset: DataFrame, zips: DataFrame, taxonomy: DataFrame
) -> DataFrame:
    """The provider view with the county's FIPS code and population."""
    return provider_rows(subset, zips, taxonomy).select(*FULL_COLUMNS)


def view_county(subset: DataFrame, zips: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The eight-column provider view.

    Relies on ``npi`` being unique in ``subset`` (``quality.key_violations``) and
    on one row per key in both lookups, so no final de-duplication is needed.
    """
    return provider_county_full(subset, zips, taxonomy).select(*VIEW_COLUMNS)


def view_county_late_dedup(
    subset: DataFrame, zips: DataFrame, nucc: DataFrame
) -> DataFrame:
    """The view for tables in which neither npi nor taxonomy codes need be unique.

    The generic form: one row per npi, the first by classification, grouping and
    specialization, then by the provider's own columns, NULL first; rows without an npi
    count as one. It shuffles every provider, so ``view_county`` is the one to use. A
    code listed M times multiplies its N providers before they are reduced; each task
    passes on one row per npi.
    """
    joined = with_taxonomy(with_county(subset, zips), nucc).select(*VIEW_COLUMNS)
    details = ["classification", "grouping", "specialization"]
    others = [name for name in VIEW_COLUMNS if name not in ("npi", *details)]
    place = F.row_number().over(Window.partitionBy("npi").orderBy(*details, *others))
    return joined.withColumn("place", place).where("place = 1").select(*VIEW_COLUMNS)
