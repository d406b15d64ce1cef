"""County population and the county that stands for each ZIP.

The crosswalk and the county lists may hold any number of copies of a row. They
are reduced to distinct rows before each shuffle, so that a ZIP or county that
holds a large share of the input costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleanse import five_characters

# How many copies of a crosswalk row one generated array holds.
COPIES_PER_STEP = 10_000


def county_population(county_pop: DataFrame, fips: DataFrame) -> DataFrame:
    """Distinct ``fipscounty, countyname_fips, population`` of counties in both inputs."""
    names = fips.select("fipscounty", "countyname_fips").distinct()
    populations = county_pop.select(
        F.concat("state", "county").alias("fips_code"), "population"
    ).distinct()
    return names.join(
        populations,
        five_characters(names.fipscounty.cast("string")) == populations.fips_code,
    ).select("fipscounty", "countyname_fips", "population")


def _largest_first(population_order: str) -> Column:
    """``"text"`` compares digits as text with NULL on top, ``"numeric"`` as numbers."""
    if population_order == "text":
        return F.desc_nulls_first("population")
    if population_order == "numeric":
        return F.col("population").try_cast("bigint").desc_nulls_last()
    raise ValueError(
        f"population_order must be 'text' or 'numeric', not {population_order!r}"
    )


def _repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, the copies of one row made by many tasks.

    A row is first repeated once per ``COPIES_PER_STEP``. Those are spread over a
    fixed number of partitions, which adaptive execution leaves as they are,
    while it would merge them by their small size.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = F.expr(f"sequence(0, ({copies} - 1) div {COPIES_PER_STEP})")
    in_step = F.expr(f"int(least({copies} - step * {COPIES_PER_STEP}, {COPIES_PER_STEP}))")
    return (
        rows.withColumn("step", F.explode(steps))
        .repartition(partitions, *rows.columns, "step")
        .withColumn("copy", F.explode(F.array_repeat(F.lit(True), in_step)))
        .drop("step", "copy", copies)
    )


def zip_county_rank(
    crosswalk: DataFrame, counties: DataFrame, population_order: str = "text"
) -> DataFrame:
    """Every crosswalk row with a known county, ranked by population within its ZIP.

    ``rank`` counts crosswalk rows, copies included. Copies are collapsed into a
    weight before anything is shuffled and written out again at the end, so a
    window holds at most one row per county of the ZIP.
    """
    order = _largest_first(population_order)
    weighted = (
        crosswalk.groupBy("zip", "county")
        .agg(F.count(F.lit(1)).alias("copies"))
        .join(counties, F.col("county") == F.col("fipscounty"))
        .withColumn("level", F.dense_rank().over(Window.partitionBy("zip").orderBy(order)))
    )
    up_to_level = Window.partitionBy("zip").orderBy("level")
    same_level = Window.partitionBy("zip", "level")
    rank = F.sum("copies").over(up_to_level) - F.sum("copies").over(same_level) + 1
    ranked = weighted.select(
        "zip", "county", "countyname_fips", "population", rank.alias("rank"), "copies"
    )
    return _repeated(ranked, "copies")


def _first_in_group(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """One row per group. Spark keeps the first per group and map task before it shuffles."""
    position = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("position", position).where("position = 1").drop("position")


def _zip_candidates(crosswalk: DataFrame, counties: DataFrame) -> DataFrame:
    pairs = crosswalk.select("zip", "county").distinct()
    return pairs.join(counties, F.col("county") == F.col("fipscounty")).drop("fipscounty")


def zip_primary_county(
    crosswalk: DataFrame, counties: DataFrame, population_order: str = "text"
) -> DataFrame:
    """The rank-1 county of each ZIP; ties go to the lowest county, then name."""
    return _first_in_group(
        _zip_candidates(crosswalk, counties),
        "zip",
        _largest_first(population_order),
        F.asc("county"),
        F.asc("countyname_fips"),
    )


def zip_lookup(
    crosswalk: DataFrame, counties: DataFrame, population_order: str = "text"
) -> DataFrame:
    """``zip_primary_county`` keyed by the five-character ZIP that providers carry.

    Padding cuts longer numbers, so several ZIP numbers can share a key. The best
    of them is also first among its own ZIP, so one pass picks it. An integer
    padded and cut to five characters has under 120,000 forms: that bounds the
    rows of this table whatever the size of the input.
    """
    keyed = _zip_candidates(crosswalk, counties).withColumn(
        "zip_code", five_characters(F.col("zip").cast("int").cast("string"))
    )
    return _first_in_group(
        keyed.where("zip_code IS NOT NULL"),
        "zip_code",
        _largest_first(population_order),
        F.asc("county"),
        F.asc("countyname_fips"),
        F.asc("zip"),
    ).select(
        "zip_code",
        F.col("county").alias("fipscounty"),
        F.col("countyname_fips").alias("county_name"),
        "population",
    )
