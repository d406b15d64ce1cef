"""Checks on keys, row counts and values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cleanse import blank_to_null


class QualityError(Exception):
    """A check failed; nothing was published."""


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, key: str = "npi") -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_violations(df: DataFrame, key: str = "npi") -> DataFrame:
    """What a primary key would reject: missing keys and repeated keys."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col(key).isNull() | (F.col("n") > 1))
        .select(
            key,
            F.when(F.col(key).isNull(), "missing").otherwise("repeated").alias("problem"),
            "n",
        )
    )


def is_malformed() -> Column:
    """True for a raw row whose key or entity type is neither blank nor an integer."""

    def malformed(name: str, type_name: str) -> Column:
        text = blank_to_null(name)
        return text.isNotNull() & text.try_cast(type_name).isNull()

    return malformed("npi", "bigint") | malformed("entity_type_code", "int")


def malformed_rows(providers: DataFrame) -> DataFrame:
    """The raw rows a strict provider subset would stop at."""
    return providers.where(is_malformed())


def missing_county_rate(providers: DataFrame) -> DataFrame:
    """Share of providers for which no county was found."""
    missing = F.count_if(F.col("county_name").isNull())
    rows = F.count(F.lit(1))
    return providers.agg(
        rows.alias("providers"),
        missing.alias("without_county"),
        F.try_divide(missing, rows).alias("missing_share"),
    )


def view_checks(subset: DataFrame, view: DataFrame, key: str = "npi") -> DataFrame:
    """One row: the rows of the subset and of the view, and the view's repeated keys."""
    names = ["subset_rows", "view_rows", "repeated_keys"]
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(name))
        for df, name in zip((subset, view, duplicate_keys(view, key)), names, strict=True)
    ]
    rows = reduce(DataFrame.unionByName, counted)
    return rows.agg(*[F.sum(F.when(F.col("of") == name, F.col("n")).otherwise(0)).alias(name) for name in names])


def observed_rows(name: str, key: str = "npi") -> tuple[Observation, list[Column]]:
    """Counts to take while a DataFrame is written: its rows, and those without a key."""
    return Observation(name), [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("without_key"),
    ]


def require_all_rows(before: int, after: int) -> None:
    """A join against lookups with one row per key leaves as many rows as there were."""
    if before != after:
        raise QualityError(f"the view does not have one row per npi: {before} providers, {after} rows")


def require_valid_keys(df: DataFrame, key: str = "npi") -> None:
    examples = key_violations(df, key).limit(5).collect()
    if examples:
        raise QualityError(f"invalid keys in {key}, for example {examples}")


def require_row_count(df: DataFrame, expected: int) -> None:
    require_rows(df.count(), expected)


def require_rows(found: int, expected: int) -> None:
    if found != expected:
        raise QualityError(f"expected {expected} rows, found {found}")
