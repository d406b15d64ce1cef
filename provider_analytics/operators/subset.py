"""Provider subset: one typed row per raw registry row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleanse

#: Up to as many rows Spark limits each task's part of a group before the shuffle.
FEW = 1000
#: Groups of tasks that each pass on their first rows.
TOP_GROUPS = 1024
#: Ranges of numbers that are counted at once.
RANGES = 4096


def provider_subset(
    providers: DataFrame, strict: bool = True, name_fallback: str = "person"
) -> DataFrame:
    """The six cleaned columns. A narrow projection: no filter and no shuffle.

    A malformed key or entity type stops the job when ``strict``; otherwise it
    becomes NULL, and ``operators.quality.malformed_rows`` finds such rows.
    """
    return providers.select(
        cleanse.typed_cast("npi", "bigint", strict).alias("npi"),
        cleanse.typed_cast("entity_type_code", "int", strict).alias("entity_type_code"),
        cleanse.entity_name(name_fallback).alias("entity_name"),
        cleanse.practice_address().alias("practice_address"),
        cleanse.zip_code().alias("zip_code"),
        cleanse.primary_taxonomy().alias("primary_taxonomy_code"),
    )


def _top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in an order, for ``n`` up to ``FEW``, without a full sort.

    Each task passes on its own first ``n``, each group of tasks the first ``n`` of
    those, and one task merges what ``TOP_GROUPS`` groups have left. The scan below keeps
    all its tasks.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(TOP_GROUPS))
    place = F.row_number().over(Window.partitionBy("task_group").orderBy(*order))
    firsts = df.withColumn("task_group", group).withColumn("place", place).where(F.col("place") <= n)
    return firsts.drop("task_group", "place").orderBy(*order).limit(n)


def bound_of_first(df: DataFrame, n: int, number: Column) -> tuple[int | None, int, int]:
    """(bound, below, level): the first ``n`` rows by the whole number ``number``, NULL first,
    are the ``below`` rows under ``bound`` and ``n`` - ``below`` of the ``level`` rows at it.

    Found by counting rows per range of numbers, and again within the range that holds the
    n-th row, until that is a single number: six passes over the number at most, each of
    which brings at most 2 * ``RANGES`` counts to the driver.
    """
    numbers = df.select(number.alias("number"))
    total, known, low, high = numbers.agg(
        F.count(F.lit(1)), F.count("number"), F.min("number"), F.max("number")
    ).first()
    n, below, shift = min(n, total), total - known, 64
    if n <= below or not known:
        return None, 0, below
    while shift:
        shift = max((high - low).bit_length() - RANGES.bit_length(), 0)
        part = F.shiftright("number", shift).alias("part")
        counts = numbers.where(F.col("number").between(low, high)).groupBy(part).count().collect()
        for part, count in sorted(counts):
            low, high = part << shift, ((part + 1) << shift) - 1
            if below + count >= n:
                break
            below += count
    return low, below, count


def _first(df: DataFrame, n: int, number: Column, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in an order that ``number`` follows, for any ``n``.

    More than ``FEW`` rows are picked by comparing each row with the bound, without a
    shuffle; only rows at the bound itself, when some of them are too many, are put in order.
    """
    if n <= FEW:
        return _top(df, n, *order)
    bound, below, level = bound_of_first(df, n, number)
    if bound is None:
        level_rows, before = df.where(number.isNull()), None
    else:
        level_rows, before = df.where(number == bound), df.where(number.isNull() | (number < bound))
    if n >= below + level:
        return level_rows if before is None else df.where(number.isNull() | (number <= bound))
    at = level_rows.orderBy(*order).limit(n - below)
    return at if before is None else before.union(at)


def first_by_key(df: DataFrame, n: int, key: str = "npi") -> DataFrame:
    """The ``n`` rows with the smallest key, a whole number; rows without one come first."""
    return _first(df, n, F.col(key).cast("bigint"), key)


def sample_providers(df: DataFrame, n: int, key: str = "npi") -> DataFrame:
    """A repeatable sample of ``n`` rows: those with the smallest key digest."""
    digest = F.md5(F.col(key).cast("string"))
    leading = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return _first(df, n, leading, digest, key)
