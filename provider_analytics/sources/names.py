"""Column-name normaliser. Works on headers only, never on data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# What becomes of each special character of a header.
_HEADER_CHARACTERS = str.maketrans(
    {" ": "_", "(": "", ")": "", ".": "", "-": "_", "/": "_"}
)


def normalise(headers: Iterable[str]) -> list[str]:
    """Lower-case and trim each header, then map its special characters.

    Runs of ``_`` are kept and equal results are not told apart.
    """
    return [header.lower().strip().translate(_HEADER_CHARACTERS) for header in headers]


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised header."""
    return df.toDF(*normalise(df.columns))
