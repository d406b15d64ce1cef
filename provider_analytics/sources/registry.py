"""The five datasets by name, and how each one is read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import readers


@dataclass(frozen=True)
class DatasetSpec:
    """One input: its kind of file and what the reader must know about it.

    ``types`` are those of CSV columns that are not text. ``free_text`` marks CSV files
    whose fields may hold line breaks. Such a file is read by one task (several files
    still run in parallel), the other CSV files are split at line ends; the one list
    marked so here has under 1,000 rows as published.
    """

    name: str
    kind: str
    types: Mapping[str, str] = field(default_factory=dict)
    free_text: bool = False


DATASETS = {
    spec.name: spec
    for spec in [
        DatasetSpec("nppes", "parquet"),
        DatasetSpec("nucc", "csv", free_text=True),
        DatasetSpec("fips", "csv", types={"fipscounty": "int"}),
        DatasetSpec("zip", "csv", types={"zip": "int", "county": "int"}),
        DatasetSpec("county_pop", "json_matrix"),
    ]
}


def dataset(name: str) -> DatasetSpec:
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(
            f"unknown dataset {name!r}, expected one of {', '.join(DATASETS)}"
        ) from None


def read_dataset(
    spark: SparkSession,
    name: str,
    path: str,
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """The dataset at ``path`` with the column names and types the jobs expect.

    ``types`` adds types for further CSV columns, as ratios that are to be numbers, and
    ``infer`` takes the types of those left from their fields; ``multi_line`` takes JSON
    matrices in any layout, one a file.
    """
    spec = dataset(name)
    if spec.kind == "parquet":
        return readers.read_providers(spark, path)
    if spec.kind == "csv":
        return readers.read_reference_csv(
            spark, path, {**spec.types, **(types or {})}, spec.free_text, infer
        )
    return readers.read_json_matrix(spark, path, multi_line)
