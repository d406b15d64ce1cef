"""Sinks: full-refresh tables and CSV extracts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import quoted


def write_files(df: DataFrame, name: str, root: str) -> str:
    """Write ``df`` as Parquet to a fresh folder under ``root`` and return the folder."""
    location = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(location)
    return location


def replace_table(df: DataFrame, table: str, root: str) -> DataFrame:
    """Replace the content of ``table`` by ``df`` and return the table.

    The files are complete before the table points at them. Readers see the old
    content or the new one, a failed write changes nothing, and ``df`` may itself
    read the table.
    """
    return point_table(df.sparkSession, table, write_files(df, table, root))


def sql_name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"CREATE TABLE {sql_name(table)} USING parquet LOCATION {sql_text(location)}")


def _rename(spark: SparkSession, table: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {sql_name(table)} RENAME TO {sql_name(to)}")


def point_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Make ``table`` the Parquet files at ``location``, which stay where they are.

    A managed table is refused, since its files would go with the old definition. For
    another schema the new table is created under a name of its own before the old one
    gives up its name, and the old one comes back if that fails. Between the two renames
    the name is missing; a session that ended there is mended by the next call.
    """
    new, old = f"{table}__new", f"{table}__old"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(old):
        _rename(spark, old, table)
    if not spark.catalog.tableExists(table):
        _create(spark, table, location)
        return spark.table(table)
    if spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} is a managed table: its files would be lost")
    if spark.table(table).schema == spark.read.parquet(location).schema:
        spark.sql(f"ALTER TABLE {sql_name(table)} SET LOCATION {sql_text(location)}")
        spark.catalog.refreshTable(table)
        return spark.table(table)
    for name in (new, old):
        spark.sql(f"DROP TABLE IF EXISTS {sql_name(name)}")
    _create(spark, new, location)
    _rename(spark, table, old)
    try:
        _rename(spark, new, table)
    except Exception:
        _rename(spark, old, table)
        raise
    spark.sql(f"DROP TABLE {sql_name(old)}")
    return spark.table(table)


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header in each file, quotes only where needed and doubled inside.

    NULL and ``''`` are both written as nothing; white space is kept. ``one_file`` has one
    task write all rows below one header: for extracts, not for whole tables.
    """
    (
        (df.coalesce(1) if one_file else df)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
