"""Builds: the derived tables as one snapshot that is switched by one record.

Every derived table keeps its builds as partitions of one stored table. The table
``builds`` has a row per switch, and the published names are catalog views that read the
partition named by its last row. So readers see all tables of the old build until that row
is there, and all of the new one from then on, wherever a build stopped before; a statement
that reads several names asks for the row once. Earlier builds stay readable and can be put
back by another row.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.publish import sql_name, sql_text
from ..sources.readers import quoted

_RECORD = "switch bigint, build string"


@dataclass(frozen=True)
class Workspace:
    """Where tables live: a folder for their files and a database for their names."""

    root: str
    database: str = "default"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def stored(self, name: str) -> str:
        """The table that holds all builds of ``name``."""
        return self.table(f"{name}_builds")

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def ensure_table(spark: SparkSession, table: str, folder: str, columns: str, layout: str = "") -> None:
    """Create ``table`` over the files in ``folder`` unless it is there already."""
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"CREATE TABLE {sql_name(table)} ({columns}) USING parquet {layout} LOCATION {sql_text(folder)}"
        )
        return
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(table)}").where("col_name = 'Location'")
    location = found.first()["data_type"]
    paths = [unquote(urlparse(place).path).rstrip("/") for place in (location, folder)]
    if paths[0] != paths[1]:
        raise ValueError(f"{table} is at {location}, not at {folder}: one database goes with one root")


def _records(spark: SparkSession, workspace: Workspace) -> DataFrame:
    ensure_table(spark, workspace.table("builds"), workspace.folder("builds"), _RECORD)
    spark.catalog.refreshTable(workspace.table("builds"))
    return spark.table(workspace.table("builds"))


def current(spark: SparkSession, workspace: Workspace) -> str | None:
    """The build that the published names read; None before the first."""
    return _records(spark, workspace).agg(F.max_by("build", "switch")).first()[0]


def start() -> str:
    """A name for a new build; nothing is created."""
    return uuid.uuid4().hex


def switch(spark: SparkSession, workspace: Workspace, build: str) -> None:
    """Make ``build`` the one that is read: one row in one file, there or not there. An
    earlier build is put back in the same way."""
    records = _records(spark, workspace)
    number = (records.agg(F.max("switch")).first()[0] or 0) + 1
    row = spark.range(1).select(F.lit(number).cast("bigint").alias("switch"), F.lit(build).alias("build"))
    row.coalesce(1).write.mode("append").parquet(workspace.folder("builds"))
    spark.catalog.refreshTable(workspace.table("builds"))


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def buckets(spark: SparkSession, workspace: Workspace, name: str) -> int:
    """Buckets of the stored table, which stay what they were when it was created: as many
    as the session has shuffle partitions."""
    table = workspace.stored(name)
    if spark.catalog.tableExists(table):
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(table)}").where("col_name = 'Num Buckets'")
        return int(found.first()["data_type"])
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write(
    spark: SparkSession, workspace: Workspace, build: str, name: str, df: DataFrame, bucket_by: str | None = None
) -> DataFrame:
    """``df`` as the table ``name`` of ``build``, not yet published, and read again.

    What a step that failed left behind is overwritten. ``bucket_by`` names a column whose
    equal values share a file, so that grouping by it later needs no shuffle; ``df`` should
    be dealt by it into ``buckets`` partitions.
    """
    layout = "PARTITIONED BY (build)"
    if bucket_by:
        layout += f" CLUSTERED BY ({quoted(bucket_by)}) INTO {buckets(spark, workspace, name)} BUCKETS"
    table = workspace.stored(name)
    ensure_table(spark, table, workspace.folder(name), f"{_columns(df.schema)}, build string", layout)
    stored = [(f.name, f.dataType) for f in spark.table(table).schema if f.name != "build"]
    if stored != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{table} has other columns than the result: {stored}")
    given = f"written_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(given)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {sql_name(table)} PARTITION (build = {sql_text(build)}) SELECT * FROM {given}"
        )
    finally:
        spark.catalog.dropTempView(given)
    return read(spark, workspace, build, name)


def read(spark: SparkSession, workspace: Workspace, build: str, name: str) -> DataFrame:
    """The table ``name`` of ``build``, published or not, for as long as its files are kept."""
    return spark.table(workspace.stored(name)).where(F.col("build") == build).drop("build")


def publish(spark: SparkSession, workspace: Workspace, views: dict[str, tuple[str, list[str] | None]]) -> None:
    """Name the current build's tables: a catalog view per name, over the given columns of
    a stored table. Views read what is current, so they are made once and never switched."""
    _records(spark, workspace)
    current_build = f"(SELECT max_by(build, switch) FROM {sql_name(workspace.table('builds'))})"
    for name, (stored, columns) in views.items():
        table = workspace.stored(stored)
        if columns is None:
            columns = [column for column in spark.table(table).columns if column != "build"]
        make_view(
            spark,
            workspace.table(name),
            f"SELECT {', '.join(map(quoted, columns))} FROM {sql_name(table)} WHERE build = {current_build}",
        )


def make_view(spark: SparkSession, name: str, query: str) -> None:
    """``name`` as a catalog view of ``query``. An external table of that name gives way, its
    files stay; a managed one is refused, since its files would go."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table: its files would be lost")
        spark.sql(f"DROP TABLE {sql_name(name)}")
    spark.sql(f"CREATE OR REPLACE VIEW {sql_name(name)} AS {query}")


def definition(spark: SparkSession, name: str) -> str:
    """A digest of where a table's files are, or of a view's query; of nothing without either."""
    found = ""
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {sql_name(name)}")
        found = described.where("col_name IN ('Location', 'View Text')").first()["data_type"]
    return hashlib.sha256(found.encode()).hexdigest()
