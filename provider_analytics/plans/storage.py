"""The shared folder for files a query has to write before it can read them."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

from .builds import Workspace


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the session names it, else the session's warehouse: both
    are places that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder; nothing is created."""
    return f"{shared_folder(spark)}/provider-analytics/{label}-{uuid.uuid4().hex}"


@lru_cache
def _own_name(folder: str) -> str:
    return f"provider_analytics_{uuid.uuid4().hex}"


def own_workspace(spark: SparkSession) -> Workspace:
    """A folder and a database of this process in the shared folder, apart from anyone's
    tables."""
    shared = f"{shared_folder(spark)}/provider-analytics"
    name = _own_name(shared)
    folder = f"{shared}/{name}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
    return Workspace(f"{shared}/{name}-tables", name)
