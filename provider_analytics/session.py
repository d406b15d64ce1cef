"""Session settings the jobs were tuned with. All are ordinary Spark settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # A malformed key must stop a load, not become NULL (Spark 4's default).
    "spark.sql.ansi.enabled": "true",
    # Re-plans joins by measured size and splits partitions of hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods beyond 8000 bytes of code. Past that size
    # separate operators are faster than one generated loop that is interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add ``SETTINGS`` to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
