"""Entry script for spark-submit; see ``provider_analytics/cli.py``."""

from pyspark.sql import SparkSession

from provider_analytics.cli import main
from provider_analytics.session import configure

if __name__ == "__main__":
    main(configure(SparkSession.builder.appName("provider_analytics")).getOrCreate())
