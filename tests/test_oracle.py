"""Every registered query against its SQL on DuckDB, whole tables."""

import duckdb
import pytest
from oracle_check import ORACLE, QUERIES, assert_matches, connect
from pyspark.sql import functions as F

JOINS = [
    "county_population",
    "zip_county_rank",
    "zip_primary_county",
    "provider_county",
    "provider_taxonomy",
    "provider_county_full",
    "view_sql",
    "county_specialty_distribution",
    "providers_per_capita",
]

# The plans of tables beyond every broadcast limit.
SHUFFLES_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "23",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture
def shuffles_only(spark):
    before = {name: spark.conf.get(name, None) for name in SHUFFLES_ONLY}
    for name, value in SHUFFLES_ONLY.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(name, spark, duck, sf_dir):
    assert_matches(name, spark, duck, sf_dir)


@pytest.mark.parametrize("name", JOINS)
def test_matches_oracle_with_shuffle_joins(name, spark, duck, sf_dir, shuffles_only):
    assert_matches(name, spark, duck, sf_dir)


def test_orders_without_customer_or_key(spark, sf_dir, tmp_path):
    """Orders of unknown customers are no providers in any query; a missing key is kept."""
    for name in ("customer", "nation", "region", "part"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    odd = orders.withColumns(
        {
            "o_custkey": F.expr("if(o_orderkey % 1000 = 7, -1, o_custkey)"),
            "o_orderkey": F.expr("if(o_orderkey % 1000 = 9, NULL, o_orderkey)"),
        }
    )
    odd.write.parquet(str(tmp_path / "orders.parquet"))
    folder = str(tmp_path)
    kept = odd.where("o_custkey <> -1").count()
    assert kept < odd.count()
    for name in ("provider_subset", "typed_cast", "provider_county", "provider_taxonomy"):
        assert QUERIES[name](spark, folder).count() == kept
    counts = QUERIES["county_provider_counts"](spark, folder)
    assert counts.agg(F.sum("provider_count")).first()[0] == kept
    other = duckdb.connect()
    for name in ("customer", "nation", "region", "part"):
        other.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    other.execute(f"CREATE VIEW orders AS FROM '{folder}/orders.parquet/*.parquet'")
    for name in ("provider_subset", "zip_normalise", "key_violations"):
        assert_matches(name, spark, other, folder)
