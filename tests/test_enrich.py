import pytest
from pyspark.sql import functions as F

from provider_analytics.operators import enrich, marts
from provider_analytics.plans import jobs
from provider_analytics.sources.schema import SUBSET_SCHEMA, VIEW_SCHEMA

ZIPS = "zip_code string, fipscounty int, county_name string, population string"
NUCC = "code string, grouping string, classification string, specialization string"


@pytest.fixture
def small(spark):
    subset = spark.createDataFrame(
        [
            (1, 1, "A", "x", "00501", "T1"),
            (2, 2, "B", "y", "99999", "T1"),
            (3, None, "", "", None, None),
            (4, 1, "D", "z", "00501", ""),
            (5, 1, "E", "z", "00502", "T9"),
        ],
        SUBSET_SCHEMA,
    )
    zips = spark.createDataFrame(
        [("00501", 1, "ONE", "100000"), ("00502", 2, "TWO", "0"), ("00503", 3, "THREE", "9")], ZIPS
    )
    nucc = spark.createDataFrame(
        [
            ("T1", "G", "C2", "S"),
            ("T1", "G", "C1", ""),
            ("", "blank", "blank", "blank"),
            (None, "none", "none", "none"),
            ("T2", "G", "C", "S"),
        ],
        NUCC,
    )
    return subset, zips, nucc


def by_npi(df):
    return {r.npi: tuple(r)[1:] for r in df.collect()}


def test_view_keeps_every_provider(small):
    subset, zips, nucc = small
    view = enrich.view_county(subset, zips, enrich.taxonomy_lookup(nucc))
    assert [(f.name, f.dataType) for f in view.schema] == [
        (f.name, f.dataType) for f in VIEW_SCHEMA
    ]
    assert by_npi(view) == {
        1: (1, "A", "x", "ONE", "C1", "G", ""),
        2: (2, "B", "y", None, "C1", "G", ""),
        3: (None, "", "", None, None, None, None),
        4: (1, "D", "z", "ONE", "blank", "blank", "blank"),
        5: (1, "E", "z", "TWO", None, None, None),
    }


def test_early_and_late_dedup_agree(small):
    subset, zips, nucc = small
    early = enrich.view_county(subset, zips, enrich.taxonomy_lookup(nucc))
    late = enrich.view_county_late_dedup(subset, zips, nucc)
    assert early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()


def test_late_dedup_leaves_one_row_per_npi(small):
    subset, zips, nucc = small
    again = subset.where("npi = 1").withColumn("entity_name", F.lit("0 OTHER"))
    late = enrich.view_county_late_dedup(subset.unionByName(again), zips, nucc)
    assert by_npi(late)[1] == (1, "0 OTHER", "x", "ONE", "C1", "G", "")
    assert late.count() == 5


def test_marts_of_groups_equal_marts_of_providers(small):
    subset, zips, nucc = small
    taxonomy = enrich.taxonomy_lookup(nucc)
    view = enrich.provider_county_full(subset, zips, taxonomy)
    by_zip = enrich.with_county(marts.provider_groups(subset, "zip_code"), zips)
    by_both = enrich.with_taxonomy(
        enrich.with_county(
            marts.provider_groups(subset, "zip_code", "primary_taxonomy_code"), zips
        ),
        taxonomy,
        spread_by="zip_code",
    )
    for mart, groups in [
        (marts.county_provider_counts, by_zip),
        (marts.providers_per_capita, by_zip),
        (marts.county_specialty_distribution, by_both),
    ]:
        assert {tuple(r) for r in mart(groups).collect()} == {
            tuple(r) for r in mart(view).collect()
        }


def test_marts(small):
    subset, zips, nucc = small
    full = enrich.provider_county_full(subset, zips, enrich.taxonomy_lookup(nucc))
    counts = {tuple(r) for r in marts.county_provider_counts(full).collect()}
    assert counts == {("ONE", 2), ("TWO", 1), (None, 2)}
    capita = {
        (r.county_name, r.provider_count, r.providers_per_100k)
        for r in marts.providers_per_capita(full).collect()
    }
    assert capita == {("ONE", 2, 2.0), ("TWO", 1, None), (None, 2, None)}
    shares = marts.county_specialty_distribution(full)
    totals = shares.groupBy("county_name").agg(
        F.sum("provider_count").alias("n"), F.round(F.sum("county_share"), 9).alias("share")
    )
    assert {tuple(r) for r in totals.collect()} == {
        ("ONE", 2, 1.0),
        ("TWO", 1, 1.0),
        (None, 2, 1.0),
    }


def test_hot_codes_are_split_when_the_list_is_too_large_to_broadcast(spark):
    """A third of the providers share a code, another third has none."""
    rows = 300_000
    providers = spark.range(rows, numPartitions=8).select(
        F.col("id").alias("npi"),
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 2 THEN string(id % 5000) END").alias(
            "primary_taxonomy_code"
        ),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    nucc = spark.range(5000).selectExpr(
        "if(id = 4999, 'hot', string(id)) AS code",
        "concat('g', id) AS grouping",
        "concat('c', id) AS classification",
        "concat('s', id) AS specialization",
    )
    # Not the threshold in use: it stands for a list beyond any threshold.
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = enrich.with_taxonomy(providers, enrich.taxonomy_lookup(nucc))
        found = joined.select("npi", "classification", "payload")
        ours = found.where("classification = 'c4999'").count()
        tasks = found.select("classification", F.spark_partition_id().alias("task"))
        largest = tasks.groupBy("task").count().agg(F.max("count")).first()[0]
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    assert ours == rows // 3
    assert "skew=true" in plan
    # Neither the hot code nor the missing code is left in one task.
    assert largest < rows // 6


def test_views_answer_sql(spark, sf_dir):
    from provider_analytics.plans.adapter import Inputs

    given = Inputs(spark, sf_dir)
    jobs.register_views(
        spark,
        given.providers,
        given.crosswalk,
        given.fips,
        given.county_pop,
        given.nucc,
    )
    total, distinct = spark.sql("SELECT count(*), count(DISTINCT npi) FROM view_county").first()
    assert total == distinct == spark.table("nppes").count()
    assert spark.sql("SELECT npi FROM nppes_subset GROUP BY npi HAVING count(*) > 1").isEmpty()
    assert spark.sql("SELECT sum(provider_count) FROM county_provider_counts").first()[0] == total
