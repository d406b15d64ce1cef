"""The plans that make the jobs hold at scale."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from provider_analytics.operators import enrich, geography, subset
from provider_analytics.plans import workload
from provider_analytics.plans.adapter import Inputs
from provider_analytics.sources import readers

QUERIES = workload.QUERIES


@pytest.fixture
def plan_of(capsys):
    def text(df, mode="simple"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return text


@pytest.fixture(scope="module")
def provider_file(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("providers") / "nppes")
    Inputs(spark, sf_dir).raw_providers.write.parquet(path)
    return readers.read_providers(spark, path)


def view(spark, sf_dir, providers):
    given = Inputs(spark, sf_dir)
    counties = geography.county_population(
        readers.rename_population(given.county_pop), given.fips
    )
    return enrich.view_county(
        subset.provider_subset(providers),
        geography.zip_lookup(given.crosswalk, counties),
        enrich.taxonomy_lookup(given.nucc),
    )


def test_subset_is_narrow_and_reads_44_columns(provider_file, plan_of):
    plan = plan_of(subset.provider_subset(provider_file), "formatted")
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    [schema] = re.findall(r"ReadSchema: struct<(.*)>", plan)
    # 2 keys, 7 names, 4 address parts, postal code, 15 codes and 15 switches
    assert schema.count(":string") == 2 + 7 + 4 + 1 + 30


def test_providers_are_never_shuffled(spark, sf_dir, provider_file, plan_of):
    lines = plan_of(view(spark, sf_dir, provider_file)).splitlines()
    [scan] = [i for i, line in enumerate(lines) if "FileScan" in line and "NPI#" in line]
    depth = lines[scan].index("FileScan")
    above = []
    for line in reversed(lines[:scan]):
        start = len(line) - len(line.lstrip(" :+-*0123456789()"))
        if start < depth:
            above.append(line.strip())
            depth = start
    assert any("BroadcastHashJoin [zip_code" in line for line in above)
    assert any("BroadcastHashJoin [primary_taxonomy_code" in line for line in above)
    assert not any("Exchange" in line for line in above)


def test_taxonomy_is_broadcast_by_size_only(spark, sf_dir, provider_file, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = plan_of(view(spark, sf_dir, provider_file))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [primary_taxonomy_code" in plan
    assert "BroadcastHashJoin [zip_code" in plan


def test_no_job_runs_while_a_query_is_built(spark, sf_dir):
    spark.sparkContext.setJobGroup("built", "")
    try:
        for name in ("view_county", "provider_taxonomy", "county_specialty_distribution"):
            QUERIES[name](spark, sf_dir)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("built")
        stages = [s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 8 * 3  # opening a Parquet file for its schema is a job of one stage


def test_filter_on_the_subset_reaches_the_file(provider_file, plan_of):
    plan = plan_of(provider_file.where("entity_type_code = '1'").select("npi"), "formatted")
    assert "EqualTo(`Entity Type Code`,1)" in plan


@pytest.mark.parametrize("name", ["zip_primary_county", "zip_primary_county_numeric"])
def test_first_per_zip_is_limited_before_the_shuffle(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*row_number\(\), 1, Partial", plan)


@pytest.mark.parametrize("name", ["sample_n", "view_sample_1000"])
def test_top_rows_need_no_full_sort(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "TakeOrderedAndProject(limit=1000" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["sample_5000", "view_sample_5000"])
def test_more_first_rows_need_no_shuffle_of_rows(spark, sf_dir, plan_of, name):
    """The bound is known, so rows are picked where they are; only lookups are dealt out."""
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    assert "Window [row_number" not in plan.split("zip_code")[0]
    assert "rangepartitioning" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan
    lines = plan.splitlines()
    [scan] = [i for i, line in enumerate(lines) if "orders.parquet" in line]
    depth, above = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):
        start = len(line) - len(line.lstrip(" :+-*0123456789()"))
        if start < depth:
            above.append(line.strip())
            depth = start
    assert not [line for line in above if line.startswith("Exchange")]


def values(spark, rows):
    return spark.createDataFrame([(v, i) for i, v in enumerate(rows)], "npi bigint, n int").repartition(5)


@pytest.mark.parametrize(
    "rows",
    [
        list(range(-1500, 1500)),
        [i * (2**63 // 1600) for i in range(-1600, 1600)],
        [None] * 1200 + list(range(1800)),
        [7] * 2000 + [None] * 300 + list(range(100, 800)),
        [-(2**63), 2**63 - 1] * 900 + [0] * 900,
        [i * i * i for i in range(3000)],
    ],
)
@pytest.mark.parametrize("n", [1200, 2300, 5000])
def test_first_n_of_any_keys(spark, monkeypatch, rows, n):
    monkeypatch.setattr(subset, "RANGES", 16)
    df = values(spark, rows)
    found = subset.first_by_key(df, n).collect()
    order = sorted(rows, key=lambda v: (v is not None, v or 0))
    assert sorted((r.npi for r in found), key=lambda v: (v is not None, v or 0)) == order[:n]
    assert len({r.n for r in found}) == min(n, len(rows))


def test_first_n_counts_ranges_not_rows(spark):
    """The driver gets counts per range, whatever the number of rows and their keys."""
    bound, below, level = subset.bound_of_first(spark.range(10**6), 123_456, F.col("id"))
    assert (bound, below, level) == (123_455, 123_455, 1)
    assert subset.bound_of_first(spark.range(0), 5, F.col("id")) == (None, 0, 0)


def test_sample_beyond_the_limit_of_a_group(spark):
    df = values(spark, range(20_000))
    found = {r.npi for r in subset.sample_providers(df, 3000).collect()}
    digest = sorted(range(20_000), key=lambda v: hashlib.md5(str(v).encode()).hexdigest())
    assert found == set(digest[:3000])


def test_one_row_per_npi_without_a_sorted_aggregate(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["view_county_repeated_npi"](spark, sf_dir))
    assert "SortAggregate" not in plan.split("BroadcastExchange")[0]
    assert re.search(r"WindowGroupLimit \[npi.*row_number\(\), 1, Partial", plan)


@pytest.mark.parametrize("name", ["county_provider_counts", "duplicate_keys", "key_violations"])
def test_counts_combine_before_the_shuffle(spark, sf_dir, plan_of, name):
    assert "partial_count" in plan_of(QUERIES[name](spark, sf_dir))


def test_specialty_shares_count_providers_once(spark, sf_dir, plan_of):
    df = QUERIES["county_specialty_distribution"](spark, sf_dir)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    assert final.count("orders.parquet") == 1 and "ReusedExchange" in final
    assert "Window" in final  # the choice of a county per ZIP
    assert "Window [sum" not in final


@pytest.mark.parametrize(
    "name", ["county_provider_counts", "county_specialty_distribution", "providers_per_capita"]
)
def test_marts_join_lookups_with_counts_not_providers(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    join = plan.index("BroadcastHashJoin [zip_code")
    assert join < plan.index("partial_count(1)") < plan.index("orders.parquet")


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_workers_and_no_cross_joins(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan


def test_generated_code_stays_compilable(spark, provider_file, plan_of):
    """The JVM leaves methods over 8000 bytes of code uncompiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(subset.provider_subset(provider_file), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8000
