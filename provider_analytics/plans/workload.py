"""Registered queries: each operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleanse
from ..operators import enrich, geography, marts, publish, quality, subset
from ..sources import names, readers
from ..sources.registry import read_dataset
from ..sources.schema import POPULATION_HEADERS, POPULATION_VARIABLE
from . import builds, jobs, storage
from .adapter import Inputs

SAMPLE_ROWS = 1000
LARGE_SAMPLE_ROWS = 5000

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Inputs(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


# Inputs shared by several queries


def _subset(given: Inputs) -> DataFrame:
    return subset.provider_subset(given.providers)


def _keys(given: Inputs) -> DataFrame:
    """The subset's key columns."""
    return given.providers.select(
        cleanse.typed_cast("npi", "bigint").alias("npi"),
        cleanse.zip_code().alias("zip_code"),
        cleanse.primary_taxonomy().alias("primary_taxonomy_code"),
    )


def _counties(given: Inputs) -> DataFrame:
    return geography.county_population(
        readers.rename_population(given.county_pop), given.fips
    )


def _zips(given: Inputs, population_order: str = "text") -> DataFrame:
    return geography.zip_lookup(given.crosswalk, _counties(given), population_order)


def _taxonomy(given: Inputs) -> DataFrame:
    return enrich.taxonomy_lookup(given.nucc)


def _with_faults(given: Inputs) -> DataFrame:
    """Provider keys of which some come twice and some are missing."""
    return (
        _keys(given)
        .withColumn("k", F.expr("npi - 1000000000"))
        .withColumn("copy", F.expr("explode(if(k % 97 = 0, array(1, 2), array(1)))"))
        .withColumn("npi", F.expr("if(k % 101 = 0, NULL, npi)"))
        .drop("copy", "k")
    )


# Scans and schema


@query
def scan_project(given: Inputs) -> DataFrame:
    return readers.select_providers(given.raw_providers)


@query
def csv_ingest(given: Inputs) -> DataFrame:
    folder = storage.fresh_folder(given.spark, "nucc")
    publish.export_csv(given.raw_nucc, folder)
    return read_dataset(given.spark, "nucc", folder)


@query
def csv_ingest_bad_fields(given: Inputs) -> DataFrame:
    folder = storage.fresh_folder(given.spark, "zip")
    rows = given.crosswalk
    county = F.col("county").cast("string")
    publish.export_csv(
        rows.select(
            F.col("zip").alias("ZIP"),
            F.when(F.col("county") % 3 == 0, F.concat(F.lit("bad "), county))
            .otherwise(county)
            .alias("COUNTY"),
            F.when(F.col("county") % 4 != 0, F.lit("a, \"b\"")).alias("Res-Ratio (Note)"),
        ),
        folder,
    )
    return read_dataset(given.spark, "zip", folder)


@query
def csv_header_order(given: Inputs) -> DataFrame:
    """A folder of files that have the same columns in different orders."""
    rows = given.crosswalk.select(
        F.col("zip").alias("ZIP"), F.col("county").alias("COUNTY"), F.lit("a, b").alias("Note")
    )
    folder = storage.fresh_folder(given.spark, "zip")
    orders = [("ZIP", "COUNTY", "Note"), ("COUNTY", "Note", "ZIP"), ("Note", "ZIP", "COUNTY")]
    for part, order in enumerate(orders):
        publish.export_csv(rows.where(F.col("COUNTY") % 3 == part).select(*order), f"{folder}/{part}")
    return read_dataset(given.spark, "zip", f"{folder}/*")


@query
def csv_inferred_types(given: Inputs) -> DataFrame:
    """Columns of whole numbers, of decimals, of numbers too long for a long, of numbers with
    a text among them, and without values."""
    folder = storage.fresh_folder(given.spark, "zip")
    county = F.col("county")
    text = county.cast("string")
    publish.export_csv(
        given.crosswalk.select(
            F.col("zip").alias("ZIP"),
            county.alias("COUNTY"),
            F.when(county % 5 != 0, F.lpad((county % 12).cast("string"), 3, "0")).alias("Months"),
            F.when(county % 4 != 0, county / 8).alias("RES_RATIO"),
            F.concat(text, F.lit("00000000000000000000")).alias("Long Number"),
            F.when(county % 1000 == 7, F.concat(F.lit("no. "), text)).otherwise(text).alias("Mixed"),
            F.lit(None).cast("string").alias("Nothing"),
        ),
        folder,
    )
    return read_dataset(given.spark, "zip", folder, infer=True)


@query
def csv_typed_columns(given: Inputs) -> DataFrame:
    folder = storage.fresh_folder(given.spark, "zip")
    ratio = F.when(F.col("county") % 4 != 0, F.col("county") / 8)
    publish.export_csv(
        given.crosswalk.select(
            F.col("zip").alias("ZIP"), F.col("county").alias("COUNTY"), ratio.alias("RES_RATIO")
        ),
        folder,
    )
    return read_dataset(given.spark, "zip", folder, types={"res_ratio": "double"})


def _write_matrices(population: DataFrame, folder: str) -> None:
    """Each row as a matrix of its own, like many small answers of the service."""
    header = F.array(F.array(*[F.lit(name) for name in POPULATION_HEADERS]))
    row = F.array(F.array(*POPULATION_HEADERS))
    population.select(F.to_json(F.concat(header, row)).alias("value")).write.text(folder)


@query
def json_matrix_ingest(given: Inputs) -> DataFrame:
    folder = storage.fresh_folder(given.spark, "county_pop")
    population = "if(c_custkey % 97 = 8, NULL, string(c_custkey * 7919 % 120011))"
    _write_matrices(
        given.table("customer").selectExpr(
            "c_name AS NAME",
            f"{population} AS {POPULATION_VARIABLE}",
            "lpad(string(c_nationkey), 2, '0') AS state",
            "lpad(string(c_custkey % 1000), 3, '0') AS county",
        ),
        folder,
    )
    return read_dataset(given.spark, "county_pop", folder)


@query
def json_matrix_layouts(given: Inputs) -> DataFrame:
    """Matrices of up to 5,000 rows a file, some on one line, some spread over lines, with
    brackets and quotes in their cells."""
    folder = storage.fresh_folder(given.spark, "county_pop")
    rows = given.table("customer").selectExpr(
        "c_custkey DIV 5000 AS matrix",
        "concat(c_name, if(c_custkey % 3 = 0, ' ]],[\"[', ' ]')) AS NAME",
        f"if(c_custkey % 97 = 8, NULL, string(c_acctbal)) AS {POPULATION_VARIABLE}",
        "lpad(string(c_nationkey), 2, '0') AS state",
        "lpad(string(c_custkey % 1000), 3, '0') AS county",
    )
    header = F.to_json(F.array(*[F.lit(name) for name in POPULATION_HEADERS]))
    lines = F.sort_array(F.collect_list(F.to_json(F.array(*POPULATION_HEADERS))))
    matrices = rows.groupBy("matrix").agg(F.concat(F.array(header), lines).alias("lines"))
    spread = F.concat(F.lit("[\n  "), F.array_join("lines", " ,\n  "), F.lit("\n] "))
    one_line = F.concat(F.lit("["), F.array_join("lines", ","), F.lit("]"))
    value = F.when(F.col("matrix") % 2 == 0, one_line).otherwise(spread)
    matrices.select("matrix", value.alias("value")).write.partitionBy("matrix").text(folder)
    return read_dataset(given.spark, "county_pop", folder, multi_line=True)


@query
def population_refresh(given: Inputs) -> DataFrame:
    """The county population loaded from some counties, then refreshed from all."""
    workspace = storage.own_workspace(given.spark)
    for rows in (given.county_pop.where("state = '01'"), given.county_pop):
        folder = storage.fresh_folder(given.spark, "county_pop")
        _write_matrices(rows, folder)
        table = jobs.refresh_population(given.spark, folder, workspace)
    return table


@query
def sample_n(given: Inputs) -> DataFrame:
    return subset.sample_providers(_subset(given), SAMPLE_ROWS)


@query
def sample_5000(given: Inputs) -> DataFrame:
    return subset.sample_providers(_subset(given), LARGE_SAMPLE_ROWS)


@query
def normalise_columns(given: Inputs) -> DataFrame:
    return names.normalise_columns(given.raw_nucc)


@query
def fill_null_text(given: Inputs) -> DataFrame:
    return readers.fill_null_text(names.normalise_columns(given.raw_nucc))


@query
def rename_population(given: Inputs) -> DataFrame:
    return readers.rename_population(given.county_pop)


# Cleansing


def _rule(given: Inputs, name: str, rule, *inputs: str) -> DataFrame:
    return given.providers.select("npi", *inputs, rule.alias(name))


@query
def blank_to_null(given: Inputs) -> DataFrame:
    return _rule(given, "credential", cleanse.blank_to_null("provider_credential_text"))


@query
def typed_cast(given: Inputs) -> DataFrame:
    return given.providers.select(
        cleanse.typed_cast("npi", "bigint").alias("npi"),
        cleanse.typed_cast("entity_type_code", "int").alias("entity_type_code"),
    )


def _malformed(given: Inputs) -> DataFrame:
    """Providers of which some have a key or a type that is no number."""
    k = F.col("npi").cast("bigint") - 1000000000
    rows = given.providers
    return rows.withColumns(
        {
            "npi": F.when(k % 89 == 0, F.concat(F.lit("X"), "npi")).otherwise(F.col("npi")),
            "entity_type_code": F.when(k % 83 == 0, "individual").otherwise(
                F.col("entity_type_code")
            ),
        }
    )


@query
def typed_cast_lenient(given: Inputs) -> DataFrame:
    return _malformed(given).select(
        F.col("npi").alias("raw_npi"),
        cleanse.typed_cast("npi", "bigint", strict=False).alias("npi"),
        cleanse.typed_cast("entity_type_code", "int", strict=False).alias("entity_type_code"),
    )


@query
def malformed_rows(given: Inputs) -> DataFrame:
    return quality.malformed_rows(_malformed(given)).select("npi", "entity_type_code")


@query
def entity_name(given: Inputs) -> DataFrame:
    return given.providers.select("npi", cleanse.entity_name().alias("entity_name"))


@query
def entity_name_full_fallback(given: Inputs) -> DataFrame:
    return given.providers.select(
        "npi", cleanse.entity_name("full").alias("entity_name")
    )


@query
def practice_address(given: Inputs) -> DataFrame:
    return given.providers.select(
        "npi", cleanse.practice_address().alias("practice_address")
    )


@query
def zip_normalise(given: Inputs) -> DataFrame:
    return _rule(given, "zip_code", cleanse.zip_code(), cleanse.POSTAL_CODE)


@query
def primary_taxonomy(given: Inputs) -> DataFrame:
    return _rule(given, "primary_taxonomy_code", cleanse.primary_taxonomy())


@query
def provider_subset(given: Inputs) -> DataFrame:
    return _subset(given)


# Geography


@query
def county_population(given: Inputs) -> DataFrame:
    return _counties(given)


@query
def zip_county_rank(given: Inputs) -> DataFrame:
    return geography.zip_county_rank(
        given.crosswalk, _counties(given)
    )


@query
def zip_county_rank_numeric(given: Inputs) -> DataFrame:
    return geography.zip_county_rank(
        given.crosswalk, _counties(given), "numeric"
    )


@query
def zip_primary_county(given: Inputs) -> DataFrame:
    return geography.zip_primary_county(
        given.crosswalk, _counties(given)
    )


@query
def zip_primary_county_numeric(given: Inputs) -> DataFrame:
    return geography.zip_primary_county(
        given.crosswalk, _counties(given), "numeric"
    )


# Joins and views


@query
def provider_county(given: Inputs) -> DataFrame:
    return enrich.with_county(_keys(given), _zips(given)).select(
        "npi", "zip_code", "fipscounty", "county_name"
    )


@query
def provider_taxonomy(given: Inputs) -> DataFrame:
    rows = enrich.with_taxonomy(_keys(given), _taxonomy(given))
    return rows.select(
        "npi", "primary_taxonomy_code", "classification", "grouping", "specialization"
    )


@query
def view_county(given: Inputs) -> DataFrame:
    return enrich.view_county(
        _subset(given), _zips(given), _taxonomy(given)
    )


@query
def view_county_numeric(given: Inputs) -> DataFrame:
    return enrich.view_county(
        _subset(given), _zips(given, "numeric"), _taxonomy(given)
    )


@query
def view_county_late_dedup(given: Inputs) -> DataFrame:
    return enrich.view_county_late_dedup(
        _subset(given), _zips(given), given.nucc
    )


@query
def view_county_repeated_npi(given: Inputs) -> DataFrame:
    """Some npi come twice, with another name and no taxonomy."""
    rows = _subset(given)
    again = rows.where("npi % 97 = 0").withColumns(
        {
            "entity_name": F.concat(F.lit("AGAIN "), "entity_name"),
            "primary_taxonomy_code": F.lit(None).cast("string"),
        }
    )
    return enrich.view_county_late_dedup(rows.unionByName(again), _zips(given), given.nucc)


@query
def provider_county_full(given: Inputs) -> DataFrame:
    return enrich.provider_county_full(
        _subset(given), _zips(given), _taxonomy(given)
    )


@query
def view_sample_1000(given: Inputs) -> DataFrame:
    # The view has one row per provider, so the first providers are enriched alone.
    return enrich.view_county(
        subset.first_by_key(_subset(given), SAMPLE_ROWS),
        _zips(given),
        _taxonomy(given),
    )


@query
def view_sample_5000(given: Inputs) -> DataFrame:
    """The first of the view itself, of which any number may be taken."""
    return subset.first_by_key(view_county(given), LARGE_SAMPLE_ROWS)


@query
def view_merged_keys(given: Inputs) -> DataFrame:
    """ZIP numbers that are one when cut to five characters, and a blank taxonomy code."""
    crosswalk = given.crosswalk.select("zip", "county")
    for number in ("int(zip * 100 + 12)", "int(zip * 1000 + 120 + county % 7)"):
        crosswalk = crosswalk.union(given.crosswalk.selectExpr(number, "county"))
    blank = given.nucc.where("code = '1'").withColumns(
        {"code": F.lit(""), "classification": F.lit("No code"), "specialization": F.lit("")}
    )
    return enrich.provider_county_full(
        _subset(given),
        geography.zip_lookup(crosswalk, _counties(given)),
        enrich.taxonomy_lookup(given.nucc.unionByName(blank)),
    )


@query
def view_sql(given: Inputs) -> DataFrame:
    """A stakeholder's SQL over the registered view."""
    jobs.register_views(
        given.spark,
        providers=given.providers,
        crosswalk=given.crosswalk,
        fips=given.fips,
        county_pop=given.county_pop,
        nucc=given.nucc,
    )
    return given.spark.sql(
        """
        SELECT county_name, classification, entity_type_code, count(*) AS provider_count
        FROM view_county
        WHERE county_name IS NOT NULL
        GROUP BY county_name, classification, entity_type_code
        """
    )


# Marts


@query
def county_provider_counts(given: Inputs) -> DataFrame:
    groups = marts.provider_groups(_keys(given), "zip_code")
    return marts.county_provider_counts(enrich.with_county(groups, _zips(given)))


@query
def county_specialty_distribution(given: Inputs) -> DataFrame:
    groups = marts.provider_groups(_keys(given), "zip_code", "primary_taxonomy_code")
    return marts.county_specialty_distribution(
        enrich.with_taxonomy(
            enrich.with_county(groups, _zips(given)), _taxonomy(given), spread_by="zip_code"
        )
    )


@query
def providers_per_capita(given: Inputs) -> DataFrame:
    groups = marts.provider_groups(_keys(given), "zip_code")
    return marts.providers_per_capita(enrich.with_county(groups, _zips(given)))


# Quality


@query
def view_row_count(given: Inputs) -> DataFrame:
    return quality.row_count(view_county(given))


@query
def duplicate_keys(given: Inputs) -> DataFrame:
    return quality.duplicate_keys(_with_faults(given))


@query
def key_violations(given: Inputs) -> DataFrame:
    return quality.key_violations(_with_faults(given))


@query
def view_checks(given: Inputs) -> DataFrame:
    return quality.view_checks(_subset(given), view_county(given))


@query
def missing_county_rate(given: Inputs) -> DataFrame:
    return quality.missing_county_rate(enrich.with_county(_keys(given), _zips(given)))


# Sinks and jobs


@query
def table_replace(given: Inputs) -> DataFrame:
    """Replaces a table by a result that reads the table itself."""
    root = storage.fresh_folder(given.spark, "tables")
    name = storage.own_workspace(given.spark).table("provider_subset_copy")
    first = publish.replace_table(_subset(given), name, root)
    cleaned = first.withColumn("zip_code", F.coalesce("zip_code", F.lit("00000")))
    return publish.replace_table(cleaned, name, root)


@query
def csv_export(given: Inputs) -> DataFrame:
    """The whole view as CSV, read back as lines of text without the headers."""
    folder = storage.fresh_folder(given.spark, "export")
    marked = F.when(F.col("npi") % 5 == 0, F.concat("practice_address", F.lit(', "REAR" ')))
    view = view_county(given).withColumn(
        "practice_address", F.coalesce(marked, "practice_address")
    )
    publish.export_csv(view, folder)
    return given.spark.read.text(folder).where(F.col("value") != ",".join(view.columns)).select(
        F.col("value").alias("line")
    )


def _run_jobs(given: Inputs) -> tuple[jobs.Workspace, DataFrame]:
    """Lands all five inputs as files, loads them and builds; the view of this build."""
    landing = storage.fresh_folder(given.spark, "landing")
    sources = {
        name: f"{landing}/{name}" for name in ("nppes", "nucc", "fips", "zip", "county_pop")
    }
    given.raw_providers.write.parquet(sources["nppes"])
    publish.export_csv(given.raw_nucc, sources["nucc"])
    publish.export_csv(given.fips, sources["fips"])
    publish.export_csv(given.crosswalk, sources["zip"])
    _write_matrices(given.county_pop, sources["county_pop"])
    workspace = storage.own_workspace(given.spark)
    return workspace, jobs.run(given.spark, sources, workspace, export_path=f"{landing}/result")


@query
def load_and_build(given: Inputs) -> DataFrame:
    return _run_jobs(given)[1]


@query
def published_marts(given: Inputs) -> DataFrame:
    """The county counts as published, beside the specialties and population published."""
    workspace, _ = _run_jobs(given)
    this = builds.current(given.spark, workspace)
    tables = {name: builds.read(given.spark, workspace, this, name) for name in jobs.MARTS}
    specialties = tables["county_specialty_distribution"].groupBy("county_name").agg(
        F.count(F.lit(1)).alias("specialties"), F.sum("provider_count").alias("by_specialty")
    )
    counties = tables["providers_per_capita"].groupBy("county_name").agg(
        F.sum("provider_count").alias("by_population")
    )
    found = tables["county_provider_counts"]
    for other in (specialties, counties):
        other = other.withColumnRenamed("county_name", "of")
        found = found.join(other, F.col("county_name").eqNullSafe(F.col("of"))).drop("of")
    return found
