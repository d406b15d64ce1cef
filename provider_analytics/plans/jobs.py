"""Jobs: load a dataset, build the derived tables, run everything."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, geography, marts, publish, quality, subset
from ..sources import readers
from ..sources.readers import quoted
from ..sources.registry import DATASETS, dataset, read_dataset
from ..sources.schema import PROVIDER_COLUMNS, PROVIDER_HEADERS, SUBSET_SCHEMA
from . import builds
from .builds import Workspace
from .record import RunRecord, fingerprint

#: Rows of the CSV extract unless the caller says otherwise.
EXPORT_ROWS = 1000


#: Results per county, from the rows of ``provider_county_full``.
MARTS = {
    "county_provider_counts": marts.county_provider_counts,
    "county_specialty_distribution": marts.county_specialty_distribution,
    "providers_per_capita": marts.providers_per_capita,
}


#: Published names: the stored table each one reads, and its columns (None: all).
PUBLISHED = {
    "nppes_malformed": ("nppes_malformed", None),
    "nppes_subset": ("providers", [field.name for field in SUBSET_SCHEMA]),
    "ranked_zip": ("ranked_zip", None),
    "provider_county_full": ("providers", enrich.FULL_COLUMNS),
    "view_county": ("providers", enrich.VIEW_COLUMNS),
    **{name: (name, None) for name in MARTS},
}


def load(
    spark: SparkSession,
    name: str,
    source: str,
    workspace: Workspace,
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """Full refresh of one dataset from the file or folder ``source``; see ``read_dataset``.

    The registry is Parquet as it lands and is not copied: its table is a view that picks and
    names the columns, so the landed files must stay until the next load.
    """
    table = workspace.table(name)
    if dataset(name).kind == "parquet":
        path = source.replace("`", "``")
        columns = [f"{quoted(old)} AS {quoted(new)}" for old, new in zip(PROVIDER_HEADERS, PROVIDER_COLUMNS)]
        builds.make_view(spark, table, f"SELECT {', '.join(columns)} FROM parquet.`{path}`")
        return spark.table(table)
    return publish.replace_table(
        read_dataset(spark, name, source, types, multi_line, infer), table, workspace.root
    )


def refresh_population(
    spark: SparkSession, source: str, workspace: Workspace, multi_line: bool = False
) -> DataFrame:
    """Full refresh of the county population alone."""
    return load(spark, "county_pop", source, workspace, multi_line=multi_line)


def build(
    spark: SparkSession,
    workspace: Workspace,
    population_order: str = "text",
    name_fallback: str = "person",
    expected_rows: int | None = None,
    export_path: str | None = None,
    export_rows: int | None = EXPORT_ROWS,
    quarantine: bool = False,
    cluster_by_county: bool = False,
    record: RunRecord | None = None,
) -> DataFrame:
    """Derive the provider subset, the ZIP counties, the provider view and the marts.

    Providers are written once, with all columns of subset and view, in buckets by npi; the
    published names are views of these tables (``PUBLISHED``). Rows are counted while they
    are written, keys are checked in the buckets without a shuffle, and only then one record
    makes all tables of the build the published ones (``builds``). The extract is
    written last, with the first ``export_rows`` rows by npi, or all of them for None.

    A malformed row stops the job; with ``quarantine`` it goes to the table
    ``nppes_malformed``, empty otherwise, and the others are used.
    ``cluster_by_county`` sorts each file of the providers, so that reads of one county skip
    most of it. ``record`` names the tables of a build that stopped, which are not written
    again. The result is the view of this build, also when a later one is published.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled is off: malformed values would pass as NULL")
    steps = record.steps if record else {}
    this = steps.get("build") or builds.start()
    if record and "build" not in steps:
        record.add("build", this)

    def loaded(name: str) -> DataFrame:
        return spark.table(workspace.table(name))

    def written(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table, by ``make`` unless the record has it."""
        if steps.get(f"table {name}") == this:
            return builds.read(spark, workspace, this, name)
        found = make()
        if record:
            record.add(f"table {name}", this)
        return found

    def write(name: str, df: DataFrame) -> DataFrame:
        return written(name, lambda: builds.write(spark, workspace, this, name, df))

    raw = loaded("nppes")
    write("nppes_malformed", quality.malformed_rows(raw) if quarantine else raw.where("false"))
    if quarantine:
        raw = raw.where(~quality.is_malformed())
    zips = write(
        "ranked_zip",
        geography.zip_lookup(
            loaded("zip"),
            geography.county_population(
                readers.rename_population(loaded("county_pop")), loaded("fips")
            ),
            population_order,
        ),
    )

    def providers() -> DataFrame:
        before, counts = quality.observed_rows("subset")
        after, _ = quality.observed_rows("view")
        cleaned = subset.provider_subset(raw, name_fallback=name_fallback)
        rows = enrich.provider_rows(cleaned.observe(before, *counts), zips, enrich.taxonomy_lookup(loaded("nucc")))
        n = builds.buckets(spark, workspace, "providers")
        dealt = rows.repartition(n, "npi")
        if cluster_by_county:
            dealt = dealt.sortWithinPartitions(F.pmod(F.hash("npi"), F.lit(n)), "county_name")
        found = builds.write(spark, workspace, this, "providers", dealt.observe(after, *counts), bucket_by="npi")
        given, kept = before.get["rows"], after.get["rows"]
        if given != kept:
            # A task that ran twice, its output lost, is counted twice: count the rows.
            given, kept = raw.count(), found.count()
        quality.require_all_rows(given, kept)
        if expected_rows is not None:
            quality.require_rows(kept, expected_rows)
        quality.require_valid_keys(found)
        return found

    full = written("providers", providers)
    for name, mart in MARTS.items():
        write(name, mart(full))
    builds.publish(spark, workspace, PUBLISHED)
    builds.switch(spark, workspace, this)
    view = full.select(*enrich.VIEW_COLUMNS)
    if export_path is not None:
        rows = view if export_rows is None else subset.first_by_key(view, export_rows)
        publish.export_csv(rows, export_path, one_file=export_rows is not None)
    return view


def run(
    spark: SparkSession,
    sources: Mapping[str, str],
    workspace: Workspace,
    multi_line: bool = False,
    infer: bool = False,
    **build_options,
) -> DataFrame:
    """Load all five datasets, then build.

    A run that failed is gone on with by the next call with the same sources and options:
    loads and tables that were finished are not done again, unless files of a source have
    changed or its table is another one by now; after such a load the build starts anew.
    After a run that reached its end everything is loaded and built again.
    """
    missing = DATASETS.keys() - sources.keys()
    if missing:
        raise ValueError(f"no source for {', '.join(sorted(missing))}")
    settings = {"sources": dict(sources), "multi_line": multi_line, "infer": infer, **build_options}
    record = RunRecord(spark, workspace, settings)
    again = False
    for name in DATASETS:
        again |= record.once(
            f"load {name}",
            lambda name=name: f"{fingerprint(spark, sources[name])} {builds.definition(spark, workspace.table(name))}",
            lambda name=name: load(spark, name, sources[name], workspace, multi_line=multi_line, infer=infer),
        )
    if again:
        record.steps.pop("build", None)
    view = build(spark, workspace, record=record, **build_options)
    record.end()
    return view


def register_views(
    spark: SparkSession,
    providers: DataFrame,
    crosswalk: DataFrame,
    fips: DataFrame,
    county_pop: DataFrame,
    nucc: DataFrame,
    population_order: str = "text",
) -> None:
    """Temporary views under the table names stakeholders query with SQL.

    Like any view they are computed when read; ``build`` writes them instead. The tables
    are those that ``load`` wrote; ``county_pop`` may have its population renamed.
    """
    cleaned = subset.provider_subset(providers)
    zips = geography.zip_lookup(
        crosswalk,
        geography.county_population(readers.rename_population(county_pop), fips),
        population_order,
    )
    full = enrich.provider_county_full(cleaned, zips, enrich.taxonomy_lookup(nucc))
    views = {
        "nppes": providers,
        "nucc": nucc,
        "fips": fips,
        "zip": crosswalk,
        "county_pop": county_pop,
        "nppes_subset": cleaned,
        "provider_county_full": full,
        "view_county": full.select(*enrich.VIEW_COLUMNS),
        **{name: mart(full) for name, mart in MARTS.items()},
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
