import glob
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from provider_analytics import cli
from provider_analytics.operators import publish, quality
from provider_analytics.operators.quality import QualityError
from provider_analytics.plans import builds, jobs, record, storage
from provider_analytics.plans.adapter import Inputs
from provider_analytics.sources.schema import POPULATION_HEADERS

SMALL = "/root/testdata/sf0.001"


def land(spark, folder, providers=None):
    """Write all five inputs as files and return where they are."""
    given = Inputs(spark, SMALL)
    sources = {
        name: f"{folder}/landing/{name}" for name in ("nppes", "nucc", "fips", "zip", "county_pop")
    }
    (given.raw_providers if providers is None else providers).write.parquet(sources["nppes"])
    publish.export_csv(given.raw_nucc, sources["nucc"])
    publish.export_csv(given.fips, sources["fips"])
    publish.export_csv(given.crosswalk, sources["zip"])
    header = F.array(F.array(*[F.lit(name) for name in POPULATION_HEADERS]))
    given.county_pop.select(
        F.to_json(F.concat(header, F.array(F.array(*POPULATION_HEADERS))))
    ).write.text(sources["county_pop"])
    return sources


PUBLISHED = list(jobs.PUBLISHED)


def published(spark, workspace):
    """The rows behind every published name."""
    return {name: Counter(map(tuple, spark.table(workspace.table(name)).collect())) for name in PUBLISHED}


class Stopped(Exception):
    pass


@pytest.fixture
def database(spark):
    """Each test gets tables of its own."""
    name = f"jobs_{storage.uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def test_run_twice_gives_the_same_view(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    export = str(tmp_path / "result")
    first = jobs.run(spark, sources, workspace, expected_rows=1500, export_path=export)
    again = jobs.run(spark, sources, workspace, expected_rows=1500, export_path=export)
    assert again.count() == again.select("npi").distinct().count() == 1500
    assert first.exceptAll(again).isEmpty()
    lines = [line for name in glob.glob(f"{export}/*.csv") for line in open(name)]
    assert len(lines) == 1001
    assert lines[0].strip() == ",".join(again.columns)
    assert lines[1].startswith("1000000000,")
    assert spark.table(f"{database}.ranked_zip").count() == 60


def test_missing_source_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no source for zip"):
        jobs.run(
            spark,
            dict.fromkeys(["nppes", "nucc", "fips", "county_pop"], "x"),
            jobs.Workspace(str(tmp_path)),
        )


def test_failed_check_publishes_nothing(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    before = jobs.run(spark, sources, workspace).count()
    with pytest.raises(QualityError):
        jobs.build(spark, workspace, expected_rows=100_000)
    raw = spark.read.parquet(sources["nppes"])
    twice = f"{tmp_path}/twice"
    raw.union(raw.limit(1)).write.parquet(twice)
    jobs.load(spark, "nppes", twice, workspace)
    with pytest.raises(QualityError, match="repeated"):
        jobs.build(spark, workspace)
    assert spark.table(f"{database}.view_county").count() == before


def test_malformed_rows_stop_or_go_to_quarantine(spark, tmp_path, database):
    raw = Inputs(spark, SMALL).raw_providers
    bad = raw.withColumn("NPI", F.expr("if(NPI % 500 = 0, concat('X', NPI), NPI)"))
    sources = land(spark, tmp_path, bad)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jobs.run(spark, sources, workspace)
    view = jobs.build(spark, workspace, quarantine=True)
    assert view.count() == 1497
    assert spark.table(f"{database}.nppes_malformed").count() == 3
    counts = spark.table(f"{database}.county_provider_counts")
    assert counts.agg(F.sum("provider_count")).first()[0] == 1497
    mended = f"{tmp_path}/mended"
    bad.where("NPI NOT LIKE 'X%'").write.parquet(mended)
    jobs.load(spark, "nppes", mended, workspace)
    export = f"{tmp_path}/all"
    jobs.build(spark, workspace, export_path=export, export_rows=None)
    assert spark.table(f"{database}.nppes_malformed").isEmpty()
    assert spark.read.option("header", True).csv(export).count() == 1497


def test_a_join_that_multiplies_rows_stops_the_build(spark, tmp_path, database, monkeypatch):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    jobs.run(spark, sources, workspace)
    monkeypatch.setattr(jobs.enrich, "taxonomy_lookup", lambda nucc: nucc.union(nucc))
    with pytest.raises(QualityError, match="one row per npi"):
        jobs.build(spark, workspace)
    assert spark.table(f"{database}.view_county").count() == 1500


def test_population_refresh_alone(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    table = jobs.refresh_population(spark, sources["county_pop"], workspace)
    assert table.columns == POPULATION_HEADERS
    assert jobs.refresh_population(spark, sources["county_pop"], workspace).count() == table.count()


def test_command_line(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    root = ["--root", str(tmp_path / "tables"), "--database", database]
    cli.main(spark, ["load", *root, *[f"{name}={path}" for name, path in sources.items()]])
    options = ["--expected-rows", "1500", "--population-order", "numeric", "--cluster-by-county"]
    cli.main(spark, ["build", *root, *options])
    view = spark.table(f"{database}.view_county")
    assert view.count() == 1500
    for file in view.inputFiles():
        counties = [r.county_name or "" for r in spark.read.parquet(file).collect()]
        assert counties == sorted(counties)
    with pytest.raises(SystemExit):
        cli.main(spark, ["load", *root, "claims=/x"])


class NamedSettings:
    """Stands for a session: only its settings are asked for."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_shared_folder_is_the_one_the_session_names():
    warehouse = {"spark_sql_warehouse_dir": "hdfs:///warehouse"}
    cluster = NamedSettings(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn", **warehouse)
    folder = storage.fresh_folder(cluster, "a")
    assert folder.startswith("hdfs:///shared/provider-analytics/a-")
    assert folder != storage.fresh_folder(cluster, "a")
    for master in ("yarn", "local[2]"):
        unnamed = NamedSettings(spark_master=master, **warehouse)
        assert storage.fresh_folder(unnamed, "a").startswith("hdfs:///warehouse/provider-analytics/a-")


WRITTEN = ["nppes_malformed", "ranked_zip", "providers", *jobs.MARTS]


@pytest.mark.parametrize("stop", [*WRITTEN, "publish", "switch", "row"])
def test_a_build_that_stops_anywhere_leaves_the_last_one(spark, tmp_path, database, monkeypatch, stop):
    """After each table, before and after the names, and before the row that switches."""
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    jobs.run(spark, sources, workspace)
    before = published(spark, workspace)
    assert all(before[name] for name in PUBLISHED if name != "nppes_malformed")
    fewer = f"{tmp_path}/fewer"
    spark.read.parquet(sources["nppes"]).where("NPI % 2 = 0").write.parquet(fewer)
    jobs.load(spark, "nppes", fewer, workspace)

    write, publish_names = builds.write, builds.publish

    def stops(*_):
        raise Stopped

    def writes(*arguments, **named):
        found = write(*arguments, **named)
        if arguments[3] == stop:
            raise Stopped
        return found

    def publishes(*arguments):
        publish_names(*arguments)
        if stop == "publish":
            raise Stopped

    with monkeypatch.context() as patched, pytest.raises(Stopped):
        patched.setattr(builds, "write", writes)
        patched.setattr(builds, "publish", publishes)
        if stop == "switch":
            patched.setattr(builds, "switch", stops)
        if stop == "row":
            patched.setattr("pyspark.sql.classic.dataframe.DataFrame.coalesce", stops)
        jobs.build(spark, workspace)
    assert published(spark, workspace) == before
    jobs.build(spark, workspace)
    after = published(spark, workspace)
    assert sum(after["view_county"].values()) == sum(after["nppes_subset"].values()) == 750
    assert all(after[name] != before[name] for name in ("provider_county_full", *jobs.MARTS))


def test_an_earlier_build_can_be_put_back(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    first = jobs.run(spark, sources, workspace)
    old = builds.current(spark, workspace)
    before = published(spark, workspace)
    fewer = f"{tmp_path}/fewer"
    spark.read.parquet(sources["nppes"]).where("NPI % 2 = 0").write.parquet(fewer)
    jobs.load(spark, "nppes", fewer, workspace)
    second = jobs.build(spark, workspace)
    assert (first.count(), second.count()) == (1500, 750)  # each its own build
    builds.switch(spark, workspace, old)
    assert builds.current(spark, workspace) == old
    assert published(spark, workspace) == before


def test_one_statement_asks_for_the_build_once(spark, tmp_path, database, capsys):
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    jobs.run(spark, land(spark, tmp_path), workspace)
    both = spark.sql(
        f"SELECT * FROM {database}.view_county JOIN {database}.county_provider_counts USING (county_name)"
    )
    both.collect()
    capsys.readouterr()
    both.explain()
    plan = capsys.readouterr().out.split("Initial Plan")[0]
    assert "ReusedSubquery" in plan and "PartitionFilters: [isnotnull(build" in plan


def test_one_database_goes_with_one_root(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    jobs.run(spark, sources, jobs.Workspace(str(tmp_path / "tables"), database))
    with pytest.raises(ValueError, match="one database goes with one root"):
        jobs.run(spark, sources, jobs.Workspace(str(tmp_path / "others"), database))


def test_loading_the_registry_writes_no_data(spark, tmp_path, database):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    table = jobs.load(spark, "nppes", sources["nppes"], workspace)
    assert (table.count(), len(table.columns)) == (1500, 59)
    assert not (tmp_path / "tables").exists()
    other = f"{tmp_path}/it's `other`"
    spark.read.parquet(sources["nppes"]).limit(10).write.parquet(other)
    assert jobs.load(spark, "nppes", other, workspace).count() == 10
    missing = f"{tmp_path}/missing"
    spark.read.parquet(sources["nppes"]).drop("NPI").write.parquet(missing)
    with pytest.raises(AnalysisException):
        jobs.load(spark, "nppes", missing, workspace)
    assert spark.table(f"{database}.nppes").count() == 10


def test_providers_are_written_once_and_counted_while_written(spark, tmp_path, database, monkeypatch):
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)

    def fails(*_):
        raise AssertionError("a table was read again to count it")

    with monkeypatch.context() as patched:
        patched.setattr("pyspark.sql.DataFrame.count", fails)
        patched.setattr("pyspark.sql.classic.dataframe.DataFrame.count", fails)
        jobs.run(spark, land(spark, tmp_path), workspace, expected_rows=1500)
    folders = {path.name for path in (tmp_path / "tables").iterdir()}
    assert not folders & {"view_county", "nppes_subset", "provider_county_full"}
    with pytest.raises(QualityError, match="expected 7 rows, found 1500"):
        jobs.build(spark, workspace, expected_rows=7)


def test_keys_are_checked_without_a_shuffle(spark, tmp_path, database, capsys):
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    jobs.run(spark, land(spark, tmp_path), workspace)
    for name in ("nppes_subset", "view_county"):
        capsys.readouterr()
        quality.key_violations(spark.table(workspace.table(name))).explain()
        plan = capsys.readouterr().out
        assert "Exchange" not in plan.split("Subquery")[0] and "Bucketed: true" in plan


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, database, monkeypatch):
    sources = land(spark, tmp_path)
    workspace = jobs.Workspace(str(tmp_path / "tables"), database)
    loaded, written = [], []
    load, write = jobs.load, builds.write

    def run(stop=None, **options):
        loaded.clear()
        written.clear()

        def loading(spark, name, *rest, **named):
            if name == stop:
                raise Stopped
            loaded.append(name)
            return load(spark, name, *rest, **named)

        def writing(spark, workspace, build, name, *rest, **named):
            if name == stop:
                raise Stopped
            written.append(name)
            return write(spark, workspace, build, name, *rest, **named)

        with monkeypatch.context() as patched:
            patched.setattr(jobs, "load", loading)
            patched.setattr(builds, "write", writing)
            return jobs.run(spark, sources, workspace, **options)

    with pytest.raises(Stopped):
        run("fips")  # the third load
    assert loaded == ["nppes", "nucc"]
    with pytest.raises(Stopped):
        run("county_specialty_distribution")
    assert loaded == ["fips", "zip", "county_pop"]
    assert written == ["nppes_malformed", "ranked_zip", "providers", "county_provider_counts"]
    view = run()
    assert loaded == [] and written == ["county_specialty_distribution", "providers_per_capita"]
    whole = published(spark, workspace)
    assert view.count() == 1500 and sum(whole["county_provider_counts"].values()) > 0

    # A run that ended is followed by a whole one, with the same result.
    run()
    assert loaded == ["nppes", "nucc", "fips", "zip", "county_pop"] and written == WRITTEN
    assert published(spark, workspace) == whole

    # Changed files, or a table replaced by someone else, are loaded again and built anew.
    with pytest.raises(Stopped):
        run("county_specialty_distribution", cluster_by_county=True)
    spark.read.option("header", True).csv(sources["zip"]).limit(5).write.mode("append").option(
        "header", True
    ).csv(sources["zip"])
    load(spark, "fips", sources["fips"], workspace)
    run(cluster_by_county=True)
    assert loaded == ["fips", "zip"] and written == WRITTEN

    # Other options are another run.
    with pytest.raises(Stopped):
        run("zip", name_fallback="full")
    run(name_fallback="person")
    assert len(loaded) == 5


def test_fingerprint_sees_changed_files(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.range(3).write.parquet(path)
    first = record.fingerprint(spark, path)
    assert record.fingerprint(spark, path) == first
    spark.range(1).write.mode("append").parquet(path)
    assert record.fingerprint(spark, path) != first
