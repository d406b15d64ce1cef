"""Command line of the jobs: load datasets, build, or run everything.

    spark-submit run_jobs.py run --root DIR --export DIR \\
        nppes=PATH nucc=PATH fips=PATH zip=PATH county_pop=PATH
    spark-submit run_jobs.py load --root DIR county_pop=PATH
    spark-submit run_jobs.py build --root DIR

``load`` and ``build`` find each other's tables when Spark has a metastore.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs
from .sources.registry import DATASETS, dataset


def _source(text: str) -> tuple[str, str]:
    name, separator, path = text.partition("=")
    if not separator or not path:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=PATH")
    try:
        return dataset(name).name, path
    except ValueError as error:
        raise argparse.ArgumentTypeError(str(error)) from None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_jobs.py")
    commands = top.add_subparsers(dest="command", required=True)
    for command in ("load", "build", "run"):
        sub = commands.add_parser(command)
        sub.add_argument("--root", required=True, help="folder for the table files")
        sub.add_argument("--database", default="default")
        if command != "build":
            sub.add_argument(
                "sources",
                nargs="+",
                type=_source,
                help=f"NAME=PATH, names are {', '.join(DATASETS)}",
            )
            sub.add_argument(
                "--multi-line", action="store_true", help="JSON matrices in any layout"
            )
            sub.add_argument(
                "--infer-types", action="store_true", help="CSV columns get the type of their fields"
            )
        if command != "load":
            sub.add_argument("--export", help="folder for the CSV extract")
            sub.add_argument(
                "--export-rows",
                type=lambda text: None if text == "all" else int(text),
                default=jobs.EXPORT_ROWS,
                help="rows of the extract, or all",
            )
            sub.add_argument("--expected-rows", type=int)
            sub.add_argument("--quarantine", action="store_true")
            sub.add_argument("--cluster-by-county", action="store_true")
            sub.add_argument(
                "--population-order", choices=("text", "numeric"), default="text"
            )
            sub.add_argument("--name-fallback", choices=("person", "full"), default="person")
    return top


def main(spark: SparkSession, arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    workspace = jobs.Workspace(given.root, given.database)
    if given.command == "load":
        for name, path in given.sources:
            jobs.load(
                spark, name, path, workspace, multi_line=given.multi_line, infer=given.infer_types
            )
        return
    options = {
        "population_order": given.population_order,
        "name_fallback": given.name_fallback,
        "expected_rows": given.expected_rows,
        "export_path": given.export,
        "export_rows": given.export_rows,
        "quarantine": given.quarantine,
        "cluster_by_county": given.cluster_by_county,
    }
    if given.command == "build":
        jobs.build(spark, workspace, **options)
    else:
        jobs.run(
            spark, dict(given.sources), workspace, given.multi_line, given.infer_types, **options
        )
