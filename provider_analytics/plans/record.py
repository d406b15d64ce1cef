"""A record of what a run has finished, so that the next one goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.publish import sql_name
from .builds import Workspace, ensure_table

_COLUMNS = "run string, settings string, number bigint, step string, detail string"
_END = "end"


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("sum")).first()
    return f"{found['n']}:{found['sum']}"


class RunRecord:
    """The steps of one run: those of the last run with the same ``settings`` if that did not
    reach its end, none otherwise. A step is a row written after its work is done."""

    def __init__(self, spark: SparkSession, workspace: Workspace, settings: dict):
        self.spark, self.folder = spark, workspace.folder("runs")
        self.table = workspace.table("runs")
        self.settings = hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()
        ensure_table(spark, self.table, self.folder, _COLUMNS)
        spark.sql(f"REFRESH TABLE {sql_name(self.table)}")
        rows = spark.table(self.table)
        same = F.col("settings") == self.settings
        last, self.number = rows.agg(F.max_by(F.when(same, F.col("run")), F.when(same, F.col("number"))), F.max("number")).first()
        found = rows.where(same & (F.col("run") == last)).orderBy("number").collect() if last else []
        steps = {row["step"]: row["detail"] for row in found}
        self.run, self.steps = (last, steps) if last and _END not in steps else (uuid.uuid4().hex, {})

    def add(self, step: str, detail: str = "") -> None:
        self.number = (self.number or 0) + 1
        values = [self.run, self.settings, self.number, step, detail]
        names = ["run", "settings", "number", "step", "detail"]
        row = self.spark.range(1).select(
            *[
                F.lit(value).cast("bigint" if name == "number" else "string").alias(name)
                for name, value in zip(names, values, strict=True)
            ]
        )
        row.coalesce(1).write.mode("append").parquet(self.folder)
        self.steps[step] = detail

    def once(self, step: str, detail: Callable[[], str], work: Callable[[], object]) -> bool:
        """Do ``work`` unless the step is recorded with what ``detail`` says now; whether it
        was done. What it says after the work is recorded."""
        if step in self.steps and self.steps[step] == detail():
            return False
        work()
        self.add(step, detail())
        return True

    def end(self) -> None:
        self.add(_END)
