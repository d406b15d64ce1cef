"""What several operators share: the table, staging, row numbers, text classes."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import storage

#: The six ASCII white-space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
#: A word, for Java's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it cuts the lineage, and what
    was computed once (row numbers, names) stays the same if an executor is lost."""
    path = storage.fresh_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Passing:
    """Tables that are needed for some steps only, in the shared folder; ``drop`` deletes them
    when what follows from them has been staged."""

    def __init__(self, spark: SparkSession):
        self.spark, self.workspace, self.names = spark, storage.own_workspace(spark), []

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        name = self.workspace.table(f"llm_{label}_{uuid.uuid4().hex}")
        df.write.format("parquet").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.clear()


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores until no column of ``df`` is called so."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` staged with a row number, and the number's column name. The number tells
    rows apart whose doc_id is null or repeats."""
    row = free_name(docs, "row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def utf8(text: str) -> bytes:
    """The text's bytes; a lone surrogate, which no Parquet text holds, becomes '?'."""
    return text.encode("utf-8", "replace")


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` (with ``n``) that are counted most often, ``most`` of them at
    the utmost: those above the lowest limit, in steps of a sixteenth of a power of two,
    that no more rows reach. A row for each such step comes to the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    least, total = None, 0
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return counts.where(step >= least if least is not None else F.lit(False))
