"""Scans: provider Parquet, reference CSV, population JSON matrix."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from .names import normalise, normalise_columns
from .schema import POPULATION_VARIABLE, PROVIDER_HEADERS


def quoted(name: str) -> str:
    """A column reference for a header that may hold dots or brackets."""
    return "`" + name.replace("`", "``") + "`"


def project_headers(df: DataFrame, headers: Iterable[str]) -> DataFrame:
    """Exactly ``headers``, in that order; a missing one is an analysis error."""
    return df.select(*[F.col(quoted(header)) for header in headers])


def select_providers(raw: DataFrame) -> DataFrame:
    """The kept registry columns under their normalised names."""
    return normalise_columns(project_headers(raw, PROVIDER_HEADERS))


def read_providers(spark: SparkSession, path: str) -> DataFrame:
    """Registry Parquet. Only the columns a job goes on to use are read from disk."""
    return select_providers(spark.read.parquet(path))


def fill_null_text(df: DataFrame) -> DataFrame:
    """NULL becomes ``''`` in text columns; other types keep their NULLs."""
    return df.na.fill("")


# What counts as a number in a CSV field.
_INTEGER = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def infer_types(text: DataFrame) -> dict[str, str]:
    """The narrowest type that holds every field of a text column, from one pass over all
    rows: bigint, double, or no entry for text and for columns without a value."""

    def level(name: str) -> Column:
        field = F.col(quoted(name))
        whole = field.rlike(_INTEGER) & field.try_cast("bigint").isNotNull()
        return (
            F.when(field.isNull() | (field == ""), 0)
            .when(whole, 1)
            .when(field.rlike(_NUMBER), 2)
            .otherwise(3)
        )

    if not text.columns:
        return {}
    found = text.agg(*[F.max(level(name)).alias(str(i)) for i, name in enumerate(text.columns)]).first()
    kinds = {1: "bigint", 2: "double"}
    return {name: kinds[n] for name, n in zip(text.columns, found, strict=True) if n in kinds}


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """file_path and the first line that is not blank, of each file."""
    lines = (
        spark.read.text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .where("file_block_start = 0 AND trim(value) <> ''")
        .select("file_path", "value", F.monotonically_increasing_id().alias("id"))
    )
    firsts = lines.groupBy("file_path").agg(F.min("id").alias("id"))
    return lines.join(firsts, ["file_path", "id"]).select("file_path", F.col("value").alias("header"))


def _csv_text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """All fields as text under normalised names, files joined by name."""

    def reader() -> DataFrameReader:
        return (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("escape", '"')
            .option("multiLine", multi_line)
        )

    one_layout = normalise_columns(reader().option("enforceSchema", False).csv(path))
    if len(one_layout.inputFiles()) < 2:
        return one_layout
    headers = _first_lines(spark, path)
    lines = headers.groupBy("header").agg(F.min("file_path").alias("first")).collect()
    if len(lines) < 2:
        return one_layout
    lines = [row["header"] for row in sorted(lines, key=lambda row: row["first"])]
    layouts = {line: normalise(next(csv.reader([line]))) for line in lines}
    wanted = layouts[lines[0]]
    for names in layouts.values():
        if sorted(names) != sorted(wanted):
            raise ValueError(f"CSV headers differ in {path}: {wanted}, {names}")
    # One scan of all files by position; the header says which position a column has.
    positions = [f"c{i}" for i in range(len(wanted))]
    rows = reader().schema(", ".join(f"{c} string" for c in positions)).csv(path)
    named = rows.select("*", "_metadata.file_path").join(headers, "file_path")
    return named.select(
        *[
            F.coalesce(
                *[
                    F.when(F.col("header") == line, F.col(positions[names.index(name)]))
                    for line, names in layouts.items()
                ]
            ).alias(name)
            for name in wanted
        ]
    )


def read_reference_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header row, all columns kept.

    Columns named in ``types`` get that type: a field that does not parse becomes NULL
    and the row stays. With ``infer`` the others get the type that holds all their fields
    (``infer_types``), which takes a pass over the files. What is left is text with NULL
    filled by ``''``. The files of a folder may have their columns in different orders, told
    by their first lines; the order is then that of the first file by name. Other columns are
    an error.
    """
    text = _csv_text(spark, path, multi_line)
    types = types or {}
    if infer:
        types = infer_types(text.drop(*types)) | dict(types)
    typed = text.withColumns({name: F.col(quoted(name)).try_cast(kind) for name, kind in types.items()})
    return fill_null_text(typed)


def _malformed(what: str, piece: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what}: "), F.left(piece, F.lit(200))))


def _matrix_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with JSON matrices or rows of them: opens and closes, whether a matrix begins or
    ends in the line, and rows."""
    # Separators between rows go; brackets that a line lacks are added below.
    piece = F.expr(r"trim(TRAILING ', \t\r' FROM trim(LEADING ' \t' FROM value))")
    pieces = spark.read.text(path).select(
        piece.alias("piece"),
        piece.startswith("[[").alias("opens"),
        piece.endswith("]]").alias("closes"),
    )
    matrix = F.concat(
        F.when(F.col("opens"), "").otherwise("["),
        "piece",
        F.when(F.col("closes"), "").otherwise("]"),
    )
    # A parser stops at the end of the first value; what follows must not get lost.
    outline = F.regexp_replace("piece", r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "0")
    several = _malformed("more than one JSON matrix in one piece", F.col("piece"))
    rows = F.when(outline.rlike(r"\]\s*\]\s*\S"), several).otherwise(
        F.coalesce(
            F.from_json(matrix, "array<array<string>>"),
            _malformed("malformed JSON matrix", F.col("piece")),
        )
    )
    return pieces.where("piece <> ''").select("opens", "closes", rows.alias("rows"))


def _matrix_brackets(spark: SparkSession, path: str) -> DataFrame:
    """The same for files of any layout, cut behind every closing bracket, so that a file on
    one line is read by many tasks too: opens, closes and rows, a row at a time.

    A bracket may stand in a cell. Whether a cut lies in a cell follows from the number of
    quotes before it, added up within each block of a file and then over its blocks;
    the few pieces of rows that were cut in a cell are put together again.
    """
    value = F.col("value")
    quotes = F.length(F.regexp_replace(F.regexp_replace(value, r"\\.", ""), '[^"]', "")) % 2
    pieces = (
        spark.read.option("lineSep", "]")
        .text(path)
        .select("value", "_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start")
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("quotes", quotes.cast("bigint"))
    )
    block = ["file_path", "file_block_start"]
    before = Window.partitionBy(*block).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy(*block).agg(
        F.sum("quotes").alias("block_quotes"),
        F.sum(F.octet_length("value").cast("bigint") + 1).alias("block_bytes"),
        F.max("file_size").alias("file_size"),
    )
    whole = Window.partitionBy("file_path")
    blocks = blocks.select(
        *block,
        F.coalesce(F.sum("block_quotes").over(earlier), F.lit(0)).alias("quotes_before"),
        F.sum("block_quotes").over(whole).alias("file_quotes"),
        # The last piece of a file that does not end in a bracket seems a byte too long.
        (F.sum("block_bytes").over(whole) > F.col("file_size")).alias("open_end"),
        (F.row_number().over(whole.orderBy(F.desc("file_block_start"))) == 1).alias("last_block"),
    )
    inside = (F.col("quotes_before") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 1
    last = F.lead("id").over(Window.partitionBy(*block).orderBy("id")).isNull()
    told = (
        pieces.drop("file_size")
        .join(blocks, block)
        .withColumn("inside", inside)
        .withColumn("open_end", F.col("open_end") & F.col("last_block") & last)
        .withColumn("cut", F.col("inside") | ((F.col("quotes") == 1) & ~F.col("inside")))
    )
    cut_off = F.col("file_quotes") % 2 == 1
    told = told.withColumn("value", F.when(cut_off, _malformed("malformed JSON matrix", value)).otherwise(value))
    # Cut rows are rare: they are numbered among themselves, by where they begin.
    in_file = Window.partitionBy("file_path").orderBy("file_block_start", "id")
    cut = told.where("cut").withColumn("number", F.count_if(~F.col("inside")).over(in_file))
    mended = cut.groupBy("file_path", "number").agg(
        F.sort_array(F.collect_list(F.struct("file_block_start", "id", "value"))).alias("parts"),
        F.bool_or("open_end").alias("open_end"),
    )
    joined = F.array_join(F.transform("parts", lambda part: part["value"]), "]")
    place = F.struct("file_block_start", "id")
    units = told.where("NOT cut").select("file_path", "open_end", place.alias("place"), "value")
    first = F.struct(*[F.get("parts", F.lit(0))[name] for name in ("file_block_start", "id")])
    units = units.union(mended.select("file_path", "open_end", first, joined))

    head = F.regexp_extract("value", r"^[\s,\[]*", 0)
    blank = F.col("value").rlike(r"^\s*$")
    opens = head.rlike(r"^\s*\[\s*\[\s*$")
    fits = (opens | head.rlike(r"^\s*,\s*\[\s*$")) & ~F.col("open_end")
    text = F.concat(F.lit("["), F.substring("value", F.length(head) + 1, F.length("value")), F.lit("]"))
    cells = F.from_json(text, "array<string>")
    rows = F.when(blank, F.array().cast("array<array<string>>")).otherwise(
        F.array(F.coalesce(F.when(fits, cells), _malformed("malformed JSON matrix", F.col("value"))))
    )
    return units.where(~(blank & F.col("open_end"))).select(
        "file_path", "place", opens.alias("opens"), blank.alias("closes"), rows.alias("rows")
    )


def read_json_matrix(
    spark: SparkSession, path: str, multi_line: bool = False
) -> DataFrame:
    """``[[header...], [row...], ...]`` as a table in which every cell is text.

    As with Spark's JSON reader, the default needs line ends between records:
    each line holds a whole matrix or some rows of it, as the census service
    writes it. ``multi_line`` takes one matrix a file in any layout. Large files are split
    either way. There may be many files and, on lines, many matrices;
    all must have the same header. Anything malformed or cut off is an error, and so is
    a second matrix on a line, or with ``multi_line`` in a file.
    """
    lines = _matrix_brackets(spark, path) if multi_line else _matrix_lines(spark, path)

    # One row for the driver: the header names become the schema.
    header = F.when(F.col("opens"), F.get("rows", F.lit(0)))
    # In a file of any layout the header comes first and the last bracket last.
    per_file = lines.groupBy("file_path") if multi_line else lines.groupBy()
    out_of_place = F.lit(False)
    if multi_line:
        row = F.when(~F.col("opens") & ~F.col("closes"), F.col("place"))
        opened, closed = (F.when(F.col(name), F.col("place")) for name in ("opens", "closes"))
        out_of_place = (F.min(row) < F.max(opened)) | (F.max(F.coalesce(row, opened)) > F.min(closed))
    found = (
        per_file.agg(
            F.coalesce(out_of_place, F.lit(False)).alias("out_of_place"),
            F.min(header).alias("header"),
            F.max(header).alias("other_header"),
            F.count_if("opens").alias("begun"),
            F.count_if("closes").alias("ended"),
        )
        .agg(
            F.min("header").alias("header"),
            F.max("other_header").alias("other_header"),
            F.sum("begun").alias("begun"),
            F.sum("ended").alias("ended"),
            F.max("begun").alias("most"),
            F.bool_or("out_of_place").alias("out_of_place"),
            F.max(F.abs(F.col("begun") - F.col("ended"))).alias("apart"),
        )
        .first()
    )
    if not found.header:
        raise ValueError(f"no JSON matrix with a header row in {path}")
    if multi_line and found.most > 1:
        raise ValueError(f"more than one JSON matrix in a file of {path}")
    if found.out_of_place:
        raise ValueError(f"malformed JSON matrix in {path}: rows outside of its brackets")
    if found.header != found.other_header:
        raise ValueError(
            f"JSON matrix headers differ in {path}: {found.header}, {found.other_header}"
        )
    if found.apart:
        raise ValueError(
            f"JSON matrix cut off in {path}: {found.begun} begin, {found.ended} end"
        )

    names = found.header
    body = F.when(F.col("opens"), F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0))))
    cells = F.when(F.size("cells") == len(names), F.col("cells")).otherwise(
        F.raise_error(F.lit(f"JSON matrix row does not fit header {names}"))
    )
    return (
        lines.select(F.explode(body.otherwise(F.col("rows"))).alias("cells"))
        .select(cells.alias("cells"))
        .select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)])
    )


def rename_population(county_pop: DataFrame) -> DataFrame:
    """The census variable under the name ``population``, still text; a table that has
    the name already stays as it is."""
    return county_pop.withColumnRenamed(POPULATION_VARIABLE, "population")
