"""Exact de-duplication by deterministic block naming, DataFrame functions only.

The normalised text is cut into blocks of a fixed length. Equal blocks get equal
integer names by sorting them; names of adjacent blocks are paired and the pairs
named in the same way, until one name is left. Two texts have the same number of
blocks and the same last name exactly if they are equal: no step relies on a hash
being free of collisions.

The sort goes by (64-bit hash, ordinal), where the ordinal tells different blocks of
one hash apart by their content. Only this comparison needs the content, in one
shuffle with map-side combining; all later steps move integers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, numbered, staged

BLOCK = 1024
#: Names are dealt in this many sorted runs, so that no task sorts all of them.
RUNS = 8192


def normalised(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return reduce(lambda rest, space: F.replace(rest, F.lit(space), F.lit("")), SPACES, text)


def _blocks(text: Column, length: int) -> Column:
    """At least one block; that of an empty text is empty."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(found)


def _sorted_names(keys: DataFrame) -> DataFrame:
    """Distinct ``keys`` with an integer ``name`` each: its place in its sorted run."""
    run = F.pmod(F.xxhash64(*keys.columns), F.lit(RUNS))
    distinct = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("run", run)
    place = F.row_number().over(Window.partitionBy("run").orderBy(*keys.columns))
    name = place.cast("bigint") * RUNS + F.col("run")
    return staged(distinct.select(*keys.columns, name.alias("name")), "names")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace ``keys`` by their name. Both sides of the join are plain reads, so that
    adaptive execution can split the rows of a name that many documents share."""
    return staged(rows.join(_sorted_names(rows.select(*keys)), keys).drop(*keys), "named")


def groups_of_equals(
    docs: DataFrame,
    row: str | None = None,
    block: int = BLOCK,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, keep_id, group_size, kept, text_sha256 and, if ``row`` names a column that
    numbers the rows, that column.

    Texts are equal when identical without ASCII white space; null counts as empty,
    and all empty texts are equal. Of equal texts the longest original stays, then the
    smallest doc_id, a null doc_id last; of rows that repeat in full, one stays.
    ``keep_id`` is null where the row that stays has none. An empty table gives none.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    texts = docs.select(
        number.alias("row"), F.col("doc_id"), F.col("text"), normalised(F.col("text")).alias("norm")
    )
    cut = texts.withColumn("blocks", _blocks(F.col("norm"), block))

    # Different blocks with one hash, almost always none: their contents, numbered.
    contents = cut.select(F.explode("blocks").alias("block"))
    contents = contents.select(block_hash(F.col("block")).alias("hash"), "block").distinct()
    clashing = contents.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    clashing = staged(clashing.select("hash"), "clashes")
    ordinal = F.row_number().over(Window.partitionBy("hash").orderBy("block"))
    ordinals = staged(
        contents.join(clashing, "hash", "left_semi").withColumn("ordinal", ordinal), "ordinals"
    )

    pieces = cut.select(
        "row",
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("points"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.size("blocks").cast("bigint").alias("blocks"),
        F.posexplode("blocks").alias("pos", "block"),
    ).withColumn("hash", block_hash(F.col("block")))
    first = F.col("pos") == 0
    pieces = pieces.join(ordinals, ["hash", "block"], "left").select(
        "row",
        "blocks",
        F.col("pos").cast("bigint").alias("pos"),
        "hash",
        F.coalesce("ordinal", F.lit(0)).alias("ordinal"),
        *[F.when(first, F.col(c)).alias(c) for c in ("doc_id", "points", "text_sha256")],
    )
    pieces = staged(pieces, "blocks")

    current = _named(pieces.select("row", "blocks", "pos", "hash", "ordinal"), ["hash", "ordinal"])
    current = current.withColumn("left", F.col("blocks"))
    most = pieces.agg(F.max("blocks")).first()[0] or 1
    whole = [current.where("left = 1")]
    for _ in range((most - 1).bit_length()):
        pairs = (
            current.where("left > 1")
            .withColumn("odd", F.col("pos") % 2 == 1)
            .withColumn("pos", F.shiftright("pos", 1))
            .groupBy("row", "blocks", "left", "pos")
            .agg(
                F.max(F.when(~F.col("odd"), F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(F.col("odd"), F.col("name"))), F.lit(0)).alias("second"),
            )
            .withColumn("left", F.shiftright(F.col("left") + 1, 1))
        )
        current = _named(pairs, ["first", "second"])
        whole.append(current.where("left = 1"))
    identity = reduce(DataFrame.unionByName, [w.select("row", "blocks", "name") for w in whole])

    attributes = pieces.where("pos = 0").select("row", "doc_id", "points", "text_sha256")
    rows = staged(attributes.join(identity, "row"), "identities")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull(), "doc_id", "row"))
    groups = rows.groupBy("blocks", "name").agg(
        F.count(F.lit(1)).alias("group_size"), best.alias("best")
    )
    groups = staged(groups.where("group_size > 1"), "groups")
    alone = F.col("group_size").isNull()
    return rows.join(groups, ["blocks", "name"], "left").select(
        *([F.col("row").alias(row)] if row else []),
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, row = numbered(docs)
    kept = groups_of_equals(rows, row).where("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)
