"""How a chain of filters acts in every order: what each step removes, finds removed
already, or alone would have caught.

Five filters: few words, repeated words, capitals, markup characters, and copies of an
earlier document. The first four look at one text. The fifth is an existential self-join:
a left semi join on hash, exact text and a smaller doc_id. The rows it marks and those that
fail the others are united, each row's failures become one combination of bits, and all
orders follow from the counts per combination: a step's result depends on the set of
filters before it, not on their order.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, numbered, staged

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
SETS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
#: Rows of a copied text that one group of the self-join takes; a text with more copies
#: is dealt to as many groups as it needs.
GROUP_ROWS = 512


def own_failures(text: Column, words: Column) -> Column:
    """The bits of the filters A to D for a text and its array of words."""
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def copies(rows: DataFrame, row: str) -> DataFrame:
    """The column ``row`` of those ``rows`` (doc_id, text, hash) whose text a smaller doc_id
    has, by a left semi join on hash, exact text and smaller doc_id.

    The right side has each text once, with its smallest doc_id, and again for every
    ``GROUP_ROWS`` copies, so that no group of the join is larger however many copies
    there are: at most one further row for that many rows of the table. Texts whose hash
    stands alone are not moved. A null doc_id is neither smaller nor larger than another.
    """
    counted = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = staged(counted, "copied-hashes")
    candidates = rows.select(row, "doc_id", "hash", "text").join(counted, "hash")
    groups = F.ceil(F.col("n") / GROUP_ROWS)
    firsts = (
        candidates.groupBy("hash", "text", groups.alias("groups"))
        .agg(F.min("doc_id").alias("first"))
        .select("hash", "text", "first", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))
        .alias("earlier")
    )
    later = candidates.withColumn("group", F.pmod(F.xxhash64(row), groups)).alias("later")
    same = [F.col(f"later.{name}") == F.col(f"earlier.{name}") for name in ("hash", "group", "text")]
    smaller = F.col("earlier.first") < F.col("later.doc_id")
    return later.join(firsts, [*same, smaller], "left_semi").select(row)


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents' failures, counted: part, bits, n, good, toxic. See ``audit``."""
    texts = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows, row = numbered(texts.withColumn("hash", F.xxhash64("text")))
    words = free_name(rows, "words")
    worded = rows.withColumn(words, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    measured = worded.select(row, "doc_id", "part", own_failures(F.col("text"), F.col(words)).alias("own"))
    measured = staged(measured, "failures")

    failed = measured.where("own > 0").select(row, F.col("own").alias("bits"))
    failed = failed.union(copies(rows, row).select(row, F.lit(COPY).alias("bits")))
    bits = failed.groupBy(row).agg(F.bit_or("bits").alias("bits"))
    judged = measured.join(bits, row, "left").select(
        "doc_id", "part", F.coalesce("bits", F.lit(0)).alias("bits")
    )

    marks = {"good": "quality", "toxic": "toxic"}
    label = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max((F.coalesce(F.col(of), F.lit(0)) == 1).cast("int")).alias(to) for to, of in marks.items()]
    )
    # Rows without a doc_id have no label and stay out of the join, where they would meet.
    known = judged.where(F.col("doc_id").isNotNull()).join(label, "doc_id", "left").drop("doc_id")
    unknown = judged.where(F.col("doc_id").isNull()).drop("doc_id")
    return (
        known.unionByName(unknown, allowMissingColumns=True)
        .groupBy("part", "bits")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.coalesce(F.col(mark), F.lit(0))).cast("bigint").alias(mark) for mark in marks],
        )
    )


def _weights() -> list[list[int]]:
    """For a filter and a set of filters, in how many orders just that set comes before it."""
    found = [[0] * SETS for _ in FILTERS]
    for order in ORDERS:
        before = 0
        for letter in order:
            at = FILTERS.index(letter)
            found[at][before] += 1
            before |= 1 << at
    return found


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (value of source, null as ''), order of the five filters and step.

    kept: documents left after the step; removed: those it removes; redundant: those that
    fail its filter but are gone; unique_fails: those that fail no other filter; good_lost
    and toxic_lost: removed ones that ``labels`` (doc_id, quality, toxic) marks; shapley:
    what the filter removes, summed over all orders. A null text counts as empty; equal
    texts are equal whatever their length; of rows with one doc_id none is a copy of the
    other. A document with several labels has a mark if one of them has it. Other columns
    are ignored; an empty table gives no rows.
    """
    counted = staged(combinations(docs, labels), "combinations")

    def clean_of(measure: str) -> Column:
        """By set of filters: the documents that fail none of the set."""
        return F.array(
            *[
                F.sum(F.when(F.col("bits").bitwiseAND(F.lit(s)) == 0, F.col(measure)).otherwise(0))
                for s in range(SETS)
            ]
        )

    alone = F.array(
        *[F.sum(F.when(F.col("bits") == 1 << f, F.col("n")).otherwise(0)) for f in range(len(FILTERS))]
    )
    parts = counted.groupBy("part").agg(
        *[clean_of(measure).alias(measure) for measure in ("n", "good", "toxic")], alone.alias("alone")
    )
    shapley = F.array(
        *[
            sum(
                (F.get("n", F.lit(s)) - F.get("n", F.lit(s | 1 << f))) * times
                for s, times in enumerate(row)
                if times
            )
            for f, row in enumerate(_weights())
        ]
    )
    befores = [[sum(1 << FILTERS.index(c) for c in order[:i]) for i in range(len(order))] for order in ORDERS]
    place = F.col("place")
    order = F.get(F.lit(ORDERS), F.floor(place / len(FILTERS)).cast("int"))
    steps = (
        parts.withColumn("shapley", shapley)
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) * len(FILTERS) - 1))))
        .withColumn("before", F.get(F.lit(sum(befores, [])), place))
        .withColumn("filter_order", order)
        .withColumn("step", (place % len(FILTERS) + 1).cast("int"))
        .withColumn("filter", F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1)
        .withColumn("after", F.col("before").bitwiseOR(F.call_function("shiftleft", F.lit(1), F.col("filter"))))
    )

    def removed(measure: str) -> Column:
        return F.get(measure, F.col("before")) - F.get(measure, F.col("after"))

    failing = F.get("n", F.lit(0)) - F.get("n", F.call_function("shiftleft", F.lit(1), F.col("filter")))
    return steps.select(
        "part",
        "filter_order",
        "step",
        F.get("n", F.col("after")).alias("kept"),
        removed("n").alias("removed"),
        (failing - removed("n")).alias("redundant"),
        F.get("alone", F.col("filter")).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("filter")).alias("shapley"),
    )
