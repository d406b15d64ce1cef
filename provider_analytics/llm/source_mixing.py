"""Mixing sources to target weights by entropy balancing, DataFrame functions only.

A source's documents get rates that come closest to one copy each, in the sense of
least relative entropy, among all rates whose expected words equal the source's target
and of which none is above ``MAX_COPIES``. The solution is exponentially tilted: the
rate of a document of z words, z in units of the source's typical document, is
``min(MAX_COPIES, exp(m * z))``, and the source's multiplier m solves a convex problem
of one variable, here by Newton's method kept within a bracket.

A rate depends on the source and the size alone, so the iterations run on the counts of
documents by source and size. These are small whatever the corpus holds, and come from
one aggregation with map-side combining. Rates are rounded to whole copies per source
and size, with the words that are missing or over made up by documents that are small
enough, until every document that could change is larger than what is left; the copies
are dealt to the documents in the order of a hash of their doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, numbered, staged

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: The iterations end when no source's expected words are off its target by a larger share,
#: or when a block of steps changes no multiplier any more.
RESIDUAL = 1e-9
#: Steps planned as one query; a plan of many takes long to optimise.
STEPS_AT_ONCE = 6
#: Documents of one source and size are ranked in so many pieces.
BINS = 1 << 16


def _totals(cells: DataFrame) -> DataFrame:
    """key, source_size and weight of each source; weights go round in key order."""
    totals = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    parts = totals.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    parts = staged(parts, "sources")
    # Places within a part, and the rows of the parts before; there are few parts.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = offsets.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key")) + F.col("offset") - 1
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS)).cast("int"))
    return parts.join(offsets, "part").select("key", "source_size", weight.alias("weight"))


def source_targets(cells: DataFrame) -> DataFrame:
    """key, source_size, target: the words each source should give. ``cells``: key, size, n.

    Targets share the words of all sources by weight; one above ``MAX_COPIES`` times its
    source stops there and the excess is shared again. One row of sums a round comes to
    the driver.
    """
    sources = staged(_totals(cells), "totals")
    most = MAX_COPIES * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, last = 0.0, None
    while level != last:
        last = level
        full = most < F.lit(level) * F.col("weight")
        given, open_ = sources.agg(
            F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        level = (total - given) / open_ if open_ else level
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    return sources.select("key", "source_size", target.alias("target"))


def _with_rates(cells: DataFrame) -> DataFrame:
    """Add ``rate``. ``cells``: key, size, n, source_size, target."""
    source = Window.partitionBy("key")
    size, n = F.col("size").cast("double"), F.col("n")
    unit = F.sum(size * size * n).over(source) / F.nullif(F.sum(size * n).over(source), F.lit(0.0))
    cells = cells.withColumn("unit", F.coalesce(unit, F.lit(1.0)))
    grows = F.col("target") > F.col("source_size")
    z = size / F.col("unit")
    # The smallest document has one word, so at ``high`` every rate is at its limit.
    cells = cells.withColumns(
        {
            "m": F.lit(0.0),
            "low": F.lit(0.0),
            "high": F.when(grows, F.col("unit") * F.log(F.lit(float(MAX_COPIES)))).otherwise(0.0),
        }
    )
    rate = F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("m") * z))
    full = F.col("target") >= MAX_COPIES * F.col("source_size")
    ready = ~full & (F.col("target") > 0)
    cells = staged(cells, "newton")
    last = float("inf")
    while True:
        got = F.sum(F.col("n") * size * rate)
        off = cells.where(ready).groupBy("key").agg(F.abs(got / F.any_value("target") - 1).alias("off"))
        worst = off.agg(F.max("off")).first()[0] or 0.0
        # Where doubles are too coarse for the bound, the last digits may go to and fro.
        if worst <= RESIDUAL or last <= worst < 1e3 * RESIDUAL:
            break
        last = worst
        cells = cells.withColumn("was", F.col("m"))
        for _ in range(STEPS_AT_ONCE):
            words = F.col("n") * size * rate
            cells = cells.withColumns(
                {
                    "got": F.sum(words).over(source),
                    "slope": F.sum(F.when(rate < MAX_COPIES, words * z).otherwise(0.0)).over(source),
                }
            )
            # Newton's step on the logarithm of the words: where words must shrink, it comes
            # from the right on a convex curve and never goes too far.
            sloped = (F.col("target") > 0) & (F.col("got") > 0) & (F.col("slope") > 0)
            step = F.log(F.col("got") / F.col("target")) * F.col("got") / F.col("slope")
            newton = F.when(sloped, F.col("m") - step)
            short = F.col("got") < F.col("target")
            low = F.when(grows & short, F.col("m")).otherwise(F.col("low"))
            high = F.when(grows & ~short, F.col("m")).otherwise(F.col("high"))
            cells = cells.withColumns({"low": low, "high": high, "newton": newton})
            inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
            middle = (F.col("low") + F.col("high")) / 2
            m = F.when(grows, F.when(inside, F.col("newton")).otherwise(middle)).otherwise(
                F.coalesce("newton", F.col("m"))
            )
            cells = cells.withColumn("m", m).drop("got", "slope", "newton")
        cells = staged(cells, "newton")
        if not cells.where(ready & (F.col("m") != F.col("was"))).limit(1).count():
            break
    rate = F.when(full, F.lit(float(MAX_COPIES))).otherwise(rate)
    return cells.select("key", "size", "n", "source_size", "target", rate.alias("rate"))


def _with_copies(cells: DataFrame) -> DataFrame:
    """Add ``copies``, the whole copies all documents of a source and size get together."""
    source = Window.partitionBy("key")
    falling = source.orderBy(F.desc("size"))
    most = MAX_COPIES * F.col("n")
    upto = F.sum(F.col("n") * F.col("rate")).over(falling.rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumn("upto", F.floor(upto + 0.5))
    copies = F.col("upto") - F.lag("upto", 1, 0).over(falling)
    cells = cells.withColumn("copies", F.greatest(F.lit(0), F.least(most, copies)))
    while True:
        # Largest first, each size gives what it has as long as that does not go too far.
        # What is left is less than the last size that gave any, and at most half of what
        # there was, so few rounds lead to where every size with room is too large.
        lacks = F.col("target") - F.sum(F.col("size") * F.col("copies")).over(source)
        cells = cells.withColumn("lacks", lacks)
        room = F.when(F.col("lacks") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("lacks"))
        cells = cells.withColumn("room", F.when(fits, room).otherwise(0))
        larger = F.sum(F.col("size") * F.col("room")).over(falling.rowsBetween(Window.unboundedPreceding, -1))
        left = F.abs("lacks") - F.coalesce(larger, F.lit(0))
        change = F.greatest(F.lit(0), F.least(F.col("room"), F.floor(left / F.nullif("size", F.lit(0)))))
        change = F.signum("lacks").cast("bigint") * F.coalesce(change, F.lit(0))
        cells = staged(cells.withColumn("change", change), "copies")
        if not cells.agg(F.max(F.abs("change"))).first()[0]:
            break
        cells = cells.withColumn("copies", F.col("copies") + F.col("change")).drop("room", "lacks", "change")
    return cells.select("key", "size", "n", "source_size", "target", "copies")


def mixed(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; other columns are ignored):
    ``row`` if given, doc_id, size, source_size, target, taken, copies.

    A null or empty text has size 0 and takes no words. Sources go by code point, null
    last; a null source is one of its own. Copies are dealt by a hash of doc_id, then
    doc_id, so reruns agree; rows with one doc_id and size may differ by a copy. An
    empty table gives no rows.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    number = F.col(row) if row else F.monotonically_increasing_id()
    base = docs.select(
        number.alias("row"),
        "doc_id",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("z")).alias("key"),
        size.alias("size"),
        F.pmod(F.xxhash64("doc_id"), F.lit(BINS)).alias("bin"),
    )
    base = staged(base, "sizes")
    bins = staged(base.groupBy("key", "size", "bin").agg(F.count(F.lit(1)).alias("n")), "bins")
    cells = staged(bins.groupBy("key", "size").agg(F.sum("n").alias("n")), "cells")
    plan = staged(_with_copies(_with_rates(cells.join(source_targets(cells), "key"))), "plan")

    cell = Window.partitionBy("key", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.select("key", "size", "bin", F.coalesce(F.sum("n").over(cell), F.lit(0)).alias("before"))
    dealt = staged(before.join(plan, ["key", "size"]), "dealt")
    place = F.row_number().over(
        Window.partitionBy("key", "size", "bin").orderBy(F.xxhash64("doc_id"), "doc_id", "row")
    )
    rows = base.withColumn("place", place).join(dealt, ["key", "size", "bin"])
    extra = (F.col("before") + F.col("place") <= F.col("copies") % F.col("n")).cast("bigint")
    copies = F.floor(F.col("copies") / F.col("n")) + extra
    return rows.select(
        *([F.col("row").alias(row)] if row else []),
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of the mix with all columns of ``docs``, as often as they are taken."""
    rows, row = numbered(docs)
    taken = mixed(rows, row).where("copies > 0")
    again = taken.select(row, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy_"))
    return rows.join(again.drop("copy_"), row).drop(row)
