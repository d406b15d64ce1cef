"""Document fingerprints by one-permutation MinHash, DataFrame functions only.

Every shingle of five words is hashed once. The leading bits of the hash name one of
``BINS`` bins, and a bin keeps its smallest hash. An empty bin borrows from another by
optimal densification: it probes bins in an order of its own, the same for every text,
until one is filled. Of each bin the lowest ``BITS`` bits stay, packed into longs; two
texts then agree in a bin with probability j + (1 - j) / 2^BITS for a likeness of j, which
``likeness`` turns round.

All of a text's work is done where the text is: sorting its hashes puts each bin's
smallest first, and a marker for each bin, larger than its hashes, shows the empty ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: The white space between words, as regular expressions have it in brackets.
SPACE_CLASS = r"\x20\x09-\x0D"
SHINGLE = 5
BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
BITS = 4
#: Bits of a hash below those that name its bin. All of them set: the bin's marker.
REST = 64 - BINS_LOG2
MARKER = (1 << REST) - 1
LONGS = BINS * BITS // 64
#: Probes of an empty bin that are written out; after them the order goes on through the
#: filled bins alone, smallest draw first.
PROBES = 8
#: A null doc_id comes behind all others in descending order.
NO_ID = -(1 << 63)


def shingle_hashes(words: Column) -> Column:
    """A hash per shingle, repeats included, from the hashes of the words; a shorter text
    is one shingle as a whole."""
    last = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
    starts = F.slice(words, F.lit(1), F.least(F.size(words), last))
    return F.transform(
        starts, lambda first, i: F.xxhash64(first, *[F.get(words, i + n) for n in range(1, SHINGLE)])
    )


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of the column ``text`` as ``name``, an array of longs.

    A null or a text without words has zeros only. Columns named ``name`` and an underscore
    are used on the way. Each step is a column that the next one names more than once:
    Spark would work out one named once anew for every element of a lambda.
    """
    kept = rows.columns
    words, hashes, bins, filled, full = (f"{name}_{step}" for step in ("words", "hashes", "bins", "filled", "full"))
    empty = F.lit(MARKER)
    markers = F.transform(
        F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)), lambda b: b * F.lit(1 << REST) + empty
    )
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")
    rows = rows.withColumn(words, F.transform(found, lambda word: F.xxhash64(word)))
    rows = rows.withColumn(hashes, F.sort_array(F.concat(shingle_hashes(F.col(words)), markers)))

    def new_bin(value: Column, i: Column) -> Column:
        before = F.get(hashes, i - 1)
        return before.isNull() | (F.shiftright(value, REST) != F.shiftright(before, REST))

    smallest = F.transform(F.filter(F.col(hashes), new_bin), lambda value: value.bitwiseAND(empty))
    rows = rows.withColumn(bins, smallest)
    numbers = F.sequence(F.lit(0), F.lit(BINS - 1))
    rows = rows.withColumn(filled, F.filter(numbers, lambda b: F.get(bins, b) != empty))

    def densified(value: Column, b: Column) -> Column:
        probes = [F.get(bins, F.pmod(F.xxhash64(b, F.lit(p)), F.lit(BINS)).cast("int")) for p in range(PROBES)]
        draws = F.transform(F.col(filled), lambda j: F.struct(F.xxhash64(b, j, F.lit(-1)).alias("draw"), j.alias("bin")))
        last = F.get(bins, F.array_min(draws)["bin"])
        return F.coalesce(*[F.nullif(found, empty) for found in (value, *probes)], last)

    dense = F.when(F.size(filled) > 0, F.transform(F.col(bins), densified))
    rows = rows.withColumn(full, dense.otherwise(F.array_repeat(F.lit(0).cast("bigint"), BINS)))
    low = F.lit((1 << BITS) - 1)
    packed = [
        F.aggregate(
            F.slice(full, start, 64 // BITS),
            F.lit(0).cast("bigint"),
            lambda sofar, value: F.shiftleft(sofar, BITS).bitwiseOR(value.bitwiseAND(low)),
        )
        for start in range(1, BINS + 1, 64 // BITS)
    ]
    return rows.withColumn(name, F.array(*packed)).select(*kept, name)


def as_text(fingerprint: str) -> Column:
    return F.array_join(F.transform(fingerprint, lambda part: F.lower(F.lpad(F.hex(part), 16, "0"))), "")


def likeness(one: str, other: str) -> Column:
    """How alike the shingles behind two fingerprints are, 0 to 1: the share of bins that
    agree, less what agrees by chance. Nothing is like a text without words but another."""
    differing = []
    for n in range(LONGS):
        apart = F.get(one, F.lit(n)).bitwiseXOR(F.get(other, F.lit(n)))
        any_bit = reduce(Column.bitwiseOR, [F.shiftrightunsigned(apart, bit) for bit in range(BITS)])
        ones = int(("0" * (BITS - 1) + "1") * (64 // BITS), 2)
        differing.append(F.bit_count(any_bit.bitwiseAND(F.lit(ones))))
    agreeing = 1 - sum(differing[1:], differing[0]) / F.lit(float(BINS))
    chance = 2.0**-BITS
    estimate = F.greatest((agreeing - chance) / (1 - chance), F.lit(0.0))

    def wordless(fingerprint: str) -> Column:
        return F.array_max(fingerprint).eqNullSafe(0) & F.array_min(fingerprint).eqNullSafe(0)

    return (
        F.when(wordless(one) & wordless(other), 1.0)
        .when(wordless(one) | wordless(other), 0.0)
        .otherwise(estimate)
    )


def with_next(docs: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``next_`` versions of ``columns``: those of the next
    row by descending doc_id, and for the last row those of the first.

    A null doc_id comes last; rows with one doc_id follow each other by a hash of their text.
    Rows are dealt to ``parts`` ranges of doc_id, each a group of a window; a doc_id that
    fills several ranges is cut by the hash. The first row of each range is also put at
    the end of the range before. What comes to the driver is two numbers a range.
    """
    if parts is None:
        parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(NO_ID))
    tie = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx(key, shares or [0.5], max(10_000, 10 * parts))).first()[0]
    cuts = sorted(cuts or [], reverse=True) if parts > 1 else []
    bounds = F.array(*[F.lit(cut).cast("bigint") for cut in cuts]).cast("array<bigint>")
    above = F.size(F.filter(bounds, lambda cut: cut > F.col("order_key")))
    level = F.size(F.filter(bounds, lambda cut: cut == F.col("order_key")))
    share = F.floor(F.col("order_tie") / F.lit(2.0**63) * (F.col("level") + 1)).cast("int")
    ranged = (
        docs.withColumns({"order_key": key, "order_tie": tie})
        .withColumns({"above": above, "level": level})
        .withColumn("range", F.col("above") + F.least(share, F.col("level")))
    )
    keys = staged(ranged.select("range", "order_key", "order_tie"), "ranges")
    tops = dict(keys.groupBy("range").agg(F.max("order_key")).collect())
    heads = [F.lit(tops.get(n)).cast("bigint") for n in range(parts)]
    head_key = F.get(F.array(*heads), F.col("range"))
    first = keys.where(F.col("order_key") == head_key).groupBy("range").agg(F.min("order_tie"))
    ties = dict(first.collect())
    used = sorted(tops)
    before = {n: used[i - 1] for i, n in enumerate(used)}
    head_tie = F.get(F.array(*[F.lit(ties.get(n)).cast("bigint") for n in range(parts)]), F.col("range"))
    range_before = F.get(F.array(*[F.lit(before.get(n)).cast("int") for n in range(parts)]), F.col("range"))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("again"))
    again = F.struct(range_before.alias("range"), F.lit(True).alias("again"))
    is_head = (F.col("order_key") == head_key) & (F.col("order_tie") == head_tie)
    dealt = ranged.withColumn("place", F.explode(F.when(is_head, F.array(own, again)).otherwise(F.array(own))))
    in_order = Window.partitionBy("place.range").orderBy("place.again", F.desc("order_key"), "order_tie")
    following = {f"next_{name}": F.lead(name).over(in_order) for name in columns}
    return dealt.withColumns(following).where("NOT place.again").select(*docs.columns, *following)


def edited(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """A row per document (doc_id, text; others are ignored): doc_id, n_chars, edited (the
    text whose last half is that of the next document), the fingerprints of both as arrays
    of longs, and near_edited and near_next, the text's likeness to the edited one and to
    the next document's. See ``with_next`` for what is next.

    A null text counts as empty. An empty table gives no rows; of a single row the next
    one is itself.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_fingerprint(texts, "text", "fingerprint")
    rows = with_next(own, ["text", "fingerprint"], parts).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    start = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.withColumn("edited", F.concat(start, F.substring("next_text", F.lit(1), half)))
    rows = with_fingerprint(rows.drop("text", "next_text"), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
