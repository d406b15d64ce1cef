"""Removal of passages that repeat across documents, found by compact windows.

A passage is ``PASSAGE`` words. Of the hashes of its runs of ``RUN`` words the least is
its mark; neighbouring passages share a mark as long as the same run is the least in
them, and together make up one compact window of the document. Equal passages have equal
marks, so a passage can only repeat where its window's mark does. Marks are few, about
two for every ``PASSAGE`` words. Windows under marks of more than one document are compared
whole first, by a digest: all but the first of equal windows go. Where a mark has different
windows, the passages in the first of each are compared by a hash of all their words.
Longer passages are made up of such passages, so every repeat of ``PASSAGE`` words or more
is found, wherever it begins. Passages with changed words are for ``near_passages``.

Marks, windows and passages are counted with map-side combining and no two rows are paired,
so the work stays in proportion to the input for a passage that very many documents hold.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import storage
from .common import WORD, Passing, staged, utf8

PASSAGE = 50
RUN = 16
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 18
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BYTE_WORDS = re.compile(WORD.encode())


class WordHashes(dict):
    """64-bit hashes of words, those seen before from memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = utf8(text or "").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def hashes_of_runs(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each run of ``length`` words: polynomials, put together by halves."""
    whole, size, power = None, 1, base
    part, left, taken = words, length, 0
    while left:
        if left & 1:
            own = part[taken:] if whole is None else part[taken : taken + len(whole)]
            if whole is None:
                whole = own
            else:
                n = min(len(whole), len(own))
                whole = whole[:n] * np.uint64(power) + own[:n]
            taken += size
        left >>= 1
        if left:
            part = part[:-size] * np.uint64(power) + part[size:]
            power, size = power * power % (1 << 64), 2 * size
    return mixed(whole)


def least_of_runs(values: np.ndarray, length: int) -> np.ndarray:
    """The least of each run of ``length`` values."""
    size = 1
    while 2 * size <= length:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    more = length - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def marks_of(words: np.ndarray, passage: int = PASSAGE, run: int = RUN) -> np.ndarray:
    """The mark of the passage that begins at each word; none for a shorter document."""
    if len(words) < passage:
        return np.empty(0, np.uint64)
    return least_of_runs(hashes_of_runs(words, run, BASES[0]), passage - run + 1)


def passages_of(words: np.ndarray, passage: int = PASSAGE) -> np.ndarray:
    """The hash of the passage that begins at each word."""
    return hashes_of_runs(words, passage, BASES[1]) if len(words) >= passage else np.empty(0, np.uint64)


def without(text: str, goes: np.ndarray) -> str:
    """The text without the words that go and the white space after each of them."""
    data = utf8(text)
    begins = np.fromiter((m.start() for m in BYTE_WORDS.finditer(data)), np.int64, len(goes))
    ends = np.append(begins[1:], len(data))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], goes, [False]]).astype(np.int8)))
    kept, at = [], 0
    for first, after in zip(edges[::2], edges[1::2], strict=True):
        kept.append(data[at : begins[first]])
        at = ends[after - 1]
    return b"".join([*kept, data[at:]]).decode()


def _int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def words_in(stored: bytes) -> np.ndarray:
    """The hashes of a row's words."""
    return np.frombuffer(stored, np.uint32).astype(np.uint64)


def in_buckets(docs: DataFrame) -> DataFrame:
    """doc_id, text, a number ``row``, the number ``n`` of words and 32-bit hashes of them, written
    in buckets by row, one file each: texts are split once, and not shuffled again by the
    joins that add something to a row. The name of the table is given up at once; its files
    stay in the shared folder."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_rows_{uuid.uuid4().hex}"
    folder = storage.fresh_folder(spark, "llm-rows")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            words = [hashes.of(text).astype(np.uint32) for text in batch.column("text").to_pylist()]
            counts = pa.array([len(w) for w in words], pa.int64())
            stored = pa.array([w.tobytes() for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts, stored], names=[*batch.schema.names, "n", "words"])

    numbered = docs.select(F.col("doc_id").cast("bigint"), "text", F.monotonically_increasing_id().alias("row"))
    dealt = numbered.repartition(n, "row").mapInArrow(hashed, "doc_id bigint, text string, row bigint, n bigint, words binary")
    dealt = dealt.write.bucketBy(n, "row").sortBy("row")
    dealt.option("path", folder).option("compression", "zstd").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found


def places_of(rows: DataFrame) -> DataFrame:
    """row and its place among all: by doc_id with null last, then the text's hash, then the
    number."""
    order = rows.select("row", "doc_id", F.xxhash64("text").alias("digest"))
    order = order.orderBy(F.col("doc_id").asc_nulls_last(), "digest", "row")
    return staged(order.select("row", F.monotonically_increasing_id().alias("place")), "order")


def left_of(n: int, goes: list[dict] | None) -> np.ndarray:
    """Which of ``n`` words are left without the ranges (at, n) of ``goes``."""
    edges = np.zeros(n + 1, np.int64)
    if goes:
        begins, sizes = (np.array([r[k] for r in goes], np.int64) for k in ("at", "n"))
        np.add.at(edges, begins, 1)
        np.add.at(edges, begins + sizes, -1)
    return np.cumsum(edges)[:n] == 0


def without_repeated_passages(docs: DataFrame, passage: int = PASSAGE, run: int = RUN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, the
    text that is left, n_words before and n_dropped.

    Words are compared without regard to ASCII case, white space between them does not
    count. A passage stays in one document, that of the smallest doc_id, a null one last;
    the other documents lose all its words. Each row counts as a document; of rows with
    one doc_id that of the smaller hash of its text comes first. What a document repeats
    within itself alone stays. A null text becomes ''. An empty table gives no rows.
    """
    rows, _, goes = repeated_passages(docs, passage, run)

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, gone = [], [], []
            for text, n, ranges in zip(*(batch.column(k).to_pylist() for k in ("text", "n", "goes")), strict=True):
                left = left_of(n, ranges)
                texts.append(without(text, ~left) if ranges else text or "")
                before.append(len(left))
                gone.append(len(left) - int(left.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                names=["doc_id", "text", "n_words", "n_dropped"],
            )

    both = rows.join(goes, "row", "left").select("doc_id", "text", "n", "goes")
    return both.mapInArrow(rebuilt, "doc_id bigint, text string, n_words bigint, n_dropped bigint")


def repeated_passages(docs: DataFrame, passage: int, run: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs`` in buckets (as ``in_buckets``), their order (row, place), and the
    ranges of words that ``without_repeated_passages`` drops (row, goes)."""
    rows = in_buckets(docs)
    passing = Passing(docs.sparkSession)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(marks_of(words_in(w), passage, run)) for w in batch.column("words").to_pylist()]
            numbers = np.repeat(batch.column("row").to_numpy(), [len(f) for f in found])
            marks = np.concatenate([*found, np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), _int64(marks)], names=["row", "mark"])

    marks = passing.staged(rows.select("row", "words").mapInArrow(marked, "row bigint, mark bigint"), "marks")
    shared = passing.staged(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark"), "shared")
    some = marks.join(shared, "mark").groupBy("row").agg(F.collect_list("mark").alias("marks"))
    order = places_of(rows)
    some = passing.staged(some.join(order, "row"), "shared_marks")

    def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "mark", "digest", "at", "n", "passages"]
        for batch in batches:
            for place, stored, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_in(stored)
                marks, passages = marks_of(words, passage, run), passages_of(words, passage)
                begins = np.concatenate([[0], np.flatnonzero(np.diff(marks)) + 1])
                ends = np.append(begins[1:], len(marks))
                within = np.isin(marks[begins], np.array(own, np.int64).view(np.uint64))
                begins, ends = begins[within], ends[within]
                digests = [xxhash.xxh3_64_intdigest(passages[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                at = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
                inside = np.concatenate([passages[a:b] for a, b in zip(begins, ends, strict=True)])
                found = [
                    pa.array([place] * len(begins), pa.int64()),
                    _int64(marks[begins]),
                    _int64(np.array(digests, np.uint64)),
                    pa.array(begins, pa.int32()),
                    pa.array(ends - begins, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(at), _int64(inside)),
                ]
                yield pa.RecordBatch.from_arrays(found, names=names)

    marked_rows = rows.join(some, "row").select("place", "words", "marks")
    columns = "place bigint, mark bigint, digest bigint, at int, n int, passages array<bigint>"
    windows = passing.staged(marked_rows.mapInArrow(windowed, columns), "windows")
    equal = windows.groupBy("mark", "digest").agg(F.min("place").alias("stays"), F.max("place").alias("last"))
    equal = passing.staged(equal, "equal_windows")
    # All but the first of equal windows go whole.
    again = equal.where("stays <> last").drop("last")
    whole = windows.drop("passages").join(again, ["mark", "digest"]).where("place <> stays")
    whole = whole.select("place", "at", (F.col("n") + passage - 1).alias("n"))
    # The first of each, where a mark has several different ones, are compared by passage.
    several = equal.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    firsts = equal.join(several, "mark", "left_semi").select("mark", "digest", F.col("stays").alias("place"))
    firsts = windows.join(firsts, ["mark", "digest", "place"], "left_semi")
    places = passing.staged(firsts.select("place", "mark", "at", F.posexplode("passages").alias("i", "passage")), "passages")
    first = places.groupBy("mark", "passage").agg(F.min("place").alias("stays"), F.max("place").alias("last"))
    first = passing.staged(first.where("stays <> last").drop("last"), "repeated")
    parts = places.join(first, ["mark", "passage"]).where("place <> stays")
    parts = parts.select("place", (F.col("at") + F.col("i")).alias("at"), F.lit(passage).alias("n"))
    goes = whole.unionByName(parts).groupBy("place").agg(F.collect_list(F.struct("at", "n")).alias("goes"))
    goes = staged(goes.join(order, "place").select("row", "goes"), "passages-to-drop")
    passing.drop()
    return rows, order, goes
