"""Quality weights of documents by importance resampling over hashed n-grams.

A document's features are its words and pairs of neighbouring words, lower-cased and
hashed to ``BUCKETS`` buckets. Two bags of features are counted: one over the training
documents that are labelled as good, the target, and one over all training documents.
A document's importance weight is the ratio of what the two bags give its features. As
many documents as the labels' share of good ones are then drawn without replacement in
proportion to their weights, by the largest sums of logarithmic weight and Gumbel noise.
All documents of the training folds are counted, none is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .passage_dedup import WordHashes

BUCKETS = 10_000
FOLDS = 5
#: What is added to each bucket's count.
SMOOTHING = 1.0


def held_out() -> F.Column:
    """By the remainder of the CRC-32 of doc_id as text; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def features(hashes: WordHashes, text: str | None) -> np.ndarray:
    """The bucket of each word and of each pair of neighbouring words."""
    words = hashes.of(text)
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[1:]) * np.uint64(0xD6E8FEB86659FD93)
    mixed = np.concatenate([words, pairs ^ (pairs >> np.uint64(32))])
    return (mixed % np.uint64(BUCKETS)).astype(np.int64)


def _bags(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over the ``good`` rows of ``docs`` (text, good), and over all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bags = WordHashes(), np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, good in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist(), strict=True):
                own = np.bincount(features(hashes, text), minlength=BUCKETS)
                bags[1] += own
                if good:
                    bags[0] += own
        arrays = [pa.array(np.arange(BUCKETS)), pa.array(bags[0]), pa.array(bags[1])]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "target", "raw"])

    parts = docs.mapInArrow(counted, "bucket bigint, target bigint, raw bigint")
    sums = parts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()
    bags = np.zeros((2, BUCKETS))
    bags[:, sums["bucket"]] = sums[["target", "raw"]].to_numpy().T
    return bags[0], bags[1]


def weighted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id,
    held_out, n_features, log_weight, score, kept. ``labels``: doc_id, quality.

    ``log_weight`` is the natural logarithm of the importance weight, ``score`` its mean
    by feature; both are 0 for a null or empty text, and for all texts if no training
    document is labelled as good. A document with contradicting labels is not good. The
    noise comes from a hash of doc_id, so reruns agree; rows that repeat get equal
    weights, and one of them may be drawn without the other. An empty table gives none.
    """
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    judged = judged.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.min("quality") == 1).alias("good"))
    texts = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    judged = staged(judged.where(~held_out()), "labels")
    n_judged, n_good = judged.agg(F.count(F.lit(1)), F.count_if("good")).first()
    # Labels grow with the documents, so they are not broadcast, however few there are.
    training = texts.where("NOT held_out").join(judged.hint("merge"), "doc_id", "left").select("text", "good")
    target, raw = _bags(training)
    shares = [(bag + SMOOTHING) / (bag.sum() + SMOOTHING * BUCKETS) for bag in (target, raw)]
    log_ratio = np.log(shares[0] / shares[1]) if target.sum() else np.zeros(BUCKETS)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            own = [features(hashes, text) for text in batch.column("text").to_pylist()]
            n = np.array([len(f) for f in own], np.int64)
            weight = np.array([log_ratio[f].sum() for f in own], np.float64)
            arrays = [pa.array(n), pa.array(weight), pa.array(weight / np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *arrays],
                names=["doc_id", "held_out", "n_features", "log_weight", "score"],
            )

    schema = "doc_id bigint, held_out boolean, n_features bigint, log_weight double, score double"
    # 52 bits of a hash, as a number between 0 and 1 without either.
    even = (F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("gumbel")), 12) + 0.5) / float(1 << 52)
    rows = staged(texts.mapInArrow(scored, schema).withColumn("drawn", F.col("log_weight") - F.log(-F.log(even))), "weights")

    # The place of each row among all: places within a range, and the rows of ranges before.
    ranges = rows.repartitionByRange(F.desc("drawn"), "doc_id").withColumn("part", F.spark_partition_id())
    ranges = staged(ranges, "drawn")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("drawn"), "doc_id")) + F.col("offset")
    share = n_good / n_judged if n_judged else 1.0
    most = round(share * rows.count())
    return ranges.join(F.broadcast(sizes), "part").select(
        "doc_id", "held_out", "n_features", "log_weight", "score", (place <= most).alias("kept")
    )
