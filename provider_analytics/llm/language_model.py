"""Language-model scores of whole documents by a small gated recurrent network.

The network predicts the words that the training documents hold often enough to learn
them, the document's end and one mark for all other words; such a word then has its share, by smoothed counts, of what the mark gets,
so that every text has a probability. All words of all training documents are counted,
and all of them train: each task trains a copy of the network on its documents, and the
copies are averaged by the words they saw, in two steps so that no task meets all of
them. Counts stay distributed: only the most frequent words come to the driver and go to
the tasks, and a document's other words look theirs up in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gated_network as network
from .common import frequent, staged, utf8

#: The network predicts every word that makes up such a share of the training tokens, which
#: are 50,000 at most, and the most frequent ones up to ``VOCABULARY``, end and mark included.
SHARE = 2e-5
VOCABULARY = 512
#: Words whose counts go to every task at most, and the longest of them in bytes.
KNOWN = 1 << 17
KNOWN_BYTES = 64
END, OTHER = 0, 1
FOLDS, HELD_OUT = 7, 2
#: Words counted in a task before they are passed on.
COUNTED = 1 << 18
#: Words of the documents that are trained or scored side by side. Fewer leave most lanes
#: empty beside the longest documents.
BATCH = 1 << 22
#: Trained copies averaged by a task, and parameters of a piece.
COPIES = 256
PIECE = 4096


def held_out() -> F.Column:
    """By the remainder of the CRC-32 of doc_id as text; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def words_of(text: str | None) -> list[bytes]:
    return utf8(text or "").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word and its count ``n`` in all ``docs``; each task adds up what it can hold."""

    def flushed(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
                if len(counts) > COUNTED:
                    yield flushed(counts)
                    counts = Counter()
        yield flushed(counts)

    return docs.select("text").mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Numbers:
    """Words by number: END, OTHER, the network's words, then others that are known."""

    def __init__(self, words: list[str], counts: list[int], vocabulary: int):
        self.first = 2
        self.vocabulary = min(vocabulary, len(words) + self.first)
        self.number = {utf8(word): i for i, word in enumerate(words, self.first)}
        self.predicted = {utf8(word): i for i, word in enumerate(words[: self.vocabulary - 2], self.first)}
        self.counts = np.array([0, 0, *counts], np.float64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, -1 for words not known."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def targets_of(self, words: list[bytes]) -> np.ndarray:
        """``targets(of(words))``, from a small table."""
        return np.fromiter(chain(map(self.predicted.get, words, repeat(OTHER)), (END,)), np.int32, len(words) + 1)

    def targets(self, numbers: np.ndarray) -> np.ndarray:
        """What the network predicts for them, and then the end."""
        predicted = (numbers >= 0) & (numbers < self.vocabulary)
        return np.append(np.where(predicted, numbers, OTHER), END).astype(np.int32)


def trained(docs: DataFrame, numbers: Numbers, start: np.ndarray) -> np.ndarray:
    """The parameters after every task has trained a copy of ``start`` on its documents,
    averaged by words."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = network.Trainer(start, numbers.vocabulary)
        documents, total = [], 0
        for batch in batches:
            for text in batch.column("text"):
                documents.append(numbers.targets_of(words_of(text.as_py())))
                total += len(documents[-1])
                if total > BATCH:
                    trainer.learn(documents, END)
                    documents, total = [], 0
        if documents:
            trainer.learn(documents, END)
        if not trainer.words:
            return
        pieces = list(network.chunks(trainer.flat.astype(np.float64) * trainer.words, PIECE))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in pieces], pa.int64()),
                pa.array([p.tobytes() for _, p in pieces], pa.binary()),
                pa.array([trainer.words] * len(pieces), pa.int64()),
            ],
            names=["piece", "total", "words"],
        )

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(t) for t in rows["total"]], axis=0)
        return pd.DataFrame([(rows["piece"].iloc[0], total.tobytes(), rows["words"].sum())], columns=["piece", "total", "words"])

    schema = "piece bigint, total binary, words bigint"
    copies = docs.select("text").mapInArrow(train, schema)
    group = F.floor(F.spark_partition_id() / F.lit(COPIES)).alias("group")
    some = copies.select("*", group).groupBy("group", "piece").applyInPandas(lambda rows: added(rows.drop(columns="group")), schema)
    rows = some.groupBy("piece").applyInPandas(added, schema).toPandas().sort_values("piece")
    if rows.empty:
        return start
    parts = [np.frombuffer(t) / w for t, w in zip(rows["total"], rows["words"], strict=True)]
    return np.concatenate(parts).astype(np.float32)


def vocabulary_of(counts: DataFrame, tokens: int) -> int:
    """How many words the network predicts, the end and the mark included."""
    return max(VOCABULARY, counts.where(F.col("n") >= SHARE * tokens).count() + 2)


def scored(docs: DataFrame, vocabulary: int | None = None, known: int = KNOWN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score. ``vocabulary`` follows
    the counts if it is not given (``SHARE``).

    A null or empty text is scored by its end alone. Rows that repeat count as often as
    they come and get equal scores. Without training documents all counts are zero and
    the network keeps its first weights. An empty table gives no rows.
    """
    number = F.monotonically_increasing_id().alias("row")
    texts = docs.select(number, F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    training = texts.where(~F.col("held_out"))
    counts = staged(word_counts(training), "word-counts")
    distinct, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    ends = training.count()
    train_tokens = (total or 0) + ends
    train_distinct = distinct + bool(ends)

    short = counts.where(F.octet_length("word") <= KNOWN_BYTES)
    most = frequent(short, known)
    if vocabulary is None:
        vocabulary = vocabulary_of(short, train_tokens)
        most = most.union(short.where(F.col("n") >= SHARE * train_tokens)).distinct()
    most = most.toPandas().sort_values(["n", "word"], ascending=[False, True])
    numbers = Numbers(most["word"].tolist(), most["n"].tolist(), vocabulary)
    numbers.counts[END] = ends
    in_network = numbers.counts[: numbers.vocabulary].copy()
    in_network[OTHER] = others = train_tokens - in_network.sum()
    parameters = trained(training, numbers, network.initial(in_network))

    # log10 of what a count of c gives: (c + 1) of these.
    base_unit = -np.log10(train_tokens + train_distinct + 1)
    other_unit = -np.log10(others + max(0, train_distinct - (numbers.vocabulary - 1)) + 1)
    log_counts = np.log10(numbers.counts + 1)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]

    def counted(text: str | None) -> tuple[np.ndarray, tuple]:
        """A text's targets and its row, but for what the network adds to the score; words
        that are not known are joined, as they are many and small."""
        words = words_of(text)
        n = numbers.of(words)
        target = numbers.targets(n)
        known_words = n[n >= 0]
        logs = log_counts[known_words]
        base = logs.sum() + log_counts[END] + len(target) * base_unit
        of_others = logs[known_words >= numbers.vocabulary].sum() + (target == OTHER).sum() * other_unit
        rest = b" ".join([words[i] for i in np.flatnonzero(n < 0)])
        return target, (len(target), len(known_words) + (ends > 0), base, of_others, rest or None)

    def finished(own: pa.RecordBatch, targets: list[np.ndarray], found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)]
        model = network.log_likelihoods(parameters, numbers.vocabulary, targets, END) / np.log(10)
        columns[-2] = pc.add(columns[-2], pa.array(model))
        columns[-1] = pc.split_pattern(columns[-1].cast(pa.string()), " ")
        return pa.RecordBatch.from_arrays([*(own.column(c) for c in names[:3]), *columns], names=names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets, found, total, done = [], [], 0, 0
            for i, text in enumerate(batch.column("text"), 1):
                target, row = counted(text.as_py())
                targets.append(target)
                found.append(row)
                total += len(target)
                if total > BATCH or i == len(batch):
                    yield finished(batch.slice(done, i - done), targets, found)
                    targets, found, total, done = [], [], 0, i

    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint,"
        " base_score double, score double, rest array<string>"
    )
    partly = staged(texts.mapInArrow(score, schema), "scores")
    rest = partly.select("row", F.explode("rest").alias("word"))
    looked_up = rest.join(counts, "word").groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more")
    )
    more = F.coalesce("more", F.lit(0.0))
    return partly.drop("rest").join(looked_up, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
