"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams; a text's n-grams are
ranked in the same way, and the language wins whose profile they are least out of
place in. N-grams have one to three characters of lower-cased words, with a blank at
each end of a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: N-grams of a profile; also the distance of an n-gram that a profile lacks.
PROFILE = 300
#: Profiles are fitted on the documents of each language that come first by a hash of
#: doc_id and text, so many, and more only where the last of them repeats.
TRAINING = 2000
#: Leading bits by which draws are counted: 4096 counts a language.
DRAW_BITS = 12
FOLDS = 5
BLANK = 32


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ranked_ngrams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams, as integers, and their counts, most frequent first. An n-gram
    holds 21 bits a character, so those of different lengths never coincide."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    points = np.concatenate([[BLANK], np.where(is_letter[points], points, BLANK), [BLANK]])
    points = points[np.append(True, (points[1:] != BLANK) | (points[:-1] != BLANK))]
    if len(points) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = points[:-1] << 21 | points[1:]
    three = two[:-1] << 21 | points[2:]
    grams, counts = np.unique(np.concatenate([points[points != BLANK], two, three]), return_counts=True)
    order = np.lexsort((grams, -counts))
    return grams[order], counts[order]


def held_out() -> F.Column:
    """Documents by the remainder of the CRC-32 of doc_id as text; a null id counts as ''."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return crc % FOLDS == 0


def _bounds(labelled: DataFrame, training: int) -> DataFrame:
    """lang and the largest of its first ``training`` draws. Draws are spread evenly, so
    a language's are counted by their leading bits; those up to the count that reaches
    ``training`` are few, and they are put in order. Of rows that repeat all or none stay."""
    counts = labelled.groupBy("lang", F.shiftright("drawn", 64 - DRAW_BITS).alias("lead")).count()
    upward = Window.partitionBy("lang").orderBy("lead")
    counts = counts.withColumn("below", F.sum("count").over(upward) - F.col("count"))
    last = counts.where(F.col("below") < training).groupBy("lang").agg(F.max("lead").alias("last"))
    early = labelled.select("lang", "drawn").join(F.broadcast(last), "lang")
    early = early.where(F.shiftright("drawn", 64 - DRAW_BITS) <= F.col("last"))
    early = early.groupBy("lang", "drawn").agg(F.count(F.lit(1)).alias("n"))
    place = F.sum("n").over(Window.partitionBy("lang").orderBy("drawn")) - F.col("n")
    return early.withColumn("place", place).where(F.col("place") < training).groupBy("lang").agg(
        F.max("drawn").alias("bound")
    )


def profiles(docs: DataFrame, size: int = PROFILE, training: int = TRAINING) -> DataFrame:
    """lang, gram, rank (0 first) of the languages learned from documents with text and
    lang that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    labelled = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("drawn"))
    # The texts stay where they are. Languages are few: their profiles go to every task too.
    bounds = _bounds(staged(labelled.select("lang", "drawn"), "draws"), training)
    sample = labelled.join(F.broadcast(bounds), "lang").where("drawn <= bound").select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                grams, counts = ranked_ngrams(text.as_py(), is_letter)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )

    counts = sample.mapInArrow(counted, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank - 1).where(F.col("rank") < size).drop("n")


def predicted(docs: DataFrame, size: int = PROFILE, training: int = TRAINING) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang; other columns are ignored): doc_id,
    held_out, lang_pred, score.

    ``und`` with score 0 for a text that is null, empty or without a letter, and for all
    texts if nothing was learned. The score is 1 for a text whose ranks are the
    profile's, 0 if it shares no n-gram with it; ties go to the language first by name.
    Rows that repeat get equal results; an empty table gives none.

    The profiles, ``size`` rows a language, come to the driver.
    """
    learned = profiles(docs, size, training).toPandas()
    langs = sorted(learned["lang"].unique())
    grams = np.unique(learned["gram"].to_numpy(np.int64))
    ranks = np.full((len(grams), len(langs)), -1, np.int64)
    columns = pd.Series(range(len(langs)), langs, dtype="int64")
    ranks[np.searchsorted(grams, learned["gram"]), columns.reindex(learned["lang"])] = learned["rank"]

    is_letter = letters()

    def nearest(text: str | None) -> tuple[str, float]:
        own = ranked_ngrams(text, is_letter)[0][:size] if text and langs else ()
        if not len(own):
            return "und", 0.0
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        theirs = np.where((grams[at] == own)[:, None], ranks[at], -1)
        apart = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own))[:, None]))
        total = apart.sum(axis=0)
        best = int(total.argmin())
        return langs[best], 1 - int(total[best]) / (size * len(own))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(text.as_py()) for text in batch.column("text")]
            arrays = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *arrays],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return texts.mapInArrow(judged, "doc_id bigint, held_out boolean, lang_pred string, score double")
