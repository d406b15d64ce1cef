"""Line de-duplication through a sharded minimal perfect hash.

Distinct line keys are known by 128-bit hashes. They are dealt to shards of bounded
size; each shard gets a minimal perfect hash, which maps its keys to 0..n-1, and beside
it plain arrays of fingerprints, document counts and last documents. A document's lines
go to the shards by hash and look their numbers up there: no line text is joined or
shuffled. A shard that is asked often, as one that holds a line of every third document,
is read by as many tasks as its rows need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, staged, utf8

MIN_POINTS = 20
MIN_DOCUMENTS = 3
#: Keys of a shard, and probing rows of a task, on average at most.
SHARD_KEYS = 1 << 15
TASK_ROWS = 1 << 16


def line_hash(line: str) -> bytes | None:
    """The 128-bit hash of a line's key, None for a key too short to count."""
    key = line.strip(SPACES)
    return xxhash.xxh3_128_digest(utf8(key).lower()) if len(key) >= MIN_POINTS else None


# The minimal perfect hash: bit arrays, level by level. A key is settled on the first
# level where no other key takes its bit; its number is the count of bits set before.


def _place(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = low ^ (high + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def build_hash(low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Levels of bits (as booleans) that together give each distinct key a number."""
    levels = []
    while len(low):
        size = 2 * len(low) + 1
        place = _place(low, high, len(levels), size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        again = ~alone[place]
        low, high = low[again], high[again]
    return levels


def look_up(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The number of each key; -1 for some keys that were not among those built from."""
    number = np.full(len(low), -1, np.int64)
    before = 0
    for k, bits in enumerate(levels):
        open_ = np.flatnonzero(number < 0)
        place = _place(low[open_], high[open_], k, len(bits))
        rank = np.cumsum(bits) - 1 + before
        number[open_] = np.where(bits[place], rank[place], -1)
        before += int(bits.sum())
    return number


def _packed(levels: list[np.ndarray]) -> tuple[list[int], bytes]:
    return [len(x) for x in levels], b"".join(np.packbits(x).tobytes() for x in levels)


def _unpacked(sizes: list[int], bits: bytes) -> list[np.ndarray]:
    levels, at = [], 0
    for size in sizes:
        n = (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, n, at), count=size).astype(bool))
        at += n
    return levels


def _keys_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id and the hash, in two halves, of each different key of each row."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {line_hash(line) for line in (text or "").split("\n")} - {None}
                ids.extend([doc_id] * len(own))
                digests.extend(own)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["doc_id", "low", "high"],
            )

    return docs.mapInArrow(split, "doc_id bigint, low bigint, high bigint")


def _build_shard(keys: pd.DataFrame) -> pd.DataFrame:
    low, high = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("low", "high"))
    levels = build_hash(low, high)
    at = look_up(levels, low, high)
    marks = np.empty(len(at), np.uint32)
    counts = np.empty(len(at), np.uint8)
    last = np.empty(len(at), np.int64)
    named = np.empty(len(at), bool)
    marks[at] = high.astype(np.uint32)
    counts[at] = np.minimum(keys["documents"], 255)
    last[at] = keys["last"].fillna(0).to_numpy(np.int64)
    named[at] = keys["last"].notna()
    sizes, bits = _packed(levels)
    parts = max(1, -(-int(keys["documents"].sum()) // TASK_ROWS))
    row = (keys["shard"].iloc[0], parts, sizes, bits, marks.tobytes(), counts.tobytes(), last.tobytes(), named.tobytes())
    return pd.DataFrame([row], columns=["shard", "parts", "sizes", "bits", "marks", "counts", "last", "named"])


def _probe(rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """The rows whose line goes."""
    if rows.empty:
        return rows[["doc_id", "low", "high"]]
    index = shard.iloc[0]
    low, high = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("low", "high"))
    at = look_up(_unpacked(list(index["sizes"]), index["bits"]), low, high)
    if (at < 0).any() or (np.frombuffer(index["marks"], np.uint32)[at] != high.astype(np.uint32)).any():
        raise ValueError("a line of the documents is not in the index")
    last = np.frombuffer(index["last"], np.int64)[at]
    named = np.frombuffer(index["named"], bool)[at]
    own = rows["doc_id"]
    is_last = np.where(named, own.notna() & (own.fillna(0).to_numpy(np.int64) == last), own.isna())
    goes = (np.frombuffer(index["counts"], np.uint8)[at] >= MIN_DOCUMENTS) & ~is_last
    return rows.loc[goes, ["doc_id", "low", "high"]]


def lines_to_drop(docs: DataFrame) -> DataFrame:
    """doc_id and ``hashes``, the 16-byte hashes of the lines that go, for the documents
    that lose any. Each row of ``docs`` counts as a document; what goes depends on the
    line and the doc_id alone, so rows that share a doc_id agree. A null doc_id is the
    smallest."""
    keys = staged(_keys_of_documents(docs), "line-keys")
    distinct = staged(
        keys.groupBy("low", "high").agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("last")),
        "lines",
    )
    shards = max(1, -(-distinct.count() // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("low", "high"), F.lit(shards)).alias("shard")
    index = staged(
        distinct.select("*", shard)
        .groupBy("shard")
        .applyInPandas(
            _build_shard,
            "shard bigint, parts bigint, sizes array<bigint>, bits binary, marks binary,"
            " counts binary, last binary, named binary",
        ),
        "line-index",
    )
    # A row's part follows from its document, so one line's rows go to all parts of its shard.
    spread = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("parts")).alias("part")
    sizes = staged(index.select("shard", "parts"), "line-shards")
    rows = keys.select("*", shard).join(sizes, "shard")
    rows = rows.select("doc_id", "low", "high", "shard", spread)
    parts = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    gone = (
        rows.groupBy("shard", "part")
        .cogroup(parts.drop("parts").groupBy("shard", "part"))
        .applyInPandas(_probe, "doc_id bigint, low bigint, high bigint")
    )
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("low", "high")).alias("hashes"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, the
    text that is left, n_lines before and n_dropped.

    A null or empty text is one empty line and stays so, as ''. Lines of fewer than
    ``MIN_POINTS`` code points stay. A line that a document repeats counts once and goes
    or stays in all its places. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    gone = staged(lines_to_drop(docs), "lines-to-drop").withColumnRenamed("doc_id", "of")
    both = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("of")), "left").drop("of")
    names = ["doc_id", "text", "n_lines", "n_dropped"]

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, dropped = [], [], []
            for text, hashes in zip(batch.column("text").to_pylist(), batch.column("hashes").to_pylist(), strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if hashes:
                    gone = {np.array([h["low"], h["high"]], np.int64).tobytes() for h in hashes}
                    kept = [line for line in lines if line_hash(line) not in gone]
                texts.append("\n".join(kept))
                before.append(len(lines))
                dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                names=names,
            )

    return both.mapInArrow(rebuilt, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")

