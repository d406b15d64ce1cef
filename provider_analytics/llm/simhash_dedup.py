"""SimHash near-duplicates through sharded BK-trees.

A fingerprint has 64 bits, cut into bands. Two fingerprints that differ in at most
``distance`` bits agree in all bands but ``distance``, so with ``distance + 2`` bands
they agree in two at least. Every choice of so many bands and their values names a
shard, and a linked pair meets in a shard of each choice on which it agrees. Each
shard holds a BK-tree: a node's children are keyed by their Hamming distance to it, and
a search follows only the edges within the radius of its own distance. No fixed set
of trees over all documents has a bounded size, so trees are not broadcast to the
documents; a shard's searches go where its tree is.

Only distinct fingerprints are searched, and a shard returns one link per member to
its component's smallest member, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, staged, utf8
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Members of a hot shard whose tree one task builds and holds. The members of a larger
#: shard are dealt to several trees, and each tree is searched by all of them.
TREE = 1 << 15
#: Shingles whose bits are counted at once.
COUNTED = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of the text's word shingles, as an unsigned integer."""
    words = utf8(text or "").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, row: str | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``row`` if given, doc_id and the fingerprint as a signed bigint."""
    kept = [row] if row else []

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            columns = [*kept, "doc_id"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(found.view(np.int64))], names=[*columns, "fp"]
            )

    texts = docs.select(*[F.col(c).cast("bigint") for c in (*kept, "doc_id")], "text")
    return texts.mapInArrow(hashed, "".join(f"{c} bigint, " for c in kept) + "doc_id bigint, fp bigint")


class BKTree:
    """A BK-tree over distinct fingerprints, built and searched many at a time."""

    def __init__(self, members: np.ndarray):
        self.members = members
        #: node -> [(distance, child node)]
        self.children: list[list[tuple[int, int]]] = [[] for _ in members]
        below = [np.arange(len(members))]
        while below:
            group = below.pop()
            node, rest = group[0], group[1:]
            apart = np.bitwise_count(members[rest] ^ members[node])
            for distance in np.unique(apart):
                child = rest[apart == distance]
                self.children[node].append((int(distance), int(child[0])))
                below.append(child)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions in ``queries`` within the radius of it), for all nodes met."""
        if not len(self.members):
            return
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, active = todo.pop()
            apart = np.bitwise_count(queries[active] ^ self.members[node]).astype(np.int16)
            yield node, active[apart <= radius]
            for distance, child in self.children[node]:
                near = active[np.abs(apart - distance) <= radius]
                if len(near):
                    todo.append((child, near))


def _roots(members: np.ndarray, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each query and member with the smallest fingerprint of its component.
    Labels of found components are merged at once, so that no list of pairs is kept."""
    every = np.union1d(members, queries)
    label = np.arange(len(every))
    tree = BKTree(members)
    own, asked = np.searchsorted(every, members), np.searchsorted(every, queries)
    for node, near in tree.search(queries, distance):
        met = label[np.append(asked[near], own[node])]
        if (met != met[0]).any():
            met = np.unique(met)
            label[np.isin(label, met)] = met[0]
    linked = np.flatnonzero(label != np.arange(len(every)))
    return every[linked], every[label[linked]]


def _masks(distance: int) -> list[int]:
    """For each pair of bands the bits it covers."""
    n = distance + 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [
        sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in pair) for pair in combinations(range(n), 2)
    ]


def _links(distinct: DataFrame, distance: int, tree: int) -> DataFrame:
    """a, b: links between distinct fingerprints (``fp``) that connect, through others
    if need be, all that differ in at most ``distance`` bits."""
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint") for m in _masks(distance)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("choice", "mask"))
    keyed = keyed.select(
        "fp", F.xxhash64("choice", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard")
    )
    sizes = staged(
        keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shards"
    )
    trees = F.ceil(F.col("n") / F.lit(tree)).cast("int")
    members = staged(keyed.join(sizes, "shard").select("fp", "shard", trees.alias("trees")), "members")

    # Members of one tree search it; with several trees, all members search each.
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("trees")).cast("int")
    dealt = members.select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"), "fp", own.alias("own")
    ).select("shard", "tree", (F.col("own") == F.col("tree")).alias("member"), "fp")
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(partitions, "shard", "tree").sortWithinPartitions("shard", "tree")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(fp: np.ndarray, member: np.ndarray) -> pa.RecordBatch:
            a, b = _roots(fp[member], fp, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        fp, member, key = np.empty(0, np.uint64), np.empty(0, bool), np.empty((0, 2), np.int64)
        for batch in batches:
            fp = np.append(fp, batch.column("fp").to_numpy().view(np.uint64))
            member = np.append(member, batch.column("member").to_numpy(zero_copy_only=False))
            here = [batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "tree")]
            key = np.concatenate([key, np.stack(here, axis=1)])
            edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], edges])
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                yield found(fp[start:end], member[start:end])
            last = starts[-1]
            fp, member, key = fp[last:], member[last:], key[last:]
        if len(fp):
            yield found(fp, member)

    return sorted_.mapInArrow(searched, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    row: str | None = None,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    tree: int = TREE,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): ``row`` if
    given, doc_id, fingerprint (16 hex digits), component_id, and component_fingerprint,
    the smallest of the component's fingerprints as signed numbers.

    Fingerprints that differ in at most ``distance`` bits are linked, and component_id is
    the smallest doc_id of all documents reachable, null only if none has one. Texts
    without words, null among them, have fingerprint zero and are linked like others.
    Rows that repeat share everything. An empty table gives no rows.
    """
    base = staged(fingerprints(docs, row, shingle), "fingerprints")
    distinct = staged(base.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = staged(components(_links(distinct.select("fp"), distance, tree)), "components")
    found = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    found = staged(found.withColumn("root", F.coalesce("root", "fp")), "found")
    first = staged(found.groupBy("root").agg(F.min("first").alias("component_id")), "firsts")
    by_fp = staged(found.join(first, "root").select("fp", "root", "component_id"), "by-fingerprint")

    def digits(name: str):
        return F.lower(F.lpad(F.hex(name), 16, "0"))

    return base.join(by_fp, "fp").select(
        *([row] if row else []),
        "doc_id",
        digits("fp").alias("fingerprint"),
        "component_id",
        digits("root").alias("component_fingerprint"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row
    with the smallest doc_id, and of rows that repeat it the first written."""
    rows, row = numbered(docs)
    found = near_duplicates(rows, row)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("best")
    kept = found.groupBy("component_fingerprint").agg(best).select(F.col(f"best.{row}").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)
