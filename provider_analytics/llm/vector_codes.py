"""Product codes of vectors: whole-number codebooks per part, nearest entries by GNAT.

Each vector becomes four one-byte indexes. Codebooks start from the first vectors by
vec_id and are refined in rounds; a round reads all vectors, finds each part's nearest entry
with a tree over the codebook (``gnat``), and adds up parts by entry, in the tasks first.
All numbers are whole, so results do not depend on how rows are dealt to tasks. The driver
holds the codebooks and one row of sums per entry, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .gnat import Gnat

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: A codebook per part: entries by position within the part, int64.
Codebooks = list[np.ndarray]


def _usable(name: str) -> Column:
    """Not null, and every component is a finite number. A vector without components is."""
    finite = F.forall(
        name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.col(name).isNotNull() & finite


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and ``whole``: the components times 1024, rounded down, as longs. Rows
    whose vector is null or holds null or non-finite components go.

    Vectors must all have the length of the first by vec_id, a multiple of four, and be
    small enough for the contract's sums of squares to be longs; others are an error."""
    usable = embeddings.where(_usable("embedding")).select("vec_id", "label", "embedding")
    return usable.select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("whole")
    )


def _first(vectors: DataFrame) -> np.ndarray:
    """The vectors with the smallest vec_ids (null last, ties by components), whole."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole")]
    rows = vectors.orderBy(*order).limit(ENTRIES).select("whole").collect()
    lengths = {len(row["whole"]) for row in rows} or {0}
    if len(lengths) > 1 or any(n % PARTS for n in lengths):
        raise ValueError(f"vectors must have one length, a multiple of {PARTS}: {sorted(lengths)}")
    return np.array([row["whole"] for row in rows], np.int64).reshape(len(rows), *lengths)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; checks what ``whole_vectors`` states."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"a vector has {lengths[lengths != width][0]} components, not {width}")
    found = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), width)
    limit = np.sqrt(2.0**62 / max(width, 1)) / 2
    if width and len(found) and max(float(found.max()), -float(found.min())) >= limit:
        raise ValueError(f"a component times {SCALE} is beyond {limit:.0f}: its distances are no longs")
    return found


def _assigned(trees: list[Gnat], vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index and squared distance of each part's nearest entry, part by part."""
    return [tree.nearest(part) for tree, part in zip(trees, np.split(vectors, PARTS, axis=1), strict=True)]


def _sums(vectors: DataFrame, codebooks: Codebooks) -> list:
    """Per part and entry that is some part's nearest: how many, and the sums by position.

    At most a row per part and entry leaves a task, and comes to the driver."""
    width = sum(book.shape[1] for book in codebooks)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in codebooks]
        n = np.zeros((PARTS, len(codebooks[0])), np.int64)
        sums = np.zeros((PARTS, *codebooks[0].shape), np.int64)
        for batch in batches:
            whole = _matrix(batch.column("whole"), width)
            parts = np.split(whole, PARTS, axis=1)
            for part, (index, _) in enumerate(_assigned(trees, whole)):
                n[part] += np.bincount(index, minlength=n.shape[1])
                np.add.at(sums[part], index, parts[part])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"part": part, "entry": entry, "n": n[part, entry], "sums": list(sums[part, entry])},
            schema=pa.schema(
                {"part": pa.int64(), "entry": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.int64())}
            ),
        )

    rows = vectors.select("whole").mapInArrow(added, "part bigint, entry bigint, n bigint, sums array<bigint>")
    by_place = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width // PARTS)]
    return rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *by_place).collect()


def fitted(vectors: DataFrame) -> Codebooks:
    """Codebooks of ``whole_vectors``: the parts of the first vectors by vec_id, refined in
    ``ROUNDS`` rounds. Fewer vectors make fewer entries, none make empty codebooks."""
    first = _first(vectors)
    codebooks = np.split(first, PARTS, axis=1)
    for _ in range(ROUNDS if len(first) else 0):
        moved = [book.copy() for book in codebooks]
        for row in _sums(vectors, codebooks):
            # Python's division rounds whole numbers down, also negative ones.
            moved[row["part"]][row["entry"]] = [int(s) // row["n"] for s in row[3:]]
        codebooks = moved
    return codebooks


def encoded(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id, label, code (hexadecimal indexes, part by part) and error, the squared
    distances to the entries, for every row of ``whole_vectors``."""
    width = sum(book.shape[1] for book in codebooks)
    ids = vectors.select("vec_id", "label")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in codebooks]
        for batch in batches:
            found = _assigned(trees, _matrix(batch.column("whole"), width))
            indexes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            codes = [row.tobytes().hex() for row in indexes]
            errors = sum(error for _, error in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    types = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ids.schema)
    return vectors.mapInArrow(coded, f"{types}, code string, error bigint")


def decoded(codes: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``codes`` with ``vector``: the entries that ``code`` names, one part after the other,
    as whole numbers (``SCALE`` times the components)."""
    parts = []
    for part, book in enumerate(codebooks):
        entries = F.from_json(F.lit(str(book.tolist())), "array<array<bigint>>")
        index = F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int")
        parts.append(F.get(entries, index))
    return codes.withColumn("vector", F.concat(*parts))


def numbers(codebooks: Codebooks) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(x) for book in codebooks for x in book.ravel().tolist())


def compressed(embeddings: DataFrame) -> tuple[DataFrame, Codebooks]:
    """The codes of all usable vectors, with ``label_error``: the error summed over rows of
    one label, null being one too; and the codebooks.

    ``embeddings`` has vec_id, embedding, label; other columns are ignored. Rows may share
    a vec_id: each gets its code. An empty table gives no rows."""
    vectors = whole_vectors(embeddings)
    codebooks = fitted(vectors)
    if not len(codebooks[0]):
        none = vectors.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none.withColumn("label_error", F.col("error")), codebooks
    codes = staged(encoded(vectors, codebooks), "codes")
    of_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(of_label, F.col("label").eqNullSafe(F.col("of"))).drop("of"), codebooks
