"""Vector codes against every distance, and the tree against a plain search."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from provider_analytics.llm import vector_codes
from provider_analytics.llm.gnat import Gnat

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, whole string, error int"


def expected(rows):
    """vec_id, code, error, label_error by whole numbers and every entry; and the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, label, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // 4
    cut = [[r[2][p * width : (p + 1) * width] for p in range(4)] for r in kept]
    books = [[c[p] for c in cut[:256]] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(4):
        moved = []
        for p in range(4):
            members = defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            moved.append(
                [
                    [sum(xs) // len(xs) for xs in zip(*members[n], strict=True)] if n in members else entry
                    for n, entry in enumerate(books[p])
                ]
            )
        books = moved
    codes = [[nearest(c[p], books[p]) for p in range(4)] for c in cut]
    errors = [sum(d for d, _ in code) for code in codes]
    of_label = Counter()
    for (_, label, _), error in zip(kept, errors, strict=True):
        of_label[label] += error
    found = [
        (i, "".join(f"{n:02x}" for _, n in code), error, of_label[label])
        for (i, label, _), code, error in zip(kept, codes, errors, strict=True)
    ]
    return Counter(found), ",".join(str(x) for book in books for entry in book for x in entry)


def vectors(n, spread, width=8, seed=4):
    draw = random.Random(seed)
    rows = [
        (i, [draw.randrange(-spread, spread + 1) / 1024 for _ in range(width)], draw.choice([1, 2, None]))
        for i in range(n)
    ]
    rows += [rows[3], rows[3], (None, rows[5][1], 7), (None, rows[6][1], 7), (5, rows[9][1], None)]
    odd = [None, [None] * width, [float("nan")] * width, [1.0] * (width - 1) + [float("-inf")]]
    return rows + [(1000 + i, v, 1) for i, v in enumerate(odd)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA).repartition(5)


# A small spread makes many ties; few vectors make fewer entries than 256.
@pytest.mark.parametrize("n, spread", [(700, 2), (600, 400), (40, 50)])
def test_equals_every_distance(spark, n, spread):
    rows = vectors(n, spread)
    codes, books = vector_codes.compressed(table(spark, rows))
    found = Counter(tuple(r) for r in codes.select("vec_id", "code", "error", "label_error").collect())
    of, entries = expected(rows)
    assert found == of
    assert vector_codes.numbers(books) == entries


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    rows = [r for r in vectors(400, 300)[:400]]
    embeddings = table(spark, rows)
    codes, books = vector_codes.compressed(embeddings)
    whole = {r.vec_id: r.whole for r in vector_codes.whole_vectors(embeddings).collect()}
    for row in vector_codes.decoded(codes, books).collect():
        assert sum((a - b) ** 2 for a, b in zip(row.vector, whole[row.vec_id], strict=True)) == row.error


def test_tables_without_usable_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 4, None)]):
        codes, books = vector_codes.compressed(table(spark, rows) if rows else spark.createDataFrame([], SCHEMA))
        assert codes.columns == ["vec_id", "label", "code", "error", "label_error"]
        assert codes.count() == 0 and vector_codes.numbers(books) == ""


def test_vectors_without_components(spark):
    codes, books = vector_codes.compressed(table(spark, [(1, [], 1), (2, [], 1)]))
    assert {(r.code, r.error) for r in codes.collect()} == {("00000000", 0)}


@pytest.mark.parametrize(
    "vector, message", [([1.0] * 9, "length"), ([1.0] * 8 + [2.0] * 4, "length"), ([1e30] * 8, "no longs")]
)
def test_vectors_that_do_not_fit_are_an_error(spark, vector, message):
    with pytest.raises(Exception, match=message):
        vector_codes.compressed(table(spark, [(1, [0.5] * 8, 1), (2, vector, 1)]))


@pytest.mark.parametrize(
    "width, span, n", [(16, 500, 256), (2, 3, 256), (3, 40, 200), (1, 5, 30), (4, 2**29, 256), (2, 10**6, 256)]
)
def test_tree_finds_the_nearest_and_the_lowest_of_ties(width, span, n):
    draw = np.random.default_rng(width)
    entries = draw.integers(-span, span + 1, (n, width))
    queries = np.append(draw.integers(-span, span + 1, (500, width)), entries, axis=0)
    tree = Gnat(entries)
    index, distance = tree.nearest(queries)
    apart = ((queries[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert distance.tolist() == apart.min(1).tolist()
    assert index.tolist() == [int(np.flatnonzero(row == row.min())[0]) for row in apart]
    if width <= 4 and n > 100:
        assert tree.compared < 0.5 * apart.size  # subtrees are passed over
