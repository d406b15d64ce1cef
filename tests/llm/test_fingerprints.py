"""Fingerprints against plain Python, and the likeness against the shingles themselves."""

import math
import random
import struct
from collections import Counter

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from provider_analytics.llm import fingerprints
from provider_analytics.llm.fingerprints import BINS, BITS, MARKER, REST


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def chained(form, *numbers):
    seed = 42
    for number in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack(form, number), seed)
    return signed(seed)


def shingles(text):
    """Hash of each five words, or of all words of a shorter text."""
    hashes = [signed(xxhash.xxh64_intdigest(word, 42)) for word in brute.words(text)]
    return {chained("<q", *hashes[i : i + 5]) for i in range(max(len(hashes) - 4, min(len(hashes), 1)))}


def fingerprint(text):
    bins = {}
    for value in shingles(text):
        at = (value >> REST) + BINS // 2
        bins[at] = min(bins.get(at, MARKER), value & MARKER)
    if not bins:
        return "0" * (BINS * BITS // 4)
    found = []
    for at in range(BINS):
        probes = [at] + [chained("<i", at, p) % BINS for p in range(fingerprints.PROBES)]
        probes.append(min(bins, key=lambda j: (chained("<i", at, j, -1), j)))
        found.append(bins[next(p for p in probes if p in bins)] % (1 << BITS))
    return "".join(f"{low:x}" for low in found)


def near(one, other):
    empty = set("0")
    if set(one) == empty or set(other) == empty:
        return float(one == other)
    same = sum(a == b for a, b in zip(one, other, strict=True)) / len(one)
    return max((same - 1 / 16) / (15 / 16), 0.0)


def expected(rows):
    def order(row):
        doc_id, text = row[0], row[1] or ""
        key = -(1 << 63) if doc_id is None else doc_id
        return -key, xxhash.xxh64_intdigest(text.encode(), 42) >> 1

    rows = sorted(rows, key=order)
    prints = [fingerprint(text) for _, text in rows]
    found = []
    for i, (doc_id, text) in enumerate(rows):
        text, j = text or "", (i + 1) % len(rows)
        half = len(text) // 2
        changed = text[: len(text) - half] + (rows[j][1] or "")[:half]
        after = fingerprint(changed)
        found.append(
            (doc_id, len(text), brute.sha(changed), prints[i], after, near(prints[i], after), near(prints[i], prints[j]))
        )
    return found


def result(docs, **options):
    both = fingerprints.edited(docs, **options).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256),
        fingerprints.as_text("fingerprint"),
        fingerprints.as_text("edited_fingerprint"),
        F.round("near_edited", 9),
        F.round("near_next", 9),
    )
    return Counter(tuple(row) for row in both.collect())


def rounded(rows):
    return Counter((*row[:5], round(row[5], 9), round(row[6], 9)) for row in rows)


# 200 ranges are more than there are rows: some are empty, and repeated ids fill several.
@pytest.mark.parametrize("parts", [1, 5, 200])
def test_equals_plain_python(odd, pairs, parts):
    assert result(odd, parts=parts) == rounded(expected(pairs))


def test_one_id_in_many_ranges(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 4, 4, 4, 9]), f"text {i} of {draw.random()}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(docs, parts=8) == rounded(expected(rows))


def test_no_rows_and_one(spark, empty):
    assert fingerprints.edited(empty).count() == 0
    one = spark.createDataFrame([(1, "äbcde fg")], "doc_id bigint, text string")
    [row] = fingerprints.edited(one).collect()
    assert (row.n_chars, row.edited, row.near_next) == (8, "äbcdäbcd", 1.0)


def test_a_long_text(spark):
    text = " ".join(str(i * i) for i in range(300_000))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id bigint, text string")
    rows = {row.doc_id: row for row in fingerprints.edited(docs).collect()}
    assert rows[1].edited == text[: len(text) - len(text) // 2] + "short"
    assert rows[2].edited == "sho" + text[:2]


def test_likeness_is_close_to_the_share_of_common_shingles(spark):
    draw = random.Random(1)
    rows, true = [], {}
    for i in range(300):
        words = [str(draw.randrange(10**6)) for _ in range(draw.randrange(60, 900))]
        other = list(words)
        for _ in range(draw.randrange(0, 60)):
            other[draw.randrange(len(other))] = "x"
        one, two = " ".join(words), " ".join(other)
        a, b = shingles(one), shingles(two)
        rows.append((i, one, two))
        true[i] = len(a & b) / len(a | b)
    docs = spark.createDataFrame(rows, "doc_id bigint, one string, two string")
    docs = fingerprints.with_fingerprint(fingerprints.with_fingerprint(docs, "one", "a"), "two", "b")
    found = docs.select("doc_id", fingerprints.likeness("a", "b")).collect()
    errors = [value - true[i] for i, value in found]
    assert abs(sum(errors) / len(errors)) < 0.01
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.05


def test_main_path_is_native(odd, capsys):
    fingerprints.edited(odd).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert "SinglePartition" not in plan
