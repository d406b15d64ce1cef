"""Passages that repeat across documents and quality weights, against brute force."""

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from provider_analytics.llm import passage_dedup, quality_resampling, queries


def test_both_are_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("passage", [12, 50])
def test_passages(spark, odd, passage):
    draw = np.random.default_rng(8)
    shared = [f"w{draw.integers(1000)}" for _ in range(90)]
    more = []
    for i, (start, end) in enumerate([(0, 50), (0, 49), (20, 90), (0, 90), (41, 90)]):
        own = [f"own{i}x{k}" for k in range(30)]
        # Passages begin inside lines and are broken by other white space and case.
        more.append((500 + i, " ".join(own[:15]) + "\n" + ("\t" if i % 2 else "  ").join(shared[start:end]).upper() + " " + " ".join(own)))
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = [tuple(r) for r in docs.collect()]
    left = passage_dedup.without_repeated_passages(docs, passage, run=4).collect()
    found = Counter((r.doc_id, r.n_words, r.n_dropped, b" ".join(brute.words(r.text))) for r in left)
    assert found == Counter(brute.dedup_passages(rows, passage))
    dropped = {r.doc_id: r.n_dropped for r in left}
    if passage == 50:
        assert [dropped[500 + i] for i in range(5)] == [0, 0, 0, 90, 0]
    untouched = {r.doc_id: r.text for r in left if not r.n_dropped and r.doc_id not in (None, 5)}
    texts = dict(rows)
    assert all(text == (texts[d] or "") for d, text in untouched.items())


def test_passages_in_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    left = passage_dedup.without_repeated_passages(docs).collect()
    found = Counter((r.doc_id, r.n_words, r.n_dropped, b" ".join(brute.words(r.text))) for r in left)
    assert found == Counter(brute.dedup_passages(rows, passage_dedup.PASSAGE))


def test_passages_of_no_rows(empty):
    assert passage_dedup.without_repeated_passages(empty).count() == 0


def test_hashes_of_runs():
    words = np.random.default_rng(9).integers(0, 4, 400).astype(np.uint64)
    for length in (1, 2, 7, 8, 50):
        hashes = passage_dedup.hashes_of_runs(words, length, passage_dedup.BASES[0])
        runs = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
        assert len(hashes) == len(runs) and len(set(hashes.tolist())) == len(set(runs))
        assert len(set(zip(hashes.tolist(), runs, strict=True))) == len(set(runs))
        least = passage_dedup.least_of_runs(words, length)
        assert least.tolist() == [min(r) for r in runs]


def test_weights(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    nulls = docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("bigint")})
    weights = quality_resampling.weighted(docs.union(nulls), labels)
    rows = weights.collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id: r.quality == 1 for r in labels.collect()}
    fold = {r.doc_id: r.held_out for r in rows}
    hashes = passage_dedup.WordHashes()
    bags = np.ones((2, quality_resampling.BUCKETS))
    for d, text in texts.items():
        if not fold[d]:
            np.add.at(bags[1], quality_resampling.features(hashes, text), 1)
            if good.get(d):
                np.add.at(bags[0], quality_resampling.features(hashes, text), 1)
    ratio = np.log(bags[0] / bags[0].sum()) - np.log(bags[1] / bags[1].sum())
    assert len(rows) == len(texts) + 2
    for r in rows:
        own = quality_resampling.features(hashes, texts.get(r.doc_id))
        assert r.n_features == len(own) and np.isclose(r.log_weight, ratio[own].sum(), atol=1e-6)
        assert np.isclose(r.score * max(1, len(own)), r.log_weight, atol=1e-6)
    trained = [good[d] for d in good if not fold[d]]
    assert sum(r.kept for r in rows) == round(len(rows) * sum(trained) / len(trained))
    again = quality_resampling.weighted(docs.union(nulls).repartition(7), labels).collect()
    key = lambda r: (r.doc_id, r.kept)
    assert Counter(key(r) for r in rows if r.doc_id is not None) == Counter(key(r) for r in again if r.doc_id is not None)
    # Held-out documents labelled as good get higher scores than the others.
    held = [(r.score, good[r.doc_id]) for r in rows if r.held_out and r.doc_id in good]
    above = [(a > b) + (a == b) / 2 for a, g in held if g for b, other in held if not other]
    assert np.mean(above) > 0.6


def test_weights_without_rows_or_labels(spark, odd, empty, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert quality_resampling.weighted(empty, labels).count() == 0
    rows = quality_resampling.weighted(odd, labels.limit(0)).collect()
    assert len(rows) == odd.count() and all(r.log_weight == 0 and r.kept for r in rows)
