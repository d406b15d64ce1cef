"""Exact, line and SimHash de-duplication against brute force."""

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from provider_analytics.llm import exact_dedup, line_dedup, queries, simhash_dedup


def found(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("clashes", [False, True])
def test_exact_groups(odd, pairs, clashes):
    # With four hash values, blocks differ by content alone.
    options = {"block": 16, "block_hash": lambda b: F.xxhash64(b) % 4} if clashes else {}
    groups = exact_dedup.groups_of_equals(odd, **options)
    assert found(groups, *EXACT) == Counter(brute.equal_groups(pairs))


def test_exact_of_no_rows(empty):
    assert exact_dedup.groups_of_equals(empty).count() == 0


def test_lines(odd, pairs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    kept = line_dedup.without_repeated_lines(odd)
    digest = kept.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    assert found(digest, "doc_id", "n_lines", "n_dropped", "sha") == Counter(brute.dedup_lines(pairs))
    assert digest.where("n_dropped > 0").count() > 0


def test_lines_of_no_rows(empty):
    assert line_dedup.without_repeated_lines(empty).count() == 0


def test_minimal_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**64, (20_000, 2), np.uint64)
    levels = line_dedup.build_hash(*keys.T)
    sizes, bits = line_dedup._packed(levels)
    at = line_dedup.look_up(line_dedup._unpacked(sizes, bits), *keys.T)
    assert sorted(at) == list(range(len(keys)))
    assert line_dedup.build_hash(keys[:0, 0], keys[:0, 1]) == []


def test_simhash(odd, pairs):
    near = simhash_dedup.near_duplicates(odd, tree=3)  # several trees a shard
    assert found(near, "doc_id", "fingerprint", "component_id") == Counter(brute.components(pairs))


def test_simhash_of_no_rows(empty):
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_bk_tree_search():
    draw = np.random.default_rng(2)
    centre = draw.integers(0, 2**64, 30, np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (30, 20, 3), np.uint64)
    members = np.unique(centre[:, None] ^ np.bitwise_xor.reduce(flips, axis=2))
    queries_ = np.append(members, draw.integers(0, 2**64, 50, np.uint64))
    hits = {(int(n), int(q)) for n, near in simhash_dedup.BKTree(members).search(queries_, 4) for q in near}
    apart = np.bitwise_count(members[:, None] ^ queries_[None, :])
    assert hits == set(map(tuple, np.argwhere(apart <= 4).tolist()))


def test_every_close_pair_shares_a_shard():
    draw = np.random.default_rng(3)
    masks = [np.uint64(m) for m in simhash_dedup._masks(4)]
    for _ in range(500):
        a = draw.integers(0, 2**64, dtype=np.uint64)
        b = a
        for bit in draw.integers(0, 64, 4):
            b ^= np.uint64(1) << np.uint64(bit)
        assert any(a & m == b & m for m in masks)


def test_registered_sql(spark, sf_dir):
    import duckdb

    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, sf_dir)
        answer = duck.execute(sql)
        columns = [d[0] for d in answer.description]
        assert sorted(columns) == sorted(df.columns)
        assert found(df, *columns) == Counter(answer.fetchall())
