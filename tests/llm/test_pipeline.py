"""The stages on the odd table, each held against brute force on its own input."""

from collections import Counter

import brute
import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken

from provider_analytics.llm import byte_bpe, common, queries, source_mixing


def test_stages(spark, odd):
    docs = odd
    stages = dict(corpus_pipeline.STAGES)
    assert corpus_pipeline.ORACLE_SQL is None

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.collect()]

    kept = stages["quality rules"](spark, docs, None)
    assert kept.columns == odd.columns
    assert Counter(pairs(kept)) == Counter(p for p in pairs(odd) if brute.quality(p[1])[-1])
    single = stages["exact dedup"](spark, kept, None)
    before = pairs(kept)
    expected = Counter(sha for *_, sha in brute.equal_groups(before))
    assert single.columns == odd.columns and single.count() == len(expected)
    few = stages["simhash near-dedup"](spark, single, None)
    components = {c for *_, c in brute.components(pairs(single))}
    assert few.columns == odd.columns and {d for d, _ in pairs(few)} == components
    mix = stages["source mixing"](spark, few, None)
    assert mix.columns == odd.columns
    assert set(pairs(mix)) <= set(pairs(few)) and max(Counter(pairs(mix)).values()) <= 3


def words_by_source(rows):
    found = Counter()
    for r in rows:
        found[r.source] += len(brute.words(r.text))
    return found


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_mix_gives_what_the_plan_says(spark, odd, sf_dir, table):
    docs = odd if table == "odd" else spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix = dict(corpus_pipeline.STAGES)["source mixing"](spark, docs, None).collect()
    if table == "documents":
        planned = {r.doc_id: r.copies for r in source_mixing.mixed(docs).collect() if r.copies}
        assert Counter(r.doc_id for r in mix) == planned
    sizes = words_by_source(docs.collect())
    taken, target = words_by_source(mix), brute.targets(sizes)
    copies = Counter((r.doc_id, r.text, r.source) for r in mix)
    rows = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    assert all(0 < n <= 3 * rows[r] for r, n in copies.items())
    for source in sizes:
        lacks = target[source] - taken[source]
        own = [(len(brute.words(r[1])), n, copies[r]) for r, n in rows.items() if r[2] == source]
        room = [size for size, n, got in own if size and (got < 3 * n if lacks > 0 else got)]
        assert not room or abs(lacks) < min(room)


def test_all_five_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), "stage")
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = Counter()
    for r in docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        expected[r.doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(r.text or "")] += 1
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = corpus_pipeline.run(spark, sf_dir)
    assert set(found.columns) == {*columns, "ids"}
    assert Counter(map(tuple, found.select(*columns).collect())) == expected


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_a_stage_on_no_rows(spark, empty, name):
    left = dict(corpus_pipeline.STAGES)[name](spark, empty, None)
    assert left.count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert left.columns == empty.columns


def test_run_on_no_rows(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and "ids" in found.columns


def test_tokens_of_odd_rows(spark, odd, pairs):
    """Nulls, empty texts, repeated rows, and a column that is called ids already."""
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    found = dict(corpus_pipeline.STAGES)["byte-level bpe"](spark, odd, None).collect()
    expected = Counter((d, tuple(encoding.encode_ordinary(t or "")), brute.sha(t or "")) for d, t in pairs)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in found) == expected
