"""Registered queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    exact_dedup,
    filter_audit,
    fingerprints,
    language_id,
    language_model,
    line_dedup,
    near_passages,
    quality_resampling,
    quality_rules,
    simhash_dedup,
    source_mixing,
    vector_codes,
)
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_digests(docs, byte_bpe.ranks_of(public_tokenizers.path(TOKENIZER)))


def token_digests(docs: DataFrame, ranks: dict[bytes, int], *more: str) -> DataFrame:
    """doc_id, the number of ids, digests of ids and decoded bytes, and ``more`` columns."""
    tokens = byte_bpe.encoded(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    both = byte_bpe.decoded(tokens, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixed(documents(spark, sf_dir)).drop("copies")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeated_lines(documents(spark, sf_dir))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = near_passages.without_similar_passages(documents(spark, sf_dir))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_dropped", "n_near", digest.alias("kept_sha256"))


def op5_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_resampling.weighted(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_gated_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(documents(spark, sf_dir))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "fingerprint", "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups_of_equals(documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(vector_codes.numbers(books).encode()).hexdigest()
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fingerprints.edited(documents(spark, sf_dir))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text("fingerprint").alias("fingerprint"),
        fingerprints.as_text("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_byte_bpe,
        op2_source_mixing,
        op3_line_dedup,
        op4_passage_dedup,
        op5_quality_resampling,
        op6_gated_language_model,
        op7_simhash_dedup,
        op8_language_id,
        op9_quality_rules,
        op10_exact_dedup,
        op11_vector_codes,
        op12_fingerprints,
        op13_filter_audit,
    )
}

def _vector_codes_sql(rounds: int = 4) -> str:
    """Every part against every entry, round by round."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
        found{n} AS MATERIALIZED (
            SELECT r, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
                SELECT p.r, p.part, b.entry, sum((p.x - b.y) * (p.x - b.y))::BIGINT AS d
                FROM places p JOIN book{n} b ON p.part = b.part AND p.i = b.i
                GROUP BY p.r, p.part, b.entry)
            GROUP BY r, part
        )""")
        if n < rounds:
            steps.append(f"""
        book{n + 1} AS MATERIALIZED (
            SELECT part, entry, i,
                coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, y) AS y
            FROM book{n} LEFT JOIN (
                SELECT f.part, f.entry, p.i, sum(p.x) AS s, count(*) AS n
                FROM found{n} f JOIN places p ON f.r = p.r AND f.part = p.part
                GROUP BY f.part, f.entry, p.i) USING (part, entry, i)
        )""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, len(embedding) // 4 AS w,
                list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), places AS MATERIALIZED (
            SELECT r, (spot - 1) // w AS part, (spot - 1) % w AS i, x
            FROM (SELECT r, w, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS spot FROM kept)
        ), book0 AS MATERIALIZED (
            SELECT part, r - 1 AS entry, i, x AS y FROM places WHERE r <= 256
        ), {",".join(steps)},
        coded AS (
            SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM found{rounds} GROUP BY r
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, i)) FROM book{rounds}) AS codebooks_sha256
        FROM kept JOIN coded USING (r)
    """


ORACLE_SQL: dict[str, str] = {
    "op11_vector_codes": _vector_codes_sql(),
    "op13_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), marks AS (
            SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), judged AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                list_filter([
                    CASE WHEN len(w) < 200 THEN 'A' END,
                    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' END,
                    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
                    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END
                ], lambda letter: letter IS NOT NULL) AS letters
            FROM words LEFT JOIN marks USING (doc_id)
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
        ), orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps AS (
            SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f,
                string_split(left(filter_order, step - 1), '') AS before
            FROM orders, range(1, 6) r(step)
        ), counted AS (
            SELECT part, filter_order, step, any_value(f) AS f,
                count(*) FILTER (WHERE NOT gone AND NOT hit) AS kept,
                count(*) FILTER (WHERE NOT gone AND hit) AS removed,
                count(*) FILTER (WHERE gone AND hit) AS redundant,
                count(*) FILTER (WHERE letters = [f]) AS unique_fails,
                count(*) FILTER (WHERE NOT gone AND hit AND good) AS good_lost,
                count(*) FILTER (WHERE NOT gone AND hit AND toxic) AS toxic_lost
            FROM (SELECT *, list_has_any(letters, before) AS gone, list_contains(letters, f) AS hit
                  FROM judged, steps)
            GROUP BY part, filter_order, step
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM counted
    """,
    "op3_line_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), lines AS (
            SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs
        ), keyed AS (
            SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT r) >= 3
        ), judged AS (
            SELECT k.*, coalesce(k.doc_id <> p.last, false) AS goes
            FROM keyed k LEFT JOIN repeated p ON k.key = p.key
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
        FROM judged GROUP BY r
    """,
    "op9_quality_rules": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
        ), parts AS (
            SELECT r, doc_id, text,
                regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                list_filter(string_split(text, chr(10)),
                    lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
            FROM docs
        ), windows AS (
            SELECT r, pos, words[pos:pos + 4] AS five
            FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS pos FROM parts WHERE len(words) >= 5)
        ), found AS (
            SELECT r, pos, count(*) OVER (PARTITION BY r, five) AS n FROM windows
        ), covered AS (
            SELECT r, count(DISTINCT place) AS n_repeat
            FROM (SELECT r, unnest(range(pos, pos + 5)) AS place FROM found WHERE n > 1) GROUP BY r
        ), counted AS (
            SELECT p.doc_id,
                len(words)::BIGINT AS n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(c.n_repeat, 0)::BIGINT AS n_repeat_words,
                len(lines)::BIGINT AS n_lines
            FROM parts p LEFT JOIN covered c ON p.r = c.r
        ), based AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
                 OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
        FROM based
    """,
    "op10_exact_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, length(coalesce(text, '')) AS points,
                regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        ), placed AS (
            SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST, r) AS keep_id,
                row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST, r) AS place
            FROM docs
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM placed
    """,
}
