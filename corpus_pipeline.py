"""From raw documents to token ids: rules, exact and near copies, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept;
its result is written and read again before the next one. All but the last keep the
columns of ``documents``. Rows with nulls in any column, rows that repeat, very long
texts and empty tables go through every stage as its operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from provider_analytics.llm import (
    byte_bpe,
    common,
    exact_dedup,
    quality_rules,
    queries,
    simhash_dedup,
    source_mixing,
)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.accepted(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one stays."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints one stays."""
    return simhash_dedup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix of sources takes it."""
    return source_mixing.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of the text they decode to."""
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    return queries.token_digests(docs, ranks, "ids")


STAGES = [
    ("quality rules", rules),
    ("exact dedup", copies),
    ("simhash near-dedup", near_copies),
    ("source mixing", mix),
    ("byte-level bpe", tokens),
]

#: Fingerprint components and multipliers found by iteration are beyond SQL; the tests
#: hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
