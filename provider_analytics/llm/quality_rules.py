"""Quality rules as a short-circuit cascade.

Each rule rejects a text by a few of its measures. On a sample of the documents the
cost of every rule and the share it rejects are measured; the rules then run in the
order of rejections per second, and a text rejected by one is not tried by the next.
A measure that several rules need is taken once per text. The order decides what the
work costs and never which documents stay.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, utf8

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Share of the documents on which costs and rejections are measured.
SAMPLE = 0.01


class Measures:
    """Counts of one text, each taken when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return utf8(self.text).split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def _lines(self) -> tuple[int, int]:
        lines = [line for line in self.text.split("\n") if line.strip(SPACES)]
        return len(lines), len(set(lines))

    @property
    def n_lines(self) -> int:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> int:
        return self._lines[0] - self._lines[1]

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        if len(set(windows)) == len(windows):
            return 0
        found = Counter(windows)
        total = end = 0
        for start, window in enumerate(windows):
            if found[window] > 1:
                total += start + WINDOW - max(start, end)
                end = start + WINDOW
        return total


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


BASE_RULES = (
    Rule("few words", lambda m: m.n_words < 10),
    Rule("repeated words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
)
#: Limits in use for web text, in whole numbers so that SQL gives the same verdict.
RULES = BASE_RULES + (
    Rule("symbols", lambda m: 100 * m.n_symbols > 10 * m.n_words),
    Rule("repeated lines", lambda m: 100 * m.n_dup_lines > 30 * m.n_lines),
    Rule("short words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long words", lambda m: m.word_chars > 20 * m.n_words),
)


def rejected_by(measures: Measures, rules: Sequence[Rule]) -> str | None:
    """The first rule that rejects the text; those after it are not tried."""
    return next((rule.name for rule in rules if rule.rejects(measures)), None)


def rule_statistics(docs: DataFrame, rules: Sequence[Rule] = RULES, share: float = SAMPLE) -> DataFrame:
    """Per rule over a sample of ``docs``: texts seen, texts rejected, seconds.
    A rule's seconds include all measures it needs."""

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += 1
                for i, rule in enumerate(rules):
                    start = time.perf_counter()
                    rejected[i] += rule.rejects(Measures(text))
                    seconds[i] += time.perf_counter() - start
        yield pa.RecordBatch.from_arrays(
            [pa.array([r.name for r in rules]), pa.array([seen] * len(rules), pa.int64()), pa.array(rejected, pa.int64()), pa.array(seconds)],
            names=["rule", "seen", "rejected", "seconds"],
        )

    sample = docs.select("text").sample(fraction=share, seed=9)
    tried_rules = sample.mapInArrow(tried, "rule string, seen bigint, rejected bigint, seconds double")
    return tried_rules.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seen", "rejected", "seconds")])


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, share: float = SAMPLE) -> list[Rule]:
    """``rules`` in order of rejections per second on a sample; as given where it is empty.
    One row per rule comes to the driver."""
    measured = {r["rule"]: r for r in rule_statistics(docs, rules, share).collect()}

    def yield_of(rule: Rule) -> float:
        row = measured.get(rule.name)
        return (row["rejected"] + 0.01) / (row["seconds"] + 1e-6) if row and row["seen"] else 0.0

    return sorted(rules, key=yield_of, reverse=True)


def verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, the
    counts, and kept. All counts are returned, so a text that the cascade rejects early
    still has every measure taken; ``accepted`` takes no more than it needs.

    Null and empty texts have no words and are rejected. Rows that repeat get equal
    results; an empty table gives none.
    """
    ordered = cascade(docs, rules)
    schema = (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
        " n_repeat_words bigint, base_failed boolean, kept boolean"
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    names = ["doc_id", *counts, "base_failed", "kept"]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in names[1:]}
            for text in batch.column("text").to_pylist():
                measures = Measures(text)
                rows["kept"].append(rejected_by(measures, ordered) is None)
                rows["base_failed"].append(rejected_by(measures, BASE_RULES) is not None)
                for name in counts:
                    rows[name].append(getattr(measures, name))
            arrays = [pa.array(rows[n], pa.int64() if n in counts else pa.bool_()) for n in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(judged, schema)


def accepted(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` no rule rejects, with all their columns."""
    ordered = cascade(docs, rules)
    at = docs.columns.index("text")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([rejected_by(Measures(t), ordered) is None for t in texts], pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
