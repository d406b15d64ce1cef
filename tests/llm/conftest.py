import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " `row` bigint, size string, hash string, ids string, fp string, `key` string"
)


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies, shared lines."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("aeioubcdfgé") for _ in range(draw.randint(2, 9))) for _ in range(300)]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    line = "This Line stands in many documents of the table."
    long = text(9000)
    texts = [text(draw.randint(12, 80)) for _ in range(40)]
    texts += [None, "", " \n\t ", "word", "a b c", long, long.replace(" ", "\n", 5), "x" * 3000]
    texts += [texts[0], texts[0] + " ", texts[0].replace(" ", "  "), texts[1].upper()]
    near = text(400)
    texts += [near] + [near.replace(" ", f" extra{i} ", 1) for i in range(6)]
    texts += ["\n".join([text(6), case, text(6)]) for case in (line, f"  {line.upper()}", line, line + "\t", "short line")]
    texts += ["*** ### $$$ " * 20, "same words here again now " * 30, "\n".join([text(8)] * 9)]
    rows = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None, "ä"][i % 4]) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], "en", "a"), (None, texts[4], "en", "a"), (5, "another text of five", "fr", "b")]
    return [(*r, None, 7, "x", None, "[1]", "f", "k") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
