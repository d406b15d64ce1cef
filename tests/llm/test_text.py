"""BPE, rules, language, language model and mixing against brute force."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from provider_analytics.llm import (
    byte_bpe,
    gated_network,
    language_id,
    language_model,
    queries,
    quality_rules,
    source_mixing,
)


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_bpe(spark, odd):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = [r.text for r in odd.select("text").collect()]
    texts += ["it's 12 o'clock   \r\n\n x", "日本語の長い文章です。" * 40, "ab" * 200, "퟿\U0001f600 é"]
    df = spark.createDataFrame([(t, "clash") for t in texts], "text string, ids string")
    tokens = byte_bpe.encoded(df, ranks, public_tokenizers.PATTERN, ahead=50)
    rows = byte_bpe.decoded(tokens, ranks).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == encoding.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_bpe_of_more_words_than_are_worked_on_at_once(spark):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    draw = random.Random(3)
    rare = ["".join(draw.choice("bcdfgaeiou") for _ in range(9)) for _ in range(200)]
    long = " ".join(draw.choice(rare) if i % 500 == 0 else "often" for i in range(byte_bpe.AT_ONCE + 1000))
    texts = [rare[0], None, long, "", " ".join(rare), long[:-2000], rare[1] + " often"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = byte_bpe.encoded(df, ranks, public_tokenizers.PATTERN, ahead=5).collect()
    found = sorted((r.text or "", r.ids) for r in rows)
    assert found == sorted((t or "", encoding.encode_ordinary(t or "")) for t in texts)


def looked_up(monkeypatch, ready, batch):
    """What the Arrow function gives for a batch, piece after piece."""
    monkeypatch.setattr(byte_bpe.F, "arrow_udf", lambda function, schema: function)
    return byte_bpe._looked_up(SimpleNamespace(value=ready))(iter([batch]))


def test_bpe_lookup_holds_no_more_for_a_larger_batch(monkeypatch):
    n = byte_bpe.AT_ONCE // 64
    ready = byte_bpe.Ready(pa.table({"word": ["often", "too"], "ids": [[1, 2], [3]]}))

    def peak(documents):
        batch = pa.array([["often", f"rare{i % 7}", "too", "often"] * 16 for i in range(documents)])
        tracemalloc.start()
        for part in looked_up(monkeypatch, ready, batch):
            assert len(part) <= n
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found

    assert peak(8 * n) < 1.5 * peak(n)


@pytest.mark.parametrize("collide", [False, True])
def test_bpe_lookup_goes_by_whole_words(monkeypatch, collide):
    if collide:
        monkeypatch.setattr(byte_bpe, "_hashes", lambda short: np.zeros(len(short), np.uint64))
    long = "x" * byte_bpe.AHEAD_BYTES
    ids = {"a": [1], "ab": [2, 3], "ä": [], "\0": [4], "a\0": [5], long: [6]}
    ready = byte_bpe.Ready(pa.table({"word": list(ids), "ids": pa.array(ids.values(), pa.list_(pa.int32()))}))
    assert len(ready.words) == (1 if collide else len(ids))
    held = {word: ids[word] for word in ready.words.to_pylist()}
    texts = [[*ids, "b", long + "x", "ba"], [], None, ["b", "b", *reversed(ids)]]
    rows = [r for part in looked_up(monkeypatch, ready, pa.array(texts)) for r in part.to_pylist()]
    for words, row in zip(texts, rows, strict=True):
        known, which = [[]], []
        for word in words or []:
            if word in held:
                known[-1] += held[word]
            else:
                known.append([])
                which.append(word)
        assert row["known"] == known and [row["new"][i] for i in row["which"]] == which
        assert len(set(row["new"])) == len(row["new"])


def test_bpe_of_no_rows(empty):
    ranks = byte_bpe.ranks_of(public_tokenizers.path(queries.TOKENIZER))
    assert queries.token_digests(empty, ranks).count() == 0


def test_rules(odd, pairs):
    rows = quality_rules.verdicts(odd).collect()
    assert Counter(map(tuple, rows)) == Counter((d, *brute.quality(t)) for d, t in pairs)
    assert 0 < sum(r.kept for r in rows) < len(rows)
    kept = quality_rules.accepted(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)


def test_rules_of_no_rows(empty):
    assert quality_rules.verdicts(empty).count() == quality_rules.accepted(empty).count() == 0


def test_cascade_goes_by_rejections_per_second(monkeypatch, spark):
    rules = [quality_rules.Rule(n, lambda m: False) for n in "abc"]
    rows = [("a", 10, 1, 1.0), ("b", 10, 5, 1.0), ("c", 10, 1, 0.1)]
    measured = spark.createDataFrame(rows, "rule string, seen bigint, rejected bigint, seconds double")
    monkeypatch.setattr(quality_rules, "rule_statistics", lambda *_: measured)
    assert [r.name for r in quality_rules.cascade(None, rules)] == ["c", "b", "a"]


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    nulls = docs.limit(2).withColumns({"text": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")})
    digits = docs.limit(1).withColumn("text", F.lit("123 *** 456"))
    rows = language_id.predicted(docs.union(nulls).union(digits)).collect()
    assert [r.lang_pred for r in rows].count("und") >= 3
    assert all(0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)


def grams_of(text):
    """One to three letters of lower-cased words with a blank at each end, most frequent first."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    spaced = " " + "".join(word + " " for word in words) if words else ""
    counts = Counter(spaced[i : i + n] for n in (1, 2, 3) for i in range(len(spaced) - n + 1))
    counts.pop(" ", None)

    def order(gram):
        return -counts[gram], sum(ord(c) << 21 * i for i, c in enumerate(reversed(gram)))

    return counts, sorted(counts, key=order)


@pytest.mark.parametrize("training", [15, language_id.TRAINING])
def test_language_against_plain_profiles(spark, sf_dir, odd, training):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = table.union(odd.select("doc_id", "text", "lang").where("doc_id > 3"))
    rows = docs.withColumn("drawn", F.xxhash64("doc_id", "text")).collect()
    totals = defaultdict(Counter)
    for lang in {r.lang for r in rows} - {None}:
        own = [r for r in rows if r.lang == lang and r.text is not None and remainder(r.doc_id, 5) != 0]
        own.sort(key=lambda r: r.drawn)
        for r in own:
            if r.drawn <= own[min(training, len(own)) - 1].drawn:
                totals[lang].update(grams_of(r.text)[0])
    profiles = {}
    for lang, total in totals.items():
        code = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
        profiles[lang] = {g: i for i, g in enumerate(sorted(total, key=lambda g: (-total[g], code(g)))[:300])}
    expected = Counter()
    for r in rows:
        own = grams_of(r.text or "")[1][:300]
        if not own:
            expected[r.doc_id, "und", 0.0] += 1
            continue
        apart = {
            lang: sum(abs(profile[g] - i) if g in profile else 300 for i, g in enumerate(own))
            for lang, profile in profiles.items()
        }
        best = min(sorted(apart), key=apart.get)
        expected[r.doc_id, best, round(1 - apart[best] / (300 * len(own)), 9)] += 1
    found = language_id.predicted(docs, training=training).collect()
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 9)) for r in found) == expected


def test_no_text_is_shuffled_for_profiles(spark, sf_dir, capsys):
    language_id.profiles(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line


def test_language_of_no_rows(empty, odd):
    assert language_id.predicted(empty).count() == 0
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.predicted(nothing).collect()} == {("und", 0.0)}


def test_out_of_place_distance(spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("abab abc", "x"), ("zyz zy", "y")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    letters = language_id.letters()
    found = {r.doc_id: r for r in language_id.predicted(docs, size=10).collect()}
    own = language_id.ranked_ngrams("abab abc", letters)[0][:10]
    assert found[0].lang_pred == "x" and len(own) == 10
    assert found[0].score == 1.0  # the profile's ranks are the text's own
    assert {r.lang_pred for r in found.values()} == {"x", "y"}


def test_scores(odd, pairs):
    rows = language_model.scored(odd, vocabulary=40, known=100).collect()
    train = [(d, t) for d, t in pairs if remainder(d, 7) != 2]
    counts = Counter(w.lower() for _, t in train for w in brute.words(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    expected = []
    for d, t in pairs:
        tokens = [w.lower() for w in brute.words(t)]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        base += math.log10((len(train) + 1) / (n + v + 1))
        known = sum(w in counts for w in tokens) + 1
        expected.append((d, remainder(d, 7) == 2, len(tokens) + 1, known, n, round(base, 6)))
    found = [(*tuple(r)[:5], round(r.base_score, 6)) for r in rows]
    assert Counter(found) == Counter(expected)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_scores_of_no_rows(empty):
    assert language_model.scored(empty).count() == 0


def test_vocabulary_follows_the_counts(spark):
    rows = [(f"w{i}", 100 + i % 7) for i in range(3000)] + [(f"rare{i}", 99) for i in range(500)]
    counts = spark.createDataFrame(rows, "word string, n bigint")
    share = language_model.SHARE
    assert language_model.vocabulary_of(counts, int(99.5 / share)) == 3002
    assert language_model.vocabulary_of(counts, int(98.5 / share)) == 3502
    assert language_model.vocabulary_of(counts, int(200 / share)) == language_model.VOCABULARY


def test_windows_hold_every_word_once_and_documents_whole():
    draw = np.random.default_rng(3)
    documents = [draw.integers(1, 50, n).astype(np.int32) for n in [1, 500, 3, 3, 64, 32, 33, 1, 200, 7]]
    seen = [[] for _ in documents]
    for window in gated_network.windows(documents, 0, 16, lanes=3):
        assert window.inputs.shape[0] <= 16 and (window.document >= 0).any(axis=0).all()
        for lane in range(window.inputs.shape[1]):
            for step in range(window.inputs.shape[0]):
                i = window.document[step, lane]
                if i >= 0:
                    assert window.starts[step, lane] == (not seen[i])
                    assert window.inputs[step, lane] == (seen[i][-1] if seen[i] else 0)
                    seen[i].append(window.targets[step, lane])
    assert all(words == list(document) for words, document in zip(seen, documents, strict=True))


def test_memory_goes_by_words_not_by_the_longest_document():
    documents = [np.ones(100, np.int32)] * 511 + [np.ones(1_000_000, np.int32)]
    tracemalloc.start()
    n = sum(int((window.document >= 0).sum()) for window in gated_network.windows(documents, 0, 64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 511 * 100 + 1_000_000 and peak < 100 * n


def test_training_does_not_end_with_few_documents(monkeypatch):
    documents = [np.full(n, 7, np.int32) for n in [20] * 300 + [1000, 900]]
    seen, plain = [], gated_network.windows
    monkeypatch.setattr(gated_network, "windows", lambda *a: (seen.append(w.document) or w for w in plain(*a)))
    trainer = gated_network.Trainer(gated_network.initial(np.ones(9)), 9)
    trainer.learn(documents, 0)
    widths = [int((document >= 0).sum()) for document in seen]
    assert sum(widths) == trainer.words == 7900 and min(widths[:-1]) > max(widths) / 2


def test_few_powers_of_e_a_word(monkeypatch):
    # Two words in five are the mark of others, the rest follow Zipf's law.
    draw, vocabulary = np.random.default_rng(4), 4900
    chance = np.append([0.01, 0.4], 0.59 * (1 / np.arange(1, vocabulary - 1)) / (1 / np.arange(1, vocabulary - 1)).sum())
    documents = [draw.choice(vocabulary, 200, p=chance / chance.sum()).astype(np.int32) for _ in range(600)]
    flat = gated_network.initial(np.bincount(np.concatenate(documents), minlength=vocabulary))
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: taken.append(np.size(x)) or exp(x, **more))
    gated_network.log_likelihoods(flat, vocabulary, documents, 0)
    # Classes of 70 words each took 140, whatever the word.
    assert sum(taken) < 100 * 600 * 200


def test_probabilities_against_plain_softmax():
    for vocabulary, steepness in [(1, 1), (2, 1), (3, 1), (60, 1), (60, 300)]:
        flat = gated_network.initial(np.arange(vocabulary, 0, -1))
        v, edges = gated_network.views(flat, vocabulary), gated_network.edges(vocabulary)
        v["classes"][:] *= steepness
        v["words"][:] *= steepness
        x = v["input"][0].astype(np.float64)  # the first state follows from the start's input alone
        state = np.append((0.5 + 0.5 * np.tanh(x[:16])) * np.tanh(x[16:]), 1)

        def logs(weights, state=state):
            logits = weights.astype(np.float64) @ state
            return logits - logits.max() - np.log(np.exp(logits - logits.max()).sum())

        expected = [
            of_class + of_word
            for c, of_class in enumerate(logs(v["classes"]))
            for of_word in logs(v["words"][edges[c] : edges[c + 1]])
        ]
        every = [np.array([w], np.int32) for w in range(vocabulary)]
        found = gated_network.log_likelihoods(flat, vocabulary, every, 0)
        assert np.allclose(found, expected, rtol=1e-4, atol=1e-4) and abs(np.exp(expected).sum() - 1) < 1e-9


def test_scores_of_small_batches(odd, monkeypatch):
    def counted():
        rows = language_model.scored(odd, vocabulary=40, known=100).collect()
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
        return Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in rows)

    whole = counted()
    monkeypatch.setattr(language_model, "BATCH", 20)
    assert counted() == whole


def test_gradient_against_differences():
    draw = np.random.default_rng(11)
    vocabulary, documents = 20, [draw.integers(0, 20, n).astype(np.int32) for n in (9, 4, 14)]
    flat = gated_network.initial(np.bincount(np.concatenate(documents), minlength=vocabulary)).astype(np.float64)
    flat += draw.normal(0, 0.3, len(flat)) * (flat > -1e3)
    found = {}

    class Kept(gated_network.Trainer):
        def _update(self):
            found["gradient"], self.pending = self.gradient, 0

    Kept(flat.astype(np.float32), vocabulary).learn(documents, 0)

    def loss(parameters):
        return -gated_network.log_likelihoods(parameters.astype(np.float32), vocabulary, documents, 0).sum()

    places = draw.choice(np.flatnonzero(flat > -1e3), 60, replace=False)
    for at in places:
        step = np.zeros(len(flat))
        step[at] = 2e-2
        slope = (loss(flat + step) - loss(flat - step)) / 4e-2
        assert abs(slope - found["gradient"][at]) < 0.02 + 0.02 * abs(slope)


def test_many_words_train():
    vocabulary = 40_000  # more than short integers number
    documents = [np.array([*range(i, vocabulary, 400), 0], np.int32) for i in range(2, 400)]
    start = gated_network.initial(np.bincount(np.concatenate(documents), minlength=vocabulary))
    trainer = gated_network.Trainer(start, vocabulary)
    trainer.learn(documents, 0)
    before, after = (gated_network.log_likelihoods(p, vocabulary, documents, 0).sum() for p in (start, trainer.flat))
    changed = gated_network.views(trainer.flat, vocabulary)["input"] != gated_network.views(start, vocabulary)["input"]
    assert after > before and changed[35_000:].any()


def test_held_out_documents_score_above_the_counts(spark):
    # 700 words of which each tells the next; half of them are beyond the first 512.
    draw = np.random.default_rng(1)
    after = draw.permutation(700)
    texts = []
    for _ in range(1500):
        at = [int(draw.integers(700))]
        while len(at) < 120:
            at.append(int(after[at[-1]]) if draw.random() < 0.9 else int(draw.integers(700)))
        texts.append(" ".join(f"w{i}" for i in at))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rows = [r for r in language_model.scored(docs).collect() if r.held_out]
    assert len(rows) > 100
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_held_out_documents_of_the_table_score_above_the_counts(spark, sf_dir):
    rows = language_model.scored(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_network_is_a_distribution_and_learns():
    draw = np.random.default_rng(0)
    # A word is followed by its double, so context tells much.
    def document():
        words = [int(draw.integers(2, 30))]
        for _ in range(60):
            words.append(2 + 2 * (words[-1] - 2) % 28 if draw.random() < 0.9 else int(draw.integers(2, 30)))
        return np.array([*words, 0], np.int32)

    documents = [document() for _ in range(300)]
    counts = np.bincount(np.concatenate(documents), minlength=30)
    start = gated_network.initial(counts)
    trainer = gated_network.Trainer(start, 30)
    for _ in range(8):
        trainer.learn(documents[:250], 0)
    before = gated_network.log_likelihoods(start, 30, documents[250:], 0).sum()
    after = gated_network.log_likelihoods(trainer.flat, 30, documents[250:], 0).sum()
    assert after > 0.8 * before
    alone = [gated_network.log_likelihoods(trainer.flat, 30, [d], 0)[0] for d in documents[250:260]]
    together = gated_network.log_likelihoods(trainer.flat, 30, documents[250:260], 0)
    assert np.allclose(alone, together, rtol=1e-4)
    every = [np.array([w], np.int32) for w in range(30)]
    assert abs(np.exp(gated_network.log_likelihoods(trainer.flat, 30, every, 0)).sum() - 1) < 1e-4


def test_mixing(odd):
    rows = source_mixing.mixed(odd.withColumnRenamed("row", "row_")).join(
        odd.select("doc_id", "source").distinct(), "doc_id"
    )
    rows = [r for r in rows.collect() if r.doc_id != 5]
    again = source_mixing.mixed(odd.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    once = sorted((r.doc_id, r.size, r.taken) for r in rows)
    assert once == sorted((r.doc_id, r.size, r.taken) for r in again if r.doc_id not in (None, 5))
    assert sorted(again, key=key) is not None
    sizes = defaultdict(int)
    for r in odd.select("source", "text").collect():
        sizes[r.source] += len(brute.words(r.text))
    target = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    # Documents are whole, so a source can miss its target by half its largest document.
    assert len(set(sizes.values())) == len(sizes)
    for source, size in sizes.items():
        own = [r for r in again if r.source_size == size]
        off = abs(sum(r.taken for r in own) - target[source])
        assert off <= max(0.02 * target[source], max(r.size for r in own) / 2)


def test_rates_meet_the_targets(spark):
    draw = np.random.default_rng(5)
    small = np.maximum(1, draw.lognormal(5.5, 1.5, 500)).astype(int).tolist()
    rows = []
    for long in ([], [100_000], [3_000_000, 40_000]):
        for ratio in (0.01, 0.3, 0.7, 1.3, 2.0, 2.7, 2.95):
            total = sum(small + long)
            rows += [(f"{long} {ratio}", s, n, total, ratio * total) for s, n in Counter(small + long).items()]
    cells = spark.createDataFrame(rows, "key string, size bigint, n bigint, source_size bigint, target double")
    found = source_mixing._with_rates(cells).collect()
    for key in {r[0] for r in rows}:
        own = [r for r in found if r.key == key]
        got = sum(r.size * r.n * r.rate for r in own)
        assert all(0 <= r.rate <= 3 for r in own) and math.isclose(got, own[0].target, rel_tol=2e-9)


def test_mix_makes_up_for_rounding(spark):
    draw = np.random.default_rng(4)
    small = np.maximum(1, draw.lognormal(5.5, 0.7, 2000)).astype(int).tolist()
    tables = {
        "one long": (small + [1_000_000], (0.7, 1.3, 1.9)),
        "three long": (small + [1_000_000] * 3, (0.3,)),
        "two long": (small[:200] + [60_000, 90_000], (0.5, 2.0)),
    }
    rows = []
    for name, (sizes, ratios) in tables.items():
        for ratio in ratios:
            total = sum(sizes)
            rows += [(f"{name} {ratio}", s, n, total, ratio * total) for s, n in Counter(sizes).items()]
    cells = spark.createDataFrame(rows, "key string, size bigint, n bigint, source_size bigint, target double")
    plan = source_mixing._with_copies(source_mixing._with_rates(cells)).collect()
    assert len(plan) == len(rows)
    for key in {r[0] for r in rows}:
        own = [r for r in plan if r.key == key]
        assert all(0 <= r.copies <= 3 * r.n for r in own)
        lacks = own[0].target - sum(r.size * r.copies for r in own)
        room = [r.size for r in own if (r.copies < 3 * r.n if lacks > 0 else r.copies > 0)]
        assert not room or abs(lacks) < min(room)
        if key != "three long 0.3":
            assert abs(lacks) < 1e-3 * own[0].target


def test_mixing_of_no_rows(empty):
    assert source_mixing.mixed(empty).count() == 0
