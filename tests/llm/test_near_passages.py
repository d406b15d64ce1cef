"""Passages with changed words, against brute force."""

from collections import Counter

import brute
import numpy as np
import pytest

from provider_analytics.llm import near_passages, passage_dedup

PASSAGE = 12
LENGTH = PASSAGE - near_passages.TOKEN + 1


def test_windows_hold_each_passage_once():
    draw = np.random.default_rng(3)
    for most in (4, 1 << 40):
        parts = [draw.integers(1, most, n).astype(np.uint64) for n in (LENGTH, 70, 200, 9)]
        parts.append(np.full(60, 7, np.uint64))
        zero = np.zeros(1, np.uint64)
        values = np.concatenate([zero, *(x for p in parts for x in (p, zero))])
        windows = list(zip(*(x.tolist() for x in near_passages.windows_of(values, LENGTH)), strict=True))
        assert all(values[c] == v == values[begin : end + 1].min() for begin, c, end, v in windows)
        for i in range(len(values)):
            for j in range(i + LENGTH, len(values) + 1):
                if values[i:j].all():
                    held = [w for w in windows if w[0] <= i and j - 1 <= w[2] and w[3] == values[i:j].min()]
                    assert len(held) == 1
                    assert most == 4 or len(parts[-1]) or i <= held[0][1] < j


def test_regions_hold_the_passages_of_their_signature():
    draw = np.random.default_rng(4)
    docs = [draw.integers(1, 1 << 60, n).astype(np.uint64) for n in (5, 12, 90, 0, 130)]
    tokens, which, signature, begin, end, start, c = near_passages.regions_of(docs, PASSAGE)
    assert set(which.tolist()) == {1, 2, 4} and (end - begin + 1 < 2 * LENGTH).all() and (end - begin + 1 >= LENGTH).all()
    regions = list(zip(which.tolist(), signature.tolist(), begin.tolist(), end.tolist(), strict=True))
    n = 0
    for doc, first in zip(which.tolist(), start.tolist(), strict=True):
        assert first == {1: 1, 2: 10, 4: 97}[doc]
    for doc, first in ((1, 1), (2, 10), (4, 97)):
        for i in range(first, first + len(docs[doc]) - PASSAGE + 1):
            own = tokens[i : i + LENGTH]
            for f, g in near_passages.PAIRS:
                least = [(passage_dedup.mixed(own ^ np.uint64(near_passages.SEEDS[k])) | np.uint64(1)).min() for k in (f, g)]
                sign = passage_dedup.mixed(np.array([least[0]]) * np.uint64(near_passages.SEEDS[0]) + least[1])[0]
                held = [r for r in regions if r[0] == doc and r[1] == int(sign) and r[2] <= i and i + LENGTH - 1 <= r[3]]
                assert len(held) == 1
                n += 1
    assert n == 2 * (1 + 79 + 119)


def test_alike_ranges():
    draw = np.random.default_rng(5)
    for changes in range(12):
        other = draw.permutation(1000)[:60].astype(np.int32)
        own = np.concatenate([draw.integers(2000, 3000, 3), other])[:55].astype(np.int32)
        own[draw.integers(0, 55, changes)] = 5000 + np.arange(changes)
        found = near_passages.alike_ranges(own, other, -3, 20)
        covered = set()
        for i in range(36):
            j = max(0, i - 3)
            a, b = set(own[i : i + 20].tolist()), set(other[j : j + 20].tolist())
            if len(a & b) >= near_passages.ALIKE * len(a | b):
                covered |= set(range(i, i + 20))
        inside = {i for first, n in found for i in range(first, first + n - near_passages.TOKEN + 1)}
        assert inside <= covered and {i for i in covered if own[i] in other} <= inside
        assert all(own[first] in other and own[first + n - near_passages.TOKEN] in other for first, n in found)


def changed(words, draw, every):
    """One word in ``every`` is another one, from a place drawn."""
    at = range(int(draw.integers(every)), len(words), every)
    return [f"new{draw.integers(1 << 40)}" if i in at else w for i, w in enumerate(words)]


@pytest.mark.parametrize("every", [40, 60])
def test_changed_passages_are_found(spark, every):
    draw = np.random.default_rng(every)

    def own(n):
        return [f"own{draw.integers(1 << 40)}" for _ in range(n)]

    rows, pairs, group = [], 100, own(150)
    for i in range(pairs):
        shared = own(200)
        rows.append((i, " ".join(own(30) + shared + own(30))))
        rows.append((1000 + i, " ".join(own(20) + changed(shared, draw, every) + own(40))))
    rows += [(2000 + i, " ".join(own(10) + (changed(group, draw, every) if i else group) + own(10))) for i in range(300)]
    clean = [(3000 + i, " ".join(own(120))) for i in range(100)]
    # Too many words have changed, and 35 equal words are no passage.
    half = own(200)
    clean += [(4000 + i, " ".join(changed(half, draw, 6))) for i in range(20)]
    clean += [(5000 + i, " ".join(own(40) + half[:35] + own(40))) for i in range(20)]
    docs = spark.createDataFrame(rows + clean, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r for r in near_passages.without_similar_passages(docs).collect()}
    texts = dict(rows + clean)
    assert len(found) == len(texts)
    assert all(not found[d].n_dropped and found[d].text == texts[d] for d, _ in clean)
    assert all(not found[i].n_dropped for i in range(pairs)) and not found[2000].n_dropped
    caught = [found[1000 + i].n_dropped for i in range(pairs)] + [found[2000 + i].n_dropped for i in range(1, 300)]
    assert np.mean([n >= 50 for n in caught]) >= 0.95
    # Words next to the passage stay.
    assert max(caught[:pairs]) <= 200 and max(caught[pairs:]) <= 150
    # With 59 equal words between two changes these go first, and pieces beside them are too short.
    assert np.mean(caught[:pairs]) > 0.75 * 200


def alike_by_brute_force(rows, passage=passage_dedup.PASSAGE):
    """Of each doc_id, whether a passage is alike to one of a smaller doc_id."""
    length, found, seen = passage - near_passages.TOKEN + 1, {}, []
    for doc, text in rows:
        words = text.split()
        tokens = [tuple(words[i : i + near_passages.TOKEN]) for i in range(len(words) - near_passages.TOKEN + 1)]
        own = [set(tokens[i : i + length]) for i in range(len(tokens) - length + 1)]
        found[doc] = any(len(a & b) >= near_passages.ALIKE * len(a | b) for a in own for b in seen)
        seen += own
    return found


def test_no_alike_passage_is_left_out(spark):
    """The fewest words with one changed, left out or put in, anywhere."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(150):
        own = [f"own{draw.integers(1 << 40)}" for _ in range(51)]
        at = int(draw.integers(2, 49))
        other = [own[:at] + ["new"] + own[at + 1 :], own[:at] + own[at + 1 :], own[:at] + ["new"] + own[at:]][i % 3]
        more = [[f"more{i}x{j}x{k}" for k in range(20)] for j in range(4)]
        rows += [(i, more[0] + own + more[1]), (1000 + i, more[2] + other + more[3])]
    rows = sorted((i, " ".join(words)) for i, words in rows)
    expected = {d for pair in range(150) for d, alike in alike_by_brute_force([r for r in rows if r[0] % 1000 == pair]).items() if alike}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id for r in near_passages.without_similar_passages(docs).collect() if r.n_near}
    assert len(expected) >= 100 and found == expected


@pytest.mark.parametrize("copies", [3, 40])
def test_alike_passages_of_a_group_whose_first_is_alike_to_neither(spark, copies):
    """A phrase of 30 words that many share; two families go on alike behind it, the first does not."""
    draw = np.random.default_rng(copies)

    def own(n):
        return [f"own{draw.integers(1 << 40)}" for _ in range(n)]

    phrase, behind = own(30), [own(30), own(30)]
    rows = [(0, own(20) + phrase + own(40))]
    for i in range(1, copies):
        more = list(behind[i % 2])
        more[int(draw.integers(3, 19))] = f"new{i}"
        rows.append((i, own(20) + phrase + (own(30) if i % 5 == 4 else more) + own(10)))
    rows = [(i, " ".join(words)) for i, words in rows]
    again = rows[1][1].replace("new1", "new").split()[20:-10]
    rows.append((copies, " ".join(own(20) + again + own(10))))
    expected = {d for d, alike in alike_by_brute_force(rows).items() if alike}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id for r in near_passages.without_similar_passages(docs).collect() if r.n_near}
    assert copies in expected and found == expected


def test_rarest_tokens():
    draw = np.random.default_rng(12)
    tokens, counts = draw.permutation(1000)[:80].astype(np.int32), draw.integers(1, 5, 80)
    rare = near_passages.rarest_of(tokens, counts, 46)
    for i in range(35):
        own = sorted(range(i, i + 46), key=lambda k: (counts[k], tokens[k]))[:6]
        assert set(np.flatnonzero(rare[i]).tolist()) == set(own)


def test_exact_repeats_go_as_before(spark, odd):
    draw = np.random.default_rng(8)
    shared = [f"w{draw.integers(1000)}" for _ in range(90)]
    more = [(500 + i, " ".join([f"own{i}x{k}" for k in range(30)] + shared[a:b])) for i, (a, b) in enumerate([(0, 50), (20, 90), (0, 90)])]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = [tuple(r) for r in docs.collect()]
    left = near_passages.without_similar_passages(docs).collect()
    # Near copies of the table have one word more each; all others are as by equal passages.
    expected = Counter((d, n, gone) for d, n, gone, _ in brute.dedup_passages(rows, passage_dedup.PASSAGE))
    assert Counter((r.doc_id, r.n_words, r.n_dropped - r.n_near) for r in left) == expected
    texts = dict(rows)
    assert all(r.text == (texts[r.doc_id] or "") for r in left if not r.n_dropped and r.doc_id not in (None, 5))
    assert all(r.n_words - r.n_dropped == len(brute.words(r.text)) for r in left)
    again = near_passages.without_similar_passages(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.n_words, r.n_dropped, r.n_near, r.text)
    assert Counter(map(key, left)) == Counter(map(key, again))


def test_a_long_text_of_few_words(spark):
    long = ["same words here", "aa " * 40 + "b"] * 20000
    draw = np.random.default_rng(6)
    rows = [(1, " ".join(long[:2] * 2000)), (2, " ".join(f"w{draw.integers(300)}" for _ in range(300000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_passages.without_similar_passages(docs).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in found) == [(1, 0), (2, 0)]


def test_no_rows(empty):
    assert near_passages.without_similar_passages(empty).count() == 0
