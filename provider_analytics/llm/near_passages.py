"""Removal of passages that repeat across documents with changed words, by compact windows.

What repeats word by word goes first (``passage_dedup``). Of what is left, a passage is
``PASSAGE`` words, its tokens are its runs of five words, and two passages are alike if
their tokens have a Jaccard similarity of 0.8 or more.

Of 46 tokens alike passages share 41 or more. Both are then made up of two runs of tokens
with something changed between, before or behind them, and the longer run holds half of the
41, a part (``part_of``). So every part gets a signature, and alike passages have an equal
one: for each of two hash functions the nodes of a Cartesian tree over the hashes of a
document's tokens are its compact windows: (l, c, r), where the token c has the least hash
of all parts within l to r that hold it. A join of the intervals of the two functions gives
the parts that share both least hashes, and the pair of them is the signature. (More than
two runs need 41 shared tokens with two breaks of five tokens in all, which takes passages
that repeat two words in a row just there; these may be missed.)

Regions with one signature, and what of a passage is around them, are compared with all
earlier ones by doc_id, passage by passage and token by token; the words of passages found
alike go, but for those before the first and behind the last token that both have.

Where more than ``FEW`` regions share a signature they are compared with the first by
doc_id. Passages that are not alike to it are compared with the earlier regions that hold
one of their six rarest tokens among those of a passage: alike passages have such a token
in common, since no more than five are not shared. So regions that share a phrase within
other words make no pairs, however many they are, and no alike ones are lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passage_dedup
from .common import Passing, staged
from .passage_dedup import PASSAGE, RUN

#: Words of a token, and the similarity of alike passages.
TOKEN = 5
ALIKE = 0.8
#: Hash functions; a signature takes two of them.
SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
PAIRS = ((0, 1), (2, 3))
#: Regions with one signature that are compared each with each.
FEW = 12
#: Pairs of regions that are compared at once.
PAIRS_AT_ONCE = 1024
#: Words whose windows are found at once.
AT_ONCE = 1 << 19


def windows_of(values: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """l, c, r and the value at c of the compact windows of ``length`` tokens or more, by c.
    ``values`` are several documents' hashes with a zero before, between and behind them.

    The tree's nodes as wide as that are just the tokens that are the least of some
    ``length`` in a row, and the nodes above them are such, too. Of equal tokens that are
    the least of one window the first is its c.
    """
    least = passage_dedup.least_of_runs(values, length)
    edge = np.zeros(length - 1, np.uint64)
    covering = ~passage_dedup.least_of_runs(~np.concatenate([edge, least, edge]), length)
    at = np.flatnonzero((covering == values) | (values == 0))
    found = values[at]
    inner = np.flatnonzero(found)
    sides = []
    for step in (-1, 1):
        # The next smaller node on this side: pass over to where a larger one points.
        side = np.arange(len(at)) + step
        todo = inner
        while len(todo := todo[found[side[todo]] >= found[todo]]):
            side[todo] = side[side[todo]]
        sides.append(side)
    left, right = (side[inner] for side in sides)
    _, first = np.unique(left * len(at) + right, return_index=True)
    first.sort()
    return at[left[first]] + 1, at[inner[first]], at[right[first]] - 1, found[inner[first]]


def joined(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, ...]:
    """Signature, from, to and c of the regions in which passages of ``length`` tokens hold
    the c of a window of ``a`` and of one of ``b`` within both windows."""
    (la, ca, ra, va), (lb, cb, rb, vb) = a, b
    begins = np.searchsorted(cb, np.maximum(la, ca - length + 1))
    counts = np.searchsorted(cb, np.minimum(ra, ca + length - 1), "right") - begins
    i = np.repeat(np.arange(len(ca)), counts)
    j = np.arange(len(i)) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    first, last = np.minimum(ca[i], cb[j]), np.maximum(ca[i], cb[j])
    begin = np.maximum(np.maximum(la[i], lb[j]), last - length + 1)
    end = np.minimum(np.minimum(ra[i], rb[j]), first + length - 1)
    held = (begin <= first) & (last <= end) & (end - begin + 1 >= length)
    i, j, begin, end = i[held], j[held], begin[held], end[held]
    return passage_dedup.mixed(va[i] * np.uint64(SEEDS[0]) + vb[j]), begin, end, ca[i]


def shared_by_alike(length: int) -> int:
    """How many of ``length`` tokens alike passages share at least."""
    return math.ceil(2 * ALIKE * length / (1 + ALIKE))


def part_of(passage: int) -> int:
    """Words of the longer of two runs of tokens that alike passages share at least."""
    return (shared_by_alike(passage - TOKEN + 1) + 1) // 2 + TOKEN - 1


def regions_of(
    documents: list[np.ndarray], passage: int = PASSAGE, pairs: tuple[tuple[int, int], ...] = PAIRS, least: int = 0
) -> tuple[np.ndarray, ...]:
    """Of documents as hashes of words, those of ``least`` words or more: all tokens, then
    document, signature, from, to (places in all tokens), place of the document's first token
    and c of each region."""
    length = passage - TOKEN + 1
    long = [i for i, words in enumerate(documents) if len(words) >= max(passage, least)]
    zero = np.zeros(1, np.uint64)
    parts, begins, at = [zero], [], 1
    for i in long:
        tokens = passage_dedup.hashes_of_runs(documents[i], TOKEN, passage_dedup.BASES[0])
        begins.append(at)
        parts += [tokens, zero]
        at += len(tokens) + 1
    tokens = np.concatenate(parts)
    if not long:
        return (tokens, *(np.empty(0, np.int64) for _ in range(6)))
    gaps = np.append(np.array(begins) - 1, len(tokens) - 1)
    trees = {}
    for k in sorted({k for pair in pairs for k in pair}):
        values = passage_dedup.mixed(tokens ^ np.uint64(SEEDS[k])) | np.uint64(1)
        values[gaps] = 0
        trees[k] = windows_of(values, length)
    found = [joined(trees[f], trees[g], length) for f, g in pairs]
    signature, begin, end, c = (np.concatenate(columns) for columns in zip(*found, strict=True))
    which = np.searchsorted(gaps, begin) - 1
    return tokens, np.array(long)[which], signature, begin, end, np.array(begins)[which], c


def alike_passages(
    own: np.ndarray, own_at: np.ndarray, other: np.ndarray, other_at: np.ndarray, shift: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of regions, whose tokens follow one another in ``own`` and ``other`` from the
    offsets on: whether the passage of ``length`` tokens from a token of ``own`` on is alike to
    one of the other region, and the token's place there, -1 without one.

    Token for token, the passages stand ``shift`` places on in the other region; as many
    places before and behind that are tried as an alike passage may have tokens of its own.
    """
    sizes, others = np.diff(own_at), np.diff(other_at)
    pair, pair_of_other = (np.repeat(np.arange(len(shift)), n) for n in (sizes, others))
    at, at_other = np.arange(len(own)) - own_at[pair], np.arange(len(other)) - other_at[pair_of_other]

    def numbers(pairs, tokens, places):
        return (pairs << 32 | tokens.astype(np.int32).view(np.uint32).astype(np.int64)) << 12 | places

    # Of equal tokens that which is nearest to where it is expected.
    order = np.sort(numbers(pair_of_other, other, at_other))
    wanted = numbers(pair, own, np.clip(at + shift[pair], 0, others[pair] - 1))
    spot = np.searchsorted(order, wanted)
    behind, before = order[np.minimum(spot, len(order) - 1)], order[np.maximum(spot, 1) - 1]
    far = 1 << 12
    gaps = [np.where(found >> 12 == wanted >> 12, np.abs(found - wanted), far) for found in (behind, before)]
    place = np.where(gaps[1] < gaps[0], before, behind) & (far - 1)
    place = np.where(np.minimum(*gaps) < far, place, -1).astype(np.int16)

    least = shared_by_alike(length)
    alike = np.zeros(len(own), bool)
    begins = np.flatnonzero(at <= sizes[pair] - length)
    held = np.concatenate([[0], np.cumsum(place >= 0)])
    may = begins[held[begins + length] - held[begins] >= least]
    for k in range(2 * (length - least) + 1):
        if not len(may):
            break
        off = (k + 1) // 2 * (1 if k % 2 else -1)
        first = np.clip(at[may] + shift[pair[may]] + off, 0, others[pair[may]] - length).astype(np.int16)[:, None]
        places = np.lib.stride_tricks.sliding_window_view(place, length)[may]
        enough = ((places >= first) & (places < first + length)).sum(1) >= least
        alike[may[enough]] = True
        may = may[~enough]
    return alike, place


def ranges_of(alike: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """From and number of words of ranges that are made up of alike passages. A range begins
    and ends with a token that both have."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], alike, [False]]).astype(np.int8)))
    shared = np.flatnonzero(place >= 0)
    first = shared[np.searchsorted(shared, edges[::2])]
    last = shared[np.searchsorted(shared, edges[1::2] + length - 2, "right") - 1]
    return first, last - first + TOKEN


def alike_ranges(own: np.ndarray, other: np.ndarray, shift: int, length: int) -> list[tuple[int, int]]:
    """``ranges_of`` of ``alike_passages`` for one pair of regions."""
    ends = [np.array([0, len(tokens)]) for tokens in (own, other)]
    found = ranges_of(*alike_passages(own, ends[0], other, ends[1], np.array([shift]), length), length)
    return list(zip(*(x.tolist() for x in found), strict=True))


def rarest_of(tokens: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Which tokens are among the rarest of each passage: as many as an alike passage may have
    of its own, and one more. A row per passage, a column per token."""
    order = np.lexsort([tokens, counts])
    rank = np.empty(len(tokens), np.int64)
    rank[order] = np.arange(len(tokens))
    ranks = np.lib.stride_tricks.sliding_window_view(rank, length)
    most = length - shared_by_alike(length)
    limit = np.partition(ranks, most, axis=1)[:, most]
    found = np.zeros((len(ranks), len(tokens)), bool)
    passage, at = np.nonzero(ranks <= limit[:, None])
    found[passage, passage + at] = True
    return found


def _in_parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The batch's documents as hashes of the words left, some at a time."""
    part, size, first = [], 0, 0
    for i, (stored, goes) in enumerate(zip(batch.column("words").to_pylist(), batch.column("goes").to_pylist(), strict=True)):
        words = passage_dedup.words_in(stored)
        part.append(words[passage_dedup.left_of(len(words), goes)] if goes else words)
        size += len(part[-1])
        if size >= AT_ONCE:
            yield first, part
            part, size, first = [], 0, i + 1
    if part:
        yield first, part


def compared(pairs: DataFrame, length: int) -> DataFrame:
    """region, place, ``near``, the ranges of words in passages alike to one of the other
    region, and ``open``, the passages of the region that are not."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, PAIRS_AT_ONCE):
                batch = whole.slice(i, PAIRS_AT_ONCE)
                (own, own_at), (other, other_at) = (
                    (c.flatten().to_numpy(), np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())]))
                    for c in (batch.column("tokens"), batch.column("first"))
                )
                shift = batch.column("c_first").to_numpy().astype(np.int64) - batch.column("c").to_numpy()
                alike, place = alike_passages(own, own_at, other, other_at, shift, length)
                first, n = ranges_of(alike, place, length)
                pair = np.searchsorted(own_at, first, "right") - 1
                at = first - own_at[pair] + batch.column("at").to_numpy()[pair]
                near = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(n, pa.int32())], names=["at", "n"])
                near = pa.ListArray.from_arrays(pa.array(np.searchsorted(first, own_at), pa.int32()), near)
                begin = np.arange(len(own)) - np.repeat(own_at[:-1], np.diff(own_at))
                left = np.flatnonzero(~alike & (begin <= np.repeat(np.diff(own_at), np.diff(own_at)) - length))
                ends = pa.array(np.searchsorted(left, own_at), pa.int32())
                left = pa.ListArray.from_arrays(ends, pa.array(begin[left], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("region"), batch.column("place"), near, left], names=["region", "place", "near", "open"]
                )

    columns = pairs.select("region", "place", "at", "c", "tokens", "c_first", "first")
    return columns.mapInArrow(each, "region bigint, place bigint, near array<struct<at:int,n:int>>, open array<int>")


def near_ranges(regions: DataFrame, length: int, passing: Passing) -> DataFrame:
    """place, at and n of the words of ``regions`` (region, place, signature, at, c, tokens)
    in passages alike to one of an earlier region with the same signature. Tables of
    ``passing`` are read by the result."""
    groups = regions.groupBy("signature").agg(
        F.min("place").alias("stays"), F.max("place").alias("last"), F.count(F.lit(1)).alias("regions")
    )
    groups = passing.staged(groups.where("stays <> last").drop("last"), "region_groups")
    earlier = [F.col("place").alias("earlier"), F.col("c").alias("c_first"), F.col("tokens").alias("first")]

    few = regions.join(groups.where(F.col("regions") <= FEW).select("signature"), "signature")
    # Gathered rather than joined with themselves: regions are shuffled once.
    few = few.groupBy("signature").agg(F.collect_list(F.struct("region", "place", "at", "c", "tokens")).alias("group"))
    few = few.select("group", F.explode("group").alias("own"))
    some = few.select("own", F.explode(F.filter("group", lambda other: other["place"] < F.col("own")["place"])).alias("other"))
    some = some.select("own.*", F.col("other.c").alias("c_first"), F.col("other.tokens").alias("first"))

    many = regions.join(groups.where(F.col("regions") > FEW).drop("regions"), "signature")
    many = passing.staged(many, "hot_regions")
    first = many.where("place = stays").select("signature", *earlier)
    later = many.where("place <> stays").drop("stays")
    by_first = passing.staged(compared(later.join(first, "signature"), length), "near_first")

    # What is not alike to the first: pairs of regions by their passages' rarest tokens.
    cells = later.select("region", "signature", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = cells.groupBy("signature", "token").agg(F.count(F.lit(1)).cast("int").alias("n")).where("n > 1")
    counted = cells.join(passing.staged(counts, "hot_tokens"), ["signature", "token"])
    counted = counted.groupBy("region").agg(F.collect_list(F.struct("token", "n")).alias("counts"))
    still = by_first.groupBy("region").agg(F.min_by("open", F.size("open")).alias("open"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, regions_, token, asks = batch.column("tokens"), [], [], []
            for i, (left, known) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("open", "counts")), strict=True)):
                tokens, number = own[i].values.to_numpy(), {c["token"]: c["n"] for c in known}
                n = np.array([number.get(t, 1) for t in tokens.tolist()])
                rare = rarest_of(tokens, n, length) & (n > 1)
                asking = set(tokens[rare[left].any(0)].tolist())
                held = set(tokens[rare.any(0)].tolist())
                regions_ += [i] * len(held)
                token += held
                asks += [t in asking for t in held]
            own = [batch.column(k).take(pa.array(regions_, pa.int64())) for k in ("region", "place", "signature")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(token, pa.int32()), pa.array(asks, pa.bool_())], names=["region", "place", "signature", "token", "asks"]
            )

    keys = later.join(still, "region").join(counted, "region").select("region", "place", "signature", "tokens", "open", "counts")
    keys = keys.mapInArrow(keyed, "region bigint, place bigint, signature bigint, token int, asks boolean")
    keys = passing.staged(keys, "hot_keys")
    others = keys.select("signature", "token", F.col("region").alias("other"), F.col("place").alias("earlier"))
    met = keys.where("asks").drop("asks").join(others, ["signature", "token"]).where("place > earlier")
    met = met.select("region", "other").distinct()
    met = met.join(later, "region").join(later.select(F.col("region").alias("other"), *earlier), "other")

    found = compared(some, length).unionByName(by_first).unionByName(compared(met, length))
    return found.select("place", F.explode("near").alias("range")).select("place", "range.at", "range.n")


def without_similar_passages(docs: DataFrame, passage: int = PASSAGE, run: int = RUN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, the text
    that is left, n_words before, n_dropped, and n_near, those of them that are not in a
    passage repeated word by word.

    Everything of ``without_repeated_passages`` holds: which document of a group keeps its
    passage, how words are compared, nulls, repeated rows and empty tables. Passages with
    changed words are looked for in what is left by it, so its result is part of this one;
    passages alike within one document alone stay.
    """
    rows, order, goes = passage_dedup.repeated_passages(docs, passage, run)
    length, half = passage - TOKEN + 1, part_of(passage)
    around = passage - half
    left = rows.join(goes, "row", "left")
    passing = Passing(docs.sparkSession)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for first, part in _in_parts(batch):
                _, which, signature, *_ = regions_of(part, half, PAIRS[:1], passage)
                order = np.lexsort([signature, which])
                which, signature = which[order], signature[order]
                new = np.append(True, (which[1:] != which[:-1]) | (signature[1:] != signature[:-1]))[: len(which)]
                found = [pa.array(numbers[which[new] + first], pa.int64()), pa.array(signature[new].astype(np.uint64).view(np.int64))]
                yield pa.RecordBatch.from_arrays(found, names=["row", "signature"])

    signatures = left.select("row", "words", "goes").mapInArrow(signed, "row bigint, signature bigint")
    signatures = passing.staged(signatures, "signatures")
    shared = signatures.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("signature")
    some = signatures.join(passing.staged(shared, "shared_signatures"), "signature")
    some = some.groupBy("row").agg(F.collect_list("signature").alias("signatures"))
    some = passing.staged(some.join(order, "row"), "signed_rows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "signature", "at", "c", "tokens"]
        for batch in batches:
            places, wanted = batch.column("place").to_numpy(), batch.column("signatures").to_pylist()
            for first, part in _in_parts(batch):
                tokens, which, signature, begin, end, start, c = regions_of(part, half, PAIRS[:1], passage)
                own = [np.array(w, np.int64).view(np.uint64) for w in wanted[first : first + len(part)]]
                by = np.argsort(which, kind="stable")
                edges = np.searchsorted(which, np.arange(len(part) + 1), sorter=by)
                each = [by[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                held = [e[np.isin(signature[e], w)] for e, w in zip(each, own, strict=True)]
                held = np.concatenate([*held, np.empty(0, np.int64)]).astype(np.int64)
                # With what belongs to passages that hold a part of the region.
                after = start[held] + np.array([len(words) for words in part])[which[held]] - TOKEN
                begin, end = np.maximum(begin[held] - around, start[held]), np.minimum(end[held] + around, after)
                offsets = np.concatenate([[0], np.cumsum(end - begin + 1)]).astype(np.int32)
                inside = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], end - begin + 1)
                cells = tokens[inside].astype(np.uint32).view(np.int32)
                found = [
                    pa.array(places[which[held] + first], pa.int64()),
                    pa.array(signature[held].astype(np.uint64).view(np.int64)),
                    pa.array(begin - start[held], pa.int32()),
                    pa.array(c[held] - begin, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells)),
                ]
                yield pa.RecordBatch.from_arrays(found, names=names)

    signed_rows = left.join(some, "row").select("place", "words", "goes", "signatures")
    regions = signed_rows.mapInArrow(cut, "place bigint, signature bigint, at int, c int, tokens array<int>")
    # What regions are compared by is kept until the last of them, the signatures until here.
    compared_by = Passing(docs.sparkSession)
    regions = compared_by.staged(regions.withColumn("region", F.monotonically_increasing_id()), "regions")
    passing.drop()
    near = near_ranges(regions, length, compared_by)
    near = near.groupBy("place").agg(F.collect_set(F.struct("at", "n")).alias("near"))
    near = staged(near.join(order, "place").select("row", "near"), "near-passages")
    compared_by.drop()

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, n, equal, alike in zip(*(batch.column(k).to_pylist() for k in ("text", "n", "goes", "near")), strict=True):
                stays = passage_dedup.left_of(n, equal)
                after_equal = int(stays.sum())
                if alike:
                    stays[stays] = passage_dedup.left_of(after_equal, alike)
                texts.append(passage_dedup.without(text, ~stays) if equal or alike else text or "")
                counts.append((n, n - int(stays.sum()), after_equal - int(stays.sum())))
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), *numbers],
                names=["doc_id", "text", "n_words", "n_dropped", "n_near"],
            )

    both = left.join(near, "row", "left").select("doc_id", "text", "n", "goes", "near")
    return both.mapInArrow(rebuilt, "doc_id bigint, text string, n_words bigint, n_dropped bigint, n_near bigint")
