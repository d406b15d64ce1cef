"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut into words by a pattern. A word's bytes are the first pieces; a fold over
them joins, step by step, the neighbours whose joined bytes have the lowest rank, as
looked up in a literal rank map, until no neighbours have one. Pieces are written as
hexadecimal digits, since map keys cannot be binary.

Distinct words are folded: the most frequent ones once each, ahead, into a table of bounded size that every task gets; of the others a document's distinct ones,
once a document. Texts are cut and folded in the JVM; between the two an Arrow function
looks words up in the table, a batch at a time. Which words are folded ahead decides the
cost, never the ids, so nothing but the counting of words is shuffled.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, frequent, staged

#: White space as Unicode defines it; Java's own class is smaller.
SPACE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Words folded ahead at most, and the longest of them in bytes: at 13 bytes and three ids
#: a word, as measured, some 32 MB; 260 MB if every word is as long as it may be.
AHEAD = 1 << 20
AHEAD_BYTES = 48
#: Factors of a word's bytes by their place, whose sum is the word's hash.
MULTIPLIERS = np.random.default_rng(1).integers(1, 1 << 64, AHEAD_BYTES, np.uint64)
#: Words of more bytes join all places of the lowest pair in one step.
LONG = 64
#: A literal map is searched from its start, so it is dealt to this many small ones, of
#: some four entries each: more of them would take the driver's memory.
RANK_MAPS = 1 << 14
#: Words of an Arrow batch that are worked on at once, beyond those of one document.
AT_ONCE = 1 << 18
#: In the state of a fold: a pair without a rank, and a byte within a piece.
NO_RANK = 1 << 20
GONE = 1 << 62


def ranks_of(path: str) -> dict[bytes, int]:
    """The ranks in a file of lines ``base64 rank``, read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def java_pattern(pattern: str) -> str:
    """The word pattern with white space spelled out."""
    parts = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"(?!\S)", f"(?![^{SPACE}])")
    return parts.replace(r"\s", f"[{SPACE}]")


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value taken once, however often ``use`` names it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda same, _: same, use)


def rank_map(ranks: Mapping[bytes, int]) -> Column:
    """Ranks by hexadecimal digits, as a literal array of small maps dealt by CRC-32."""
    dealt: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        dealt[zlib.crc32(key.encode()) % RANK_MAPS][key] = rank
    return F.from_json(F.lit(json.dumps(dealt, separators=(",", ":"))), "array<map<string,int>>")


def _rank(ranks: Column, piece: Column) -> Column:
    """The rank of ``piece`` in a ``rank_map``, null if there is none."""
    return F.try_element_at(F.get(ranks, (F.crc32(piece) % RANK_MAPS).cast("int")), piece)


def _fold_short(digits: Column, ranks: Column) -> Column:
    """The pieces of a word of two to ``LONG`` bytes. The state has a number for each byte
    that begins a piece: from the top the rank of the piece with its neighbour, the place,
    the length and the place of the piece before. So the least number is the leftmost
    pair of the lowest rank; a step joins it and looks up the two pairs that this makes."""
    n = (F.length(digits) / 2).cast("int")
    twelve = F.lit(4095)

    def length(number: Column) -> Column:
        return F.shiftright(number, 12).bitwiseAND(twelve).cast("int")

    def piece(place: Column, size: Column) -> Column:
        return F.substring(digits, 2 * place + 1, 2 * size)

    def top(rank: Column) -> Column:
        return F.shiftleft(F.coalesce(rank, F.lit(NO_RANK)).cast("bigint"), 36)

    def first(i: Column) -> Column:
        rank = F.when(i + 1 < n, _rank(ranks, piece(i, F.lit(2))))
        return top(rank) + F.shiftleft(i.cast("bigint"), 24) + 4096 + F.greatest(i - 1, F.lit(0))

    def step(state: Column, _: Column) -> Column:
        def join(least: Column) -> Column:
            place = F.shiftright(least, 24).bitwiseAND(twelve).cast("int")
            before = least.bitwiseAND(twelve).cast("int")
            return bound(
                place,
                lambda p: bound(
                    p + length(least),
                    lambda q: bound(q + length(F.get(state, q)), lambda r: bound(before, lambda b: put(p, q, r, b))),
                ),
            )

        def put(p: Column, q: Column, r: Column, b: Column) -> Column:
            """Join the pieces at p and q; r is the place behind them, b the one before."""

            def new(x: Column, i: Column) -> Column:
                right = F.when(r < n, _rank(ranks, piece(p, r - p + length(F.get(state, r)))))
                joined = top(right) + F.shiftleft(p.cast("bigint"), 24) + F.shiftleft(r - p, 12) + b
                left = top(_rank(ranks, piece(b, r - b))) + x.bitwiseAND(F.lit((1 << 36) - 1))
                return (
                    F.when((i < b) | (i > r), x)
                    .when(i == p, joined)
                    .when(i == q, F.lit(GONE))
                    .when(i == b, left)
                    .when(i == r, x - q + p)
                    .otherwise(x)
                )

            return F.transform(state, new)

        return bound(F.array_min(state), lambda least: F.when(least >= NO_RANK << 36, state).otherwise(join(least)))

    last = F.aggregate(F.sequence(F.lit(1), n - 1), F.transform(F.sequence(F.lit(0), n - 1), first), step)
    left = F.filter(last, lambda x: x < GONE)
    return F.transform(left, lambda x: piece(F.shiftright(x, 24).bitwiseAND(twelve).cast("int"), length(x)))


def _join_all(pieces: Column, ranks: Column) -> Column:
    """Join all pairs of the lowest rank, from the left where they overlap."""

    def joined(of_pairs: Column, lowest: Column) -> Column:
        # x: a pair begins; o: its second half; -: a piece that stays.
        marks = F.array_join(F.transform(of_pairs, lambda r: F.when(r == lowest, "x").otherwise("-")), "")
        marks = F.split(F.regexp_replace(F.concat(marks, F.lit("-")), "x.", "xo"), "")
        new = F.transform(
            F.arrays_zip(marks.alias("mark"), F.sequence(F.lit(0), F.size(pieces) - 1).alias("i")),
            lambda p: F.when(p["mark"] == "x", F.concat(F.get(pieces, p["i"]), F.get(pieces, p["i"] + 1))).when(p["mark"] == "-", F.get(pieces, p["i"])),
        )
        return F.when(lowest.isNotNull(), F.filter(new, lambda piece: piece.isNotNull()))

    of_pairs = F.transform(F.sequence(F.lit(0), F.size(pieces) - 2), lambda i: _rank(ranks, F.concat(F.get(pieces, i), F.get(pieces, i + 1))))
    return bound(of_pairs, lambda r: bound(F.array_min(r), lambda lowest: joined(r, lowest)))


def _fold_long(digits: Column, ranks: Column) -> Column:
    """As ``_fold_short``, for words so long that a step for each pair would be too many."""
    n = (F.length(digits) / 2).cast("int")
    first = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(digits, 2 * i + 1, F.lit(2)))
    start = F.struct(first.alias("pieces"), F.lit(True).alias("open"))

    def step(state: Column, _: Column) -> Column:
        def after(new: Column) -> Column:
            pieces = F.coalesce(new, state["pieces"])
            return F.struct(pieces.alias("pieces"), (new.isNotNull() & (F.size(new) > 1)).alias("open"))

        return F.when(state["open"], bound(_join_all(state["pieces"], ranks), after)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), n - 1), start, step, lambda state: state["pieces"])


def word_ids(word: Column, ranks: Column) -> Column:
    """array<int>: a word that has a rank is one id; others are folded."""

    def ids(digits: Column) -> Column:
        short = F.length(digits) <= 2 * LONG
        pieces = F.when(short, _fold_short(digits, ranks)).otherwise(_fold_long(digits, ranks))
        return bound(
            _rank(ranks, digits),
            lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(
                F.transform(pieces, lambda piece: _rank(ranks, piece))
            ),
        )

    return bound(F.hex(word.cast("binary")), ids)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pc.value_counts(batch.column(0).flatten())
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])


def _words_ahead(docs: DataFrame, ranks: Column, pattern: str, ahead: int) -> pa.Table:
    """word, ids of the most frequent words. At most ``ahead`` words come to the driver."""
    parts = docs.select(words(F.col("text"), pattern)).mapInArrow(_counted, "word string, n bigint")
    counts = parts.groupBy("word").agg(F.sum("n").alias("n"))
    counts = staged(counts.where(F.octet_length("word") <= AHEAD_BYTES), "word-counts")
    ids = bound(ranks, lambda r: word_ids(F.col("word"), r))
    return frequent(counts, ahead).select("word", ids.alias("ids")).toArrow()


def _hashes(short: pa.Array) -> np.ndarray:
    """64-bit hashes of words of ``AHEAD_BYTES`` at most."""
    if not len(short):
        return np.empty(0, np.uint64)
    ends = np.frombuffer(short.buffers()[1], np.int32)[short.offset : short.offset + len(short) + 1]
    letters = np.frombuffer(short.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    ends = ends - ends[0]
    letters += np.uint64(1)
    letters *= MULTIPLIERS[np.arange(len(letters)) - np.repeat(ends[:-1], np.diff(ends))]
    sums = np.append(np.uint64(0), np.cumsum(letters))
    return sums[ends[1:]] - sums[ends[:-1]]


class Ready:
    """Words with their ids, in the order of the words' hashes. Of words with equal hashes
    only one is held, the others are folded where they stand."""

    def __init__(self, table: pa.Table):
        words = table["word"].cast(pa.string()).combine_chunks()
        parts = [_hashes(words.slice(at, AT_ONCE)) for at in range(0, len(words), AT_ONCE)]
        self.hashes, first = np.unique(np.concatenate([np.empty(0, np.uint64), *parts]), return_index=True)
        self.words = words.take(pa.array(first))
        ids = table["ids"].combine_chunks().take(pa.array(first))
        of_each = ids.value_lengths().to_numpy(zero_copy_only=False)
        self.ends = np.append(0, np.cumsum(of_each)).astype(np.int32)
        self.ids = ids.flatten().to_numpy(zero_copy_only=False)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the words stand, -1 for those that are not held."""
        found = np.full(len(words), -1, np.int32)
        short = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) <= AHEAD_BYTES)
        if not len(self.words) or not len(short):
            return found
        hashes = _hashes(words.take(pa.array(short)))
        order = np.argsort(hashes)  # neighbours are found from each other
        short, hashes = short[order], hashes[order]
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.words) - 1)
        hit = self.hashes[place] == hashes
        short, place = short[hit], place[hit]
        asked = words.take(pa.array(short))
        equal = pc.equal(self.words.take(pa.array(place)), asked).to_numpy(zero_copy_only=False)
        found[short[equal]] = place[equal]
        return found


def _looked_up(ready: Broadcast) -> Callable[[Column], Column]:
    """A function from a document's words to a struct: ``new``, its distinct words that
    are not ``ready``; ``which``, their numbers in the order they stand; and ``known``, the
    ids of the words before the first of them, between them, and behind the last.

    Memory goes by ``AT_ONCE`` words, or those of the longest document if they are more."""
    schema = "struct<known: array<array<int>>, which: array<int>, new: array<string>>"

    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = ready.value
        for batch in batches:
            n_words = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            # Documents at once: those whose last words fall in the same AT_ONCE words.
            parts = np.cumsum(n_words, dtype=np.int64) // AT_ONCE
            starts = np.append(np.flatnonzero(np.diff(parts, prepend=-1)), len(batch))
            for a, b in zip(starts[:-1], starts[1:]):
                yield of_documents(batch.slice(a, b - a), n_words[a:b], held)

    def of_documents(documents: pa.Array, n_words: np.ndarray, held: Ready) -> pa.Array:
        ends = np.append(0, np.cumsum(n_words))  # words before each document
        coded = documents.flatten().dictionary_encode()
        distinct, code = coded.dictionary.cast(pa.string()), coded.indices.to_numpy(zero_copy_only=False)
        place = held.places(distinct)

        # Ids of the known words one after another; a new word has none.
        begin = held.ends[place]
        size = np.where(place < 0, 0, held.ends[place + 1] - begin)[code]
        after = np.append(0, np.cumsum(size, dtype=np.int64))
        at = np.arange(after[-1]) + np.repeat(begin[code] - after[:-1], size)
        ids = held.ids[at].astype(np.int32, copy=False)

        # A piece ends before each new word and at the end of each document.
        at_new = np.flatnonzero((place < 0)[code])
        new_of = np.searchsorted(at_new, ends)  # new words before each document
        cuts = np.sort(np.append(at_new, ends[1:]), kind="stable")
        pieces = pa.ListArray.from_arrays(pa.array(np.append(0, after[cuts]).astype(np.int32)), pa.array(ids))
        known = pa.ListArray.from_arrays(pa.array((new_of + np.arange(len(ends))).astype(np.int32)), pieces)

        # A document's distinct new words, in any order.
        document = np.repeat(np.arange(len(ends) - 1), np.diff(new_of))
        pairs, number = np.unique(document * len(distinct) + code[at_new], return_inverse=True)
        first = np.searchsorted(pairs, np.arange(len(ends)) * len(distinct))
        texts = distinct.take(pa.array(pairs % max(1, len(distinct))))
        which = pa.ListArray.from_arrays(
            pa.array(new_of.astype(np.int32)), pa.array((number - first[document]).astype(np.int32))
        )
        new = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), texts)
        return pa.StructArray.from_arrays([known, which, new], ["known", "which", "new"])

    return F.arrow_udf(look_up, schema)


def encoded(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, ahead: int = AHEAD) -> DataFrame:
    """``docs`` (text and any other columns) with the column ``ids`` array<int> added, in
    place of one it may have.

    Every match of ``pattern`` is encoded by itself, without special tokens. Null and
    empty texts have no ids. Rows that repeat get equal ids; an empty table gives none.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks have gaps or repeat")
    by_piece = rank_map(ranks)
    found = free_name(docs, "found")
    ready = Ready(_words_ahead(docs, by_piece, pattern, ahead))
    look_up = _looked_up(docs.sparkSession.sparkContext.broadcast(ready))
    known, which, new = (F.col(found)[part] for part in ("known", "which", "new"))

    def joined(folded: Column) -> Column:
        def with_new(piece: Column, i: Column) -> Column:
            return F.when(i < F.size(which), F.concat(piece, F.get(folded, F.get(which, i)))).otherwise(piece)

        return F.flatten(F.transform(known, with_new))

    folded = bound(by_piece, lambda r: F.transform(new, lambda word: word_ids(word, r)))
    rows = docs.withColumn(found, look_up(words(F.col("text"), pattern)))
    return rows.withColumn("ids", bound(folded, joined)).drop(found)


def decoded(tokens: DataFrame, ranks: Mapping[bytes, int]) -> DataFrame:
    """``tokens`` (ids and any other columns) with ``decoded`` binary added: the pieces of
    the ids one after another, none for no ids. Null ids give null."""
    pieces = F.split(F.lit(",".join(piece.hex() for piece, _ in sorted(ranks.items(), key=lambda x: x[1]))), ",")

    def joined(literal: Column) -> Column:
        return F.array_join(F.transform(F.col("ids"), lambda i: F.get(literal, i)), "")

    return tokens.withColumn("decoded", F.unhex(bound(pieces, joined)))
