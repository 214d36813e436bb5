"""Spelling variants of the words of a corpus, by Bloom-guided neighbourhoods.

Words are runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case; the vocabulary holds
those of `least_letters` letters and `least_count` occurrences. Two are near if one letter is inserted,
deleted or replaced between them. The form of a word is its near word of the largest count, if that is
`ratio` times its own; its root is where the forms lead.

Neighbours are found from generated edits. Each word's hash is a polynomial over its letters, so that
of an edited word takes one step, whatever its length: every deletion, and every replacement by a
greater letter (the others are met from the other side, as insertions are from the longer word). The
hashes are probed in blocked Bloom filters of the vocabulary, one a word length, which are sent to all
tasks; their size is bounded by FILTER_BYTES, and beyond it only their errors grow. The positives alone
move: they are joined to the vocabulary by hash, and the edit is done on the word itself to see that it
gives the other one. So no error of the filters or hashes is left, and no word is compared with all others.

Null texts and ids: no words, and the empty id. Rows that repeat an id are counted each. Ties of the
count go to the least word in code-point order. Texts and words of any length are taken whole; a
worker counts in a table of bounded size that it hands on when full. An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ship, slices, texts_of
from touchline.sources.scratch import materialize

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
# The filters: bits a word, and a bound on all of them together. Lengths from the last shard on share it.
WORD_BITS, FILTER_BYTES, LAST_SHARD = 16, 1 << 28, 64
_PROBES = 5  # bits of a block that a word sets
_SEGMENT = 13  # 2 ** 13 blocks of 64 bits are sent as one row
# About so many bytes of counted words make a worker hand its counts on.
COUNTED_BYTES = 48 << 20
_WORD_BYTES = 120  # what an entry of the table costs besides its letters

_BASE = 0x9E3779B97F4A7C15  # odd, so that it can be divided by modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)


def count_words(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, spoil: int | None = None,
) -> DataFrame:
    """(word, n): the counts of all words of at least `least_letters` letters.

    With `spoil`, a run loses one letter if `spoil` divides h, the CRC-32 of `<doc_id>:<run>`: the one at
    h modulo its length. So misspellings at a known rate are planted, the same on every run.
    """
    ship()
    runs = re.compile(rb"[A-Za-z\xC0-\xFF]{%d,}" % least_letters)
    rows = df.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc"), F.col(f"`{text}`").alias("text")
    ).where(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        held = 0

        def table() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for doc, one in zip(part.column("doc").to_pylist(), texts_of(part.column("text"))):
                    seed = zlib.crc32(f"{doc}:".encode("utf-8", "replace"))
                    # Of Latin-1 a byte is a code point, and lower() changes A-Z alone.
                    for run, n in Counter(runs.findall(one.encode("latin-1", "replace").lower())).items():
                        if spoil:
                            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                            if h % spoil == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1:]
                                if len(run) < least_letters:
                                    continue
                        before = counts.get(run)
                        if before is None:
                            held += len(run) + _WORD_BYTES
                        counts[run] = n + (before or 0)
                    if held > COUNTED_BYTES:
                        yield table()
                        counts.clear()
                        held = 0
        yield table()

    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- hashes -------------------------------------------------------------------------------


def letter_hashes() -> np.ndarray:
    """A fixed random number for each Latin-1 letter."""
    return np.random.default_rng(23).integers(0, 1 << 64, 256, np.uint64)


def _mixed(h: np.ndarray, lengths) -> np.ndarray:
    """All bits of a polynomial's value and a length, well spread."""
    h = h + np.asarray(lengths, np.uint64) * np.uint64(0xD1B54A32D192ED03)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """The letters of a batch of words in one array, with the polynomial of each word's beginnings.

    A word x has the value of sum(number[x[j]] * base ** j), modulo 2 ** 64.
    """

    def __init__(self, words: list[bytes]) -> None:
        self.number = letter_hashes()
        self.length = np.array([len(word) for word in words], np.int64)
        self.stop = np.cumsum(self.length)
        self.start = self.stop - self.length
        self.letter = np.frombuffer(b"".join(words), np.uint8)
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(self.letter)) - self.start[self.word]
        longest = int(self.length.max(initial=0))
        powers = np.full(longest + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        self.power = powers[self.place]
        terms = self.number[self.letter] * self.power
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.value = self.sums[self.stop] - self.sums[self.start]

    def hashes(self) -> np.ndarray:
        return _mixed(self.value, self.length)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions in the letters, hashes) of the words less one letter; of equal neighbours one goes."""
        first = self.place == 0
        at = np.flatnonzero(first | (self.letter != np.concatenate([self.letter[:1], self.letter[:-1]])))
        own = self.word[at]
        before = self.sums[at] - self.sums[self.start[own]]
        after = self.sums[self.stop[own]] - self.sums[at + 1]
        return at, _mixed(before + after * np.uint64(_INVERSE), self.length[own] - 1)

    def replacements(self, letter: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the words with a smaller letter replaced by this one."""
        at = np.flatnonzero(self.letter < letter)
        own = self.word[at]
        change = (self.number[letter] - self.number[self.letter[at]]) * self.power[at]
        return at, _mixed(self.value[own] + change, self.length[own])


def _with_hashes(counted: DataFrame) -> DataFrame:
    """(word, n, h, length) of a vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word"):
                hashed = Hashed([word.encode("latin-1") for word in part.column("word").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("word"), part.column("n"), pa.array(hashed.hashes().view(np.int64)), pa.array(hashed.length)],
                    ["word", "n", "h", "length"],
                )

    return counted.mapInArrow(run, "word string, n bigint, h bigint, length bigint")


# --- filters ------------------------------------------------------------------------------


class Filters:
    """Blocked Bloom filters by word length: a word sets a few bits of one 64-bit block of its shard."""

    def __init__(self, shards: dict[int, tuple[int, int]], blocks: np.ndarray) -> None:
        self.shards, self.blocks = shards, blocks
        self.first, self.count = np.zeros(LAST_SHARD + 1, np.int64), np.zeros(LAST_SHARD + 1, np.uint64)
        for shard, (first, count) in shards.items():
            self.first[shard], self.count[shard] = first, count

    def hold(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether words of these hashes and lengths may be in the vocabulary."""
        shard = np.minimum(lengths, LAST_SHARD)
        count = self.count[shard]
        found = np.zeros(len(hashes), bool)
        some = np.flatnonzero(count)
        h = hashes[some]
        block = self.first[shard[some]] + (((h >> np.uint64(32)) * count[some]) >> np.uint64(32)).astype(np.int64)
        mask = np.zeros(len(h), np.uint64)
        for probe in range(_PROBES):
            mask |= np.uint64(1) << ((h >> np.uint64(6 * probe)) & np.uint64(63))
        found[some] = (self.blocks[block] & mask) == mask
        return found


def build_filters(vocabulary: DataFrame, most_bytes: int = FILTER_BYTES) -> Filters:
    """The filters of a vocabulary (h, length). Bits are combined by block before they move, and blocks by
    segment; the driver receives at most `most_bytes` of them."""
    shard = F.least(F.col("length"), F.lit(LAST_SHARD)).cast("int")
    sizes = {row.shard: row["count"] for row in vocabulary.groupBy(shard.alias("shard")).count().collect()}
    bits = min(WORD_BITS, most_bytes * 8 / max(1, sum(sizes.values())))
    shards, total = {}, 0
    for one, words in sorted(sizes.items()):  # LAST_SHARD rows at most
        count = max(1, int(words * bits) // 64)
        shards[one] = (total, count)
        total += count
    blocks = np.zeros(total, np.uint64)
    if not total:
        return Filters(shards, blocks)
    first, count = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    for one, (start, blocks_of) in shards.items():
        first = F.when(shard == one, F.lit(start).cast("bigint")).otherwise(first)
        count = F.when(shard == one, F.lit(blocks_of).cast("bigint")).otherwise(count)
    mask = F.lit(0).cast("bigint")
    for probe in range(_PROBES):
        bit = F.shiftrightunsigned("h", 6 * probe).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    block = first + F.shiftright(F.shiftrightunsigned("h", 32) * count, 32)
    set_ = vocabulary.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    segment = F.shiftright("block", _SEGMENT)
    dealt = set_.withColumn("segment", segment).repartition("segment").sortWithinPartitions("segment")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([held.tobytes()], pa.binary())], ["segment", "blocks"]
            )

        for batch in batches:
            place, masks, own = (batch.column(name).to_numpy() for name in ("block", "mask", "segment"))
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if own[start] != at:
                    if held is not None:
                        yield row()
                    at, held = int(own[start]), np.zeros(1 << _SEGMENT, np.uint64)
                held[place[start:stop] - (at << _SEGMENT)] = masks[start:stop].view(np.uint64)
        if held is not None:
            yield row()

    ship()
    for row in dealt.mapInArrow(pack, "segment bigint, blocks binary").toLocalIterator():
        start = row.segment << _SEGMENT
        part = np.frombuffer(row.blocks, np.uint64)[: total - start]
        blocks[start:start + len(part)] = part
    return Filters(shards, blocks)


# --- neighbours ---------------------------------------------------------------------------


def _probed(vocabulary: DataFrame, filters: Filters, letters: list[int]) -> DataFrame:
    """(h, edited, place, letter): the edits of each word that the filters let pass; letter 0 deletes."""
    shared = vocabulary.sparkSession.sparkContext.broadcast((filters.shards, filters.blocks, letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, blocks, alphabet = shared.value
        held = Filters(shards, blocks)
        for batch in batches:
            for part in slices(batch, "word", 1 << 19):
                words = Hashed([word.encode("latin-1") for word in part.column("word").to_pylist()])
                own = words.hashes()
                for letter in [0, *alphabet]:
                    at, edited = words.replacements(letter) if letter else words.deletions()
                    hit = held.hold(edited, words.length[words.word[at]] - (0 if letter else 1))
                    at, edited = at[hit], edited[hit]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own[words.word[at]].view(np.int64)), pa.array(edited.view(np.int64)),
                        pa.array(words.place[at].astype(np.int32)), pa.array(np.full(len(at), letter, np.int16)),
                    ], ["h", "edited", "place", "letter"])

    ship()
    return vocabulary.select("word").mapInArrow(run, "h bigint, edited bigint, place int, letter smallint")


def near_pairs(vocabulary: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words of a vocabulary (word, n, h, length), once."""
    found = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    letters = sorted(ord(row.c) for row in found.collect())  # at most 90 letters
    # Written, so that Spark sees how many there are before it plans the joins.
    positives = materialize(_probed(vocabulary, build_filters(vocabulary, most_bytes), letters), "edits")
    side = vocabulary.select(F.col("h").alias("edited"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    other = vocabulary.select("h", F.col("word").alias("a"), F.col("n").alias("n_a"))
    pairs = positives.join(side, "edited").join(other, "h")
    letter = F.when(F.col("letter") == 0, "").otherwise(F.char(F.col("letter").cast("int")))
    rest = F.col("a").substr(F.col("place") + 2, F.length("a"))
    edit = F.concat(F.col("a").substr(F.lit(1), F.col("place")), letter, rest)
    return pairs.where(edit == F.col("b")).select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer jumping over (word, form).

    Counts grow with every step by the ratio at least, so the rounds grow with the logarithm of the
    logarithm of the largest count.
    """
    to = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = materialize(to.join(further, "root", "left"), "jumps")
        if jumped.where("next is not null").isEmpty():
            return to
        to = jumped.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(
    counted: DataFrame, least_count: int = LEAST_COUNT, ratio: float = RATIO, most_bytes: int = FILTER_BYTES
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of (word, n) that are counted often enough."""
    if ratio <= 1:
        raise ValueError("a form must have a larger count than its word")
    vocabulary = materialize(_with_hashes(counted.where(F.col("n") >= least_count)), "vocabulary")
    pairs = near_pairs(vocabulary, most_bytes)

    def toward(word: str, n: str, near: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.struct((-F.col(n)).alias("less"), F.col(near).alias("near")).alias("one"))

    # Every pair counts for both of its words.
    both = pairs.select(F.inline(F.array(toward("a", "n_b", "b"), toward("b", "n_a", "a"))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("one").alias("best"))
    joined = vocabulary.select("word", "n").join(best, "word", "left")
    is_form: Column = -F.col("best.less") >= F.col("n") * ratio
    forms = materialize(joined.select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ), "forms")
    found = forms.join(roots(forms.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
