"""Byte-level encoding, token counts and packing against the public libraries."""

import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchline.llm import bpe, counts, encoders, packing
from touchline.sources.scratch import scratch_folder

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
PLAIN = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merger():
    return bpe.Merger(bpe.read_ranks(open(RANKS, "rb").read()))


@pytest.fixture(scope="module")
def splitter():
    return bpe.Splitter(P.PATTERN, bpe.late_letters())


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PLAIN)


def ids_of(merger, splitter, text):
    pieces, _ = splitter.split(text, {})
    return np.frombuffer(b"".join(merger.encode([piece.encode() for piece in pieces])), "<i4").tolist()


def test_rank_queue_gives_the_least_rank_and_sorted_places():
    queue, rnd = bpe.RankQueue(), random.Random(1)
    wanted = {}
    for _ in range(500):
        rank, at = rnd.choice([0, 63, 64, 4095, 4096, 50255]), rnd.randrange(1000)
        queue.push(rank, np.array([at]))
        wanted.setdefault(rank, set()).add(at)
    got = []
    while (least := queue.pop()) is not None:
        got.append((least[0], least[1].tolist()))
    assert got == [(rank, sorted(places)) for rank, places in sorted(wanted.items())]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abthe \n\té中1's&\u1c8a\ua7ce\x85"), max_size=60))
def test_encoding_equals_the_library(merger, splitter, library, text):
    assert ids_of(merger, splitter, text) == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encoding_of_any_text_equals_the_library(merger, splitter, library, text):
    assert ids_of(merger, splitter, text) == library.encode_ordinary(text)


def test_very_long_pieces(merger, splitter, library):
    rnd = random.Random(2)
    for text in ("a" * 30000, "ab" * 15000, "".join(rnd.choice("abcdeth") for _ in range(30000)), " " * 5000 + "x"):
        assert ids_of(merger, splitter, text) == library.encode_ordinary(text)


def test_order_within_a_rank_where_a_longer_token_ranks_lower():
    # "abc" has a lower rank than its part "ab": what one merge makes must go before its like elsewhere.
    tokens = [bytes([value]) for value in range(256)] + [b"abab", b"ab", b"aba", b"bab"]
    for order in ([256, 257, 258, 259], [259, 256, 258, 257], [257, 258, 256, 259]):
        ranks = dict(zip(tokens[:256], range(256))) | {tokens[at]: 256 + place for place, at in enumerate(order)}
        library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        merger = bpe.Merger(ranks)
        rnd = random.Random(3)
        for _ in range(300):
            text = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 14)))
            got = np.frombuffer(merger.encode([text.encode()])[0], "<i4").tolist()
            assert got == library.encode_ordinary(text)


def test_encode_and_decode_frames(awkward, none, library):
    encoded = bpe.encode(awkward, RANKS, P.PATTERN)
    decoded = bpe.decode(encoded, RANKS)
    rows = decoded.collect()
    assert len(rows) == awkward.count() and {"lang", "Fingerprint"} <= set(decoded.columns)
    for row in rows:
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.decode(bpe.encode(none, RANKS, P.PATTERN), RANKS).collect() == []
    assert bpe.encode(awkward, RANKS, P.PATTERN, keep=["doc_id"]).columns == ["doc_id", "ids"]


def test_counts_equal_the_library_and_fill_the_cache(spark, awkward, none, plain):
    cache = scratch_folder(spark, "cache")
    for _ in range(2):  # from an empty cache, then from a full one
        rows = counts.count_tokens(awkward, PLAIN, P.PATTERN, cache).collect()
        assert len(rows) == awkward.count()
        for row in rows:
            assert row.n_tokens == len(plain.encode(row.text or "", add_special_tokens=False).ids)
    distinct = awkward.na.fill("", ["text"]).select("text").distinct().count()
    assert counts.read_cache(spark, cache).count() == distinct  # each text was encoded once
    more = awkward.limit(1).selectExpr("doc_id", "'new' AS text")
    assert counts.count_tokens(more, PLAIN, P.PATTERN, cache).first().n_tokens == 1
    assert counts.read_cache(spark, cache).count() == distinct + 1
    assert counts.count_tokens(none, PLAIN, P.PATTERN, scratch_folder(spark, "cache")).collect() == []


def test_counts_depend_on_the_tokenizer_version(spark, awkward):
    cache = scratch_folder(spark, "cache")
    counts.count_tokens(awkward, PLAIN, P.PATTERN, cache).collect()
    before = counts.read_cache(spark, cache).count()
    counts.count_tokens(awkward, P.path("word_bpe_49k.json"), P.PATTERN, cache).collect()
    assert counts.read_cache(spark, cache).count() == 2 * before


def test_entries_stored_twice_count_once(spark, awkward):
    cache = scratch_folder(spark, "cache")
    counts.count_tokens(awkward, PLAIN, P.PATTERN, cache).collect()
    counts.read_cache(spark, cache).write.mode("append").parquet(cache)
    assert counts.count_tokens(awkward, PLAIN, P.PATTERN, cache).count() == awkward.count()


@pytest.mark.parametrize("capacity", [64, 2048])
def test_cuts_end_at_classes(capacity):
    for length in range(1, 3 * capacity):
        parts = packing.cut(length, capacity)
        assert sum(parts) == length and max(parts) <= capacity and min(parts) > 0
        for part in parts[:-1]:
            assert part == capacity // (capacity // part)  # all but the rest fill their class


def check_packed(rows, texts, plain, capacity, end_id):
    """Every id in one piece, sequences gapless and not over capacity; the padding."""
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    for doc, pieces in by_doc.items():
        ids = np.array([*plain.encode(texts[doc] or "", add_special_tokens=False).ids, end_id], "<u4")
        at = 0
        for piece in sorted(pieces, key=lambda one: one.start):
            assert piece.start == at and piece.doc_tokens == len(ids)
            assert piece.ids_crc32 == zlib.crc32(ids[at: at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda one: one.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def test_packing_places_every_id_once_with_little_padding(documents, plain):
    texts = {row.doc_id: row.text for row in documents.collect()}
    packed = packing.pack(documents.repartition(4), PLAIN, P.PATTERN, 1)
    rows = packed.collect()
    assert {row.doc_id for row in rows} == set(texts)
    assert check_packed(rows, texts, plain, 2048, 1) < 0.02 * sum(row.length for row in rows)


def test_packing_awkward_rows(awkward, none, plain):
    texts = {row.doc_id: row.text for row in awkward.collect()}
    once = awkward.dropDuplicates(["doc_id"])
    rows = packing.pack(once, PLAIN, P.PATTERN, 1, capacity=256, with_ids=True).collect()
    check_packed(rows, texts, plain, 256, 1)
    for row in rows:
        assert len(row.ids) == row.length and zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32
    assert sum(row.doc_id == 7 for row in packing.pack(awkward, PLAIN, P.PATTERN, 1).collect()) >= 2  # as often as it occurs
    assert packing.pack(none, PLAIN, P.PATTERN, 1).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoders_equal_the_library(name):
    raw = open(P.path(name), "rb").read()
    encode, library = encoders.encoder_of(raw, P.PATTERN), Tokenizer.from_file(P.path(name))
    assert (encoders.byte_level_ranks(raw) is None) == name.startswith("word")
    rnd = random.Random(6)
    every = [chr(code) for code in (*range(0x20, 0xD800, 7), *range(0xE000, 0x11000, 3), *range(0x1F000, 0x1FB00, 5))]
    texts = ["".join(rnd.choice(every) + rnd.choice(["", "a", " ", "1", "\n", ".", "  "]) for _ in range(200)) for _ in range(100)]
    for text in (*texts, "a<|endoftext|>b", "é\x85\u3000 \ua7ce", ""):
        assert encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_that_the_fast_engine_refuses(plain):
    text = " " * 2_000_000 + "x"
    encode = encoders.encoder_of(open(PLAIN, "rb").read(), P.PATTERN)
    assert encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_files_with_another_order_of_merges_are_no_ranks():
    raw = json.loads(open(PLAIN, "rb").read())
    raw["model"]["merges"][:2] = raw["model"]["merges"][1::-1]
    assert encoders.byte_level_ranks(json.dumps(raw).encode()) is None


def test_bins_hold_a_fixed_number_of_each_class():
    bins, placed = packing.Bins(100), []
    for index in range(7):
        placed += bins.put(30, index)  # class 3: lengths 26 to 33
    assert [(piece, bin_, offset) for piece, bin_, offset in placed] == [
        (0, 0, 0), (1, 0, 30), (2, 0, 60), (3, 1, 0), (4, 1, 30), (5, 1, 60),
    ]
    assert bins.rest() == [(30, 6)]
    assert packing.first_fit([(60, "a"), (50, "b"), (40, "c"), (50, "d")], 100) == [
        [(60, "a"), (40, "c")], [(50, "b"), (50, "d")],
    ]
