"""Byte-level byte-pair encoding and decoding with a rank queue over hierarchical bitmaps.

The pieces of a text (matches of the splitting pattern) are merged in the order of merge ranks.
All pieces of a slice that the worker has not met yet share one linked list over their bytes. A
bucket per rank holds the positions whose pair merges to that rank; a three-level bitmap with one
bit per rank finds the least rank that has a bucket. Its positions are merged together, entries
that an earlier merge has made stale are skipped, and the pairs this creates go into their own
buckets. The cost is linear in the merges, so one piece of many megabytes is no special case.

Null text is the empty text and has no ids. A text column of any length works; nothing is cut.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import SLICE_BYTES, add_columns, list_array, texts_of, vocabulary

# Pieces that a worker remembers; beyond that it starts anew. Memory, not results, depends on it.
CACHE_PIECES = 400_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (one base64 token and its rank a line)."""
    lines = (line.split() for line in raw.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class RankQueue:
    """Buckets of positions by rank; the least rank is found by find-first-set in three levels."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.words: dict[int, int] = {}  # rank // 64 -> bits
        self.groups: dict[int, int] = {}  # rank // 4096 -> bits over words
        self.top = 0  # bits over groups

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        word, group = rank >> 6, rank >> 12
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 63)
        self.groups[group] = self.groups.get(group, 0) | 1 << (word & 63)
        self.top |= 1 << group

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The least rank and its positions in ascending order; None if the queue is empty."""
        if not self.top:
            return None
        group = (self.top & -self.top).bit_length() - 1
        bits = self.groups[group]
        word = (group << 6) + (bits & -bits).bit_length() - 1
        bits = self.words[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        self.words[word] &= self.words[word] - 1
        if not self.words[word]:
            self.groups[group] &= self.groups[group] - 1
            if not self.groups[group]:
                self.top &= self.top - 1
        parts = self.buckets.pop(rank)
        at = np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])
        return rank, at[np.flatnonzero(np.diff(at, prepend=-1))]


class Merger:
    """Encodes lists of byte pieces by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([value])] for value in range(256)], np.int64)
        # Every way in which two tokens join to a third: (left, right) -> rank of the whole.
        pairs = {
            ranks[token[:cut]] << 32 | ranks[token[cut:]]: rank
            for token, rank in ranks.items() for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        codes = np.array(sorted(pairs), np.int64)
        self.codes = np.append(codes, np.iinfo(np.int64).max)
        self.joined = np.array([*(pairs[code] for code in codes.tolist()), -1], np.int64)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        codes = left << 32 | right
        at = np.searchsorted(self.codes, codes)
        return np.where(self.codes[at] == codes, self.joined[at], -1)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit integers. A piece that is itself a token is that token."""
        whole = [self.ranks.get(piece) for piece in pieces]
        split = iter(self._merge([piece for piece, rank in zip(pieces, whole) if rank is None and piece]))
        return [
            rank.to_bytes(4, "little") if rank is not None else next(split) if piece else b""
            for piece, rank in zip(pieces, whole)
        ]

    def _merge(self, pieces: list[bytes], one_by_one: bool = False) -> list[bytes]:
        """Merge all pieces at once. Where a merge makes a pair of lower rank than its own, which a
        vocabulary with several ways to one token allows, the order within a rank matters: such
        pieces are merged again, alone and one pair at a time."""
        if not pieces:
            return []
        lengths = np.array([len(piece) for piece in pieces])
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        token = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.arange(1, n + 1)  # the linked list; n and -1 end a piece
        after[ends - 1] = n
        before = np.arange(-1, n - 1)
        before[ends - lengths] = -1
        alive = np.ones(n, bool)
        wanted = np.full(n + 1, -1, np.int64)  # the rank each position waits for, now
        queue = RankQueue()
        again: set[int] = set()

        def enter(positions: np.ndarray, merged: int = -1) -> None:
            follower = after[positions]
            ranks = np.full(len(positions), -1, np.int64)
            inner = follower < n
            ranks[inner] = self._rank_of(token[positions[inner]], token[follower[inner]])
            wanted[positions] = ranks
            good = ranks >= 0
            if not good.any():
                return
            positions, ranks = positions[good], ranks[good]
            if (ranks < merged).any():
                again.update(np.searchsorted(ends, positions[ranks < merged], "right").tolist())
            if len(ranks) > 1:
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for start, stop in zip(starts, starts[1:]):
                queue.push(int(ranks[start]), positions[start:stop])

        enter(np.arange(n))
        while (least := queue.pop()) is not None:
            rank, at = least
            at = at[alive[at] & (wanted[at] == rank)]  # skip stale entries
            if not len(at):
                continue
            if one_by_one and len(at) > 1:
                queue.push(rank, at[1:])
                at = at[:1]
            if len(at) > 1:
                # Pairs that share a token: of a chain, every second one merges, from the left.
                chained = np.zeros(len(at), bool)
                chained[1:] = after[at[:-1]] == at[1:]
                if chained.any():
                    index = np.arange(len(at))
                    first = np.maximum.accumulate(np.where(chained, 0, index))
                    at = at[(index - first) % 2 == 0]
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            beyond = after[gone]
            after[at] = beyond
            inner = beyond < n
            before[beyond[inner]] = at[inner]
            wanted[gone] = -1
            left = before[at]
            enter(np.concatenate([at, left[left >= 0]]), rank)

        keep = np.flatnonzero(alive)
        flat = token[keep].astype("<i4").tobytes()
        cuts = (4 * np.searchsorted(keep, np.concatenate([[0], ends]))).tolist()
        found = [flat[start:stop] for start, stop in zip(cuts, cuts[1:])]
        if not one_by_one:
            for index in again:
                found[index] = self._merge([pieces[index]], one_by_one=True)[0]
        return found


def late_letters(pattern_library=regex) -> str:
    """A character class of the letters and numbers that `regex` knows and tiktoken does not.

    Both follow Unicode, but not the same edition. The candidates are those that Python's own,
    older tables call unassigned; an encoding with one merge tells how tiktoken sees each.
    """
    import tiktoken

    every = "".join(map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x110000))))
    known = [c for c in pattern_library.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    if not known:
        return ""
    ranks = {bytes([value]): value for value in range(256)}
    for lead in sorted({c.encode()[0] for c in known}):
        ranks[bytes([ord("."), lead])] = len(ranks)
    probe = tiktoken.Encoding(
        "probe", pat_str=r"[\p{L}\p{N}\s]|[^\s\p{L}\p{N}]+", mergeable_ranks=ranks, special_tokens={}
    )
    late = [ord(c) for c in known if probe.encode_ordinary(f".{c}")[0] >= 256]
    runs: list[list[int]] = []
    for code in late:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Splitter:
    """Splits texts as tiktoken does with the same pattern."""

    def __init__(self, pattern: str, late: str) -> None:
        self.fast = regex.compile(pattern)
        self.odd = regex.compile(f"[{late}]") if late else None
        if late:
            other = r"[^\s\p{L}\p{N}]"
            exact = pattern.replace(other, "\0").replace(r"\p{L}", f"(?:(?![{late}])\\p{{L}})")
            exact = exact.replace(r"\p{N}", f"(?:(?![{late}])\\p{{N}})")
            self.exact = regex.compile(exact.replace("\0", f"(?:{other}|[{late}])"))

    def split(self, text: str, known: dict) -> tuple[list[str], set[str]]:
        """The pieces, and those of them that the dict `known` lacks."""
        pieces = self._pieces(self.fast, text)
        new = set(pieces).difference(known)
        if self.odd and any(self.odd.search(piece) for piece in new if not piece.isascii()):
            pieces = self._pieces(self.exact, text)
            new = set(pieces).difference(known)
        return pieces, new

    @staticmethod
    def _pieces(pattern, text: str) -> list[str]:
        if pattern.groups:
            return [match.group() for match in pattern.finditer(text)]
        return pattern.findall(text)


def encode(
    df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add `ids`, the token ids of each whole text, in order (empty for null and empty texts).

    No shuffle: one task per input split. A worker remembers the ids of pieces it has met.
    """
    raw = vocabulary(df.sparkSession, rank_file)
    late = late_letters()

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        merger, splitter = Merger(read_ranks(raw.value)), Splitter(pattern, late)
        cache: dict[str, bytes] = {}

        def compute(column: pa.Array) -> list[pa.Array]:
            if len(cache) > CACHE_PIECES:
                cache.clear()
            rows, missing = [], set()
            for one in texts_of(column):
                pieces, new = splitter.split(one, cache)
                rows.append(pieces)
                missing |= new
            order = list(missing)
            odd = [piece for piece in order if splitter.odd and splitter.odd.search(piece)]
            for piece, found in zip(order, merger.encode([piece.encode() for piece in order])):
                cache[piece] = found
            values = [b"".join(map(cache.__getitem__, pieces)) for pieces in rows]
            for piece in odd:  # so that a text with such letters is always seen as one
                del cache[piece]
            flat = pa.Array.from_buffers(
                pa.int32(), sum(map(len, values)) // 4, [None, pa.py_buffer(b"".join(values))]
            )
            return [list_array(flat, [len(value) // 4 for value in values])]

        return compute

    return add_columns(df, text, f"`{ids}` array<int>", make, keep)


def decode(df: DataFrame, rank_file: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add `decoded`, the bytes of each list of ids; a null list has none."""
    raw = vocabulary(df.sparkSession, rank_file)
    binary = F.col(ids).cast("array<int>")

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        token = {rank: token for token, rank in read_ranks(raw.value).items()}
        lengths = np.zeros(max(token) + 1, np.int64)
        lengths[list(token)] = [len(one) for one in token.values()]
        starts = np.cumsum(lengths) - lengths
        table = np.frombuffer(b"".join(token[rank] for rank in sorted(token)), np.uint8)

        def compute(column: pa.Array) -> list[pa.Array]:
            numbers = column.flatten().to_numpy(zero_copy_only=False)
            size = lengths[numbers]
            ends = np.concatenate([[0], np.cumsum(size)])
            # Byte j of token i lies at starts[i] + j in the table.
            at = np.repeat(starts[numbers] - ends[:-1], size) + np.arange(ends[-1])
            rows = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
            offsets = ends[np.concatenate([[0], rows])].astype(np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(table[at])]
            return [pa.Array.from_buffers(pa.binary(), len(column), buffers)]

        return compute

    # Places are counted byte by byte, so a slice needs some thirty times its size.
    return add_columns(df.withColumn(ids, binary), ids, f"`{decoded}` binary", make, most=SLICE_BYTES // 4)
