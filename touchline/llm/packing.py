"""Harmonic packing of token sequences, with free cuts.

Lengths are partitioned into classes: class k holds the lengths in (capacity/(k+1), capacity/k], and
each bin of class k is filled with exactly k pieces. Since documents may be cut, a remainder is cut
at the upper ends of classes (capacity/k for the least k that fits, as long as k is small), where k
pieces fill a bin to the last few tokens. Every task fills the bins of its own documents without
asking any other. What its last, open bins hold is filled up among a fixed number of tasks: first by
class again, then the few pieces left by decreasing length into the first bin with room.

Null text is the empty text; every document has its end token, so none is without a piece. Repeated
rows are packed as often as they occur. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import ship, slices, texts_of, vocabulary
from touchline.llm.encoders import encoder_of
from touchline.sources.scratch import materialize

# Remainders are cut at capacity/1 .. capacity/FINEST; what is shorter stays in one piece.
FINEST = 32
# Tasks whose open bins are filled up together: their pieces have a bound that no input moves.
TASKS_PER_GROUP = 64
# Sequence numbers: task (or group) above these bits, number within it below.
_NUMBER_BITS = 32

def cut(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: whole sequences, class ends, and a short rest."""
    parts = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = -(-capacity // rest)  # the least k with capacity/k <= rest, up to rounding
        if capacity // k > rest:
            k += 1
        part = capacity // k if k <= FINEST else rest
        parts.append(part)
        rest -= part
    return parts


class Bins:
    """Fills the bins of each class with k pieces and numbers them as they close."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: dict[int, list] = {}
        self.closed = 0

    def put(self, length: int, piece: object) -> list[tuple[object, int, int]]:
        """Add a piece; the (piece, bin, offset) of the bin that it fills, if it does."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, piece))
        if len(held) < k:
            return []
        del self.open[k]
        return self.close(held)

    def close(self, held: list) -> list[tuple[object, int, int]]:
        out, offset = [], 0
        for length, piece in held:
            out.append((piece, self.closed, offset))
            offset += length
        self.closed += 1
        return out

    def rest(self) -> list:
        return [entry for k in sorted(self.open) for entry in self.open[k]]


def first_fit(pieces: list, capacity: int) -> list[list]:
    """Pieces (length, ...) by decreasing length, each into the first bin with room."""
    bins: list[list] = []
    room: list[int] = []
    for entry in sorted(pieces, key=lambda entry: -entry[0]):
        for index, free in enumerate(room):
            if entry[0] <= free:
                bins[index].append(entry)
                room[index] -= entry[0]
                break
        else:
            bins.append([entry])
            room.append(capacity - entry[0])
    return bins


def pack(
    df: DataFrame, tokenizer: str, pattern: str, end_id: int, capacity: int = 2048, doc_id: str = "doc_id",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset),
    and with `with_ids` the token ids of each piece.

    `tokenizer` is a tokenizer.json (see `encoders`); each document ends with `end_id`. A sequence is all
    pieces of one sequence_id, gapless from offset 0, with at most `capacity` tokens. Texts are not
    moved; only the pieces of open bins are.
    """
    ship()
    raw = vocabulary(df.sparkSession, tokenizer)
    source = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ids_field = ", ids array<int>" if with_ids else ""
    fields = T._parse_datatype_string(
        f"start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, bin bigint, offset bigint{ids_field}"
    ).fields
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), *fields])
    names = [field.name for field in schema.fields]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder_of(raw.value, pattern), Bins(capacity)
        task = TaskContext.get().partitionId()
        doc_type = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(names)
            types = [doc_type, *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.int64()]
            types += [pa.list_(pa.int32())] * with_ids
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)], names
            )

        for batch in batches:
            doc_type = batch.column(0).type
            for part in slices(batch, "text"):
                done = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(texts_of(part.column(1)))):
                    ids = np.append(ids, end_id).astype("<u4")
                    start = 0
                    for length in cut(len(ids), capacity):
                        own = ids[start:start + length]
                        piece = (doc, start, length, zlib.crc32(own.tobytes()), len(ids), task)
                        tail = (own.astype(np.int32),) if with_ids else ()
                        done += bins.put(length, (piece, tail))
                        start += length
                yield table([(*piece, bin_, offset, *tail) for (piece, tail), bin_, offset in done])
        if doc_type is not None:
            yield table([(*piece, -1, 0, *tail) for _, (piece, tail) in bins.rest()])

    # Texts are encoded once: both the closed bins and the rest are read from this table.
    pieces = materialize(source.mapInArrow(fill, schema), "packed")
    group = F.floor(F.col("task") / TASKS_PER_GROUP).cast("int")

    def finish(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([(name, "ascending") for name in ("task", "doc_id", "start")])
        bins = Bins(capacity)
        done = []
        for index, length in enumerate(rows.column("length").to_pylist()):
            done += bins.put(length, index)
        for held in first_fit(bins.rest(), capacity):
            done += bins.close(held)
        rows = rows.take([index for index, _, _ in done])
        new = {
            "task": pc.divide(rows.column("task"), pa.scalar(TASKS_PER_GROUP, pa.int32())),
            "bin": pa.array([bin_ for _, bin_, _ in done], pa.int64()),
            "offset": pa.array([offset for _, _, offset in done], pa.int64()),
        }
        return pa.table({name: new.get(name, rows.column(name)) for name in names})

    # A group holds the open bins of a fixed number of tasks: at most k - 1 pieces of each class.
    rest = pieces.where("bin < 0").groupBy(group).applyInArrow(finish, schema)

    def numbered(rows: DataFrame, own: int) -> DataFrame:
        # Odd and even numbers keep the sequences of tasks and of groups apart.
        first = F.shiftleft(F.col("task").cast("bigint") * 2 + own, _NUMBER_BITS)
        return rows.select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", (first + F.col("bin")).alias("sequence_id"),
            "offset", *(["ids"] if with_ids else []),
        )

    return numbered(pieces.where("bin >= 0"), 0).unionByName(numbered(rest, 1))
