"""WARC archives: write records, read them back by boundary-chain verification.

Writing: one record per row, through Spark's text sink, so any file system works. Of rows with equal
payloads (of a given least size) the one with the least id is a response, the others are revisits
of it without a block.

Reading: files are read in splits, cut at the magic, no part of which recurs inside it, so that no cut is
missed whatever stands before. What follows the record separator and the magic is only a
candidate, since payloads may hold both. A task emits each candidate with the offset of its successor
(its start + header + Content-Length + separator), and where the chain from it leaves the split.
Pointer jumping over these exits, from the start of each file, finds the candidates at which the true
chain enters each split; only candidates on the chain from there are records. A record whose payload
holds the magic is put together again, over the end of a split too. A chain that does not end where its
file ends raises BrokenArchive, unless the records before the break are asked for.

Null payload is empty. Null ids are written as empty and read as null; among equal payloads a null id
is never the least, and if all are null all are responses. Rows that repeat an id and payload are
alike. An empty table makes an archive without records. Line ends in addresses become blanks.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import ship, unused
from touchline.sources.scratch import materialize

# Fixed values of the format.
MAGIC = "WARC/1."
LINE = "\r\n"
SEPARATOR = LINE + LINE
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class BrokenArchive(ValueError):
    """A file whose records do not follow each other up to its end."""


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: four groups of 40 bits, 8 digits each."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * at, 10), 16, 32), 8, "0") for at in range(4)]
    return F.translate(F.concat(*groups), _HEX32, _BASE32)


def mark_revisits(
    df: DataFrame, record_id: str, payload: str, least_bytes: int = 0,
    digest: str = "payload_digest", size: str = "payload_bytes", refers_to: str = "refers_to",
) -> DataFrame:
    """Add digest and size of the payload and, for revisits, the id of the response.

    Only (id, digest) pairs move: the least id of a digest is combined before the shuffle, and the
    revisits are written, so that Spark sees their size before it plans the join to the payloads.
    """
    raw = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    df = df.select(*[f"`{name}`" for name in df.columns if name.lower() not in (digest, size, refers_to)])
    df = df.withColumn(digest, base32_sha1(raw)).withColumn(size, F.octet_length(raw).cast("bigint"))
    rows = df.where(F.col(size) >= least_bytes).select(F.col(f"`{record_id}`").alias("id"), F.col(digest).alias("d"))
    least = rows.groupBy("d").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    found = rows.join(least, "d").where("first is not null and not (id <=> first)")
    found = materialize(found.select("id", "d", "first").distinct(), "revisits")
    id_, d = unused(df, "_id"), unused(df, "_digest")
    found = found.toDF(id_, d, refers_to)
    match = F.col(f"`{record_id}`").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(d)) & (F.col(size) >= least_bytes)
    return df.join(found, match, "left").drop(id_, d)


def write_warc(
    df: DataFrame, path: str, record_id: str, uri: str, payload: str, least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for each row of df to a folder of archives."""
    rows = mark_revisits(df, record_id, payload, least_bytes)
    revisit = F.col("refers_to").isNotNull()

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:record:"), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(LINE))

    body = F.when(revisit, F.lit("")).otherwise(F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")))
    record = F.concat(
        F.lit(f"{MAGIC}1{LINE}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(record_id)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.translate(F.coalesce(F.col(f"`{uri}`").cast("string"), F.lit("")), LINE, "  ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(LINE),
        body,
    )
    rows.select(record.alias("value")).write.option("lineSep", SEPARATOR).text(path)


_FIELDS = {
    "record_type": b"warc-type", "record_id": b"warc-record-id", "date": b"warc-date", "uri": b"warc-target-uri",
    "refers_to": b"warc-refers-to", "header_digest": b"warc-payload-digest", "header_length": b"warc-payload-length",
}
_SCAN = (
    "kind int, file string, block bigint, at bigint, successor bigint, "
    + ", ".join(f"{name} string" for name in _FIELDS)
    + ", n_bytes bigint, digest string, payload binary, missing bigint"
)
RECORD, TOTAL, EXIT = 0, 1, 2


def parse_header(piece: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """(headers, header bytes, Content-Length) of what follows the magic; None if it is no header."""
    end = piece.find(SEPARATOR.encode())
    if end < 0 or not re.match(rb"\d+\r\n", piece):
        return None
    headers: dict[bytes, bytes] = {}
    for row in piece[:end].split(LINE.encode())[1:]:
        name, colon, value = row.partition(b":")
        if not colon:
            return None
        headers.setdefault(name.strip().lower(), value.strip())
    length = headers.get(b"content-length", b"")
    if not re.fullmatch(rb"\d{1,18}", length):
        return None
    return headers, end + len(SEPARATOR), int(length)


@dataclass
class _Open:
    """A candidate whose payload goes on in the pieces that follow."""

    row: dict
    parts: list[bytes]
    missing: int


@dataclass
class _Split:
    """The pieces of one split, in order; offsets count from the split's first piece.

    What stands before the first piece of a later split is not seen here: it counts as a separator, and
    the chain decides.
    """

    file: str
    block: int
    at: int = 0
    pieces: int = 0
    separated: bool = True
    chain: list[tuple[int, int]] = field(default_factory=list)
    open: list[_Open] = field(default_factory=list)

    def _finish(self, row: dict, content: bytes, keep: bool) -> dict:
        digest = base64.b32encode(hashlib.sha1(content).digest()).decode()
        return row | {"n_bytes": len(content), "digest": digest, "payload": content if keep else None, "missing": 0}

    def take(self, piece: bytes, keep: bool) -> Iterator[dict]:
        """Rows of the records that this piece completes."""
        # The first piece of a file stands before the first magic.
        start = None if self.pieces == 0 and self.block == 0 else self.at
        separated, self.separated = self.separated, piece.endswith(SEPARATOR.encode()) or start is None
        if self.open:
            more, still = MAGIC.encode() + piece, []
            for one in self.open:
                one.parts.append(more[: one.missing])
                one.missing -= len(one.parts[-1])
                if one.missing:
                    still.append(one)
                else:
                    yield self._finish(one.row, b"".join(one.parts), keep)
            self.open = still
        self.pieces += 1
        self.at += len(piece) + len(MAGIC)
        found = parse_header(piece) if start is not None and separated else None
        if found is None:
            return
        headers, skip, length = found
        successor = start + skip + length + len(SEPARATOR) + len(MAGIC)
        self.chain.append((start, successor))
        row = {"kind": RECORD, "file": self.file, "block": self.block, "at": start, "successor": successor}
        row |= {name: headers.get(key, b"").decode("utf-8", "replace") for name, key in _FIELDS.items()}
        content = piece[skip: skip + length]
        if len(content) < length:
            self.open.append(_Open(row, [content], length - len(content)))
        else:
            yield self._finish(row, content, keep)

    def end(self) -> Iterator[dict]:
        """The payloads that go on in the next split, the split's size, and where chains leave it."""
        own = {"file": self.file, "block": self.block}
        for one in self.open:
            content = b"".join(one.parts)
            yield one.row | {"n_bytes": len(content), "payload": content, "missing": one.missing}
        yield own | {"kind": TOTAL, "at": self.at}
        leaves: dict[int, int] = {}
        for start, successor in reversed(self.chain):
            leaves[start] = leaves.get(successor, successor)
            # A successor inside the split that is no candidate is a dead end.
            if leaves[start] >= self.at:
                yield own | {"kind": EXIT, "at": start, "successor": leaves[start]}


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between one magic and the next, in file order within each split."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _scan(spark: SparkSession, path: str, keep: bool) -> DataFrame:
    ship()
    names = [part.split()[0] for part in _SCAN.split(", ")]
    types = {"kind": pa.int32(), "payload": pa.binary()}
    types |= {name: pa.int64() for name in ("block", "at", "successor", "n_bytes", "missing")}

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([row.get(name) for row in rows], types.get(name, pa.string())) for name in names], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            rows: list[dict] = []
            places = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for piece, (file, block) in zip(batch.column(0), places):
                if split is None or (split.file, split.block) != (file, block):
                    rows += split.end() if split else ()
                    split = _Split(file, block)
                rows += split.take(piece.as_py(), keep)
            yield table(rows)
        if split:
            yield table(list(split.end()))

    return _pieces(spark, path).mapInArrow(run, _SCAN)


def _entries(scan: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, place): the absolute offsets at which the true chain enters splits, its end included."""
    exits = scan.where(F.col("kind") == EXIT).join(splits, ["file", "block"]).select(
        "file", (F.col("base") + F.col("at")).alias("place"), (F.col("base") + F.col("successor")).alias("next")
    )
    reached = splits.where("block = 0").select("file", F.lit(len(MAGIC)).cast("bigint").alias("place"))
    # Only what some chain leaves for, or a file's start, can be entered.
    possible = exits.select("file", F.col("next").alias("place")).unionByName(reached).distinct()
    jump = materialize(exits.join(possible, ["file", "place"], "left_semi"), "exits")
    longest = splits.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    hops = 1
    while hops <= longest:  # after each round, twice as many splits lie behind one jump
        reached = reached.unionByName(
            reached.join(jump, ["file", "place"]).select("file", F.col("next").alias("place"))
        ).distinct()
        reached = materialize(reached, "reached")
        again = jump.select("file", F.col("place").alias("next"), F.col("next").alias("far"))
        hops *= 2
        if hops <= longest:
            jump = materialize(jump.join(again, ["file", "next"]).select("file", "place", F.col("far").alias("next")), "exits")
    return reached


def read_warc(spark: SparkSession, path: str, payload: bool = False, broken: str = "raise") -> DataFrame:
    """The records of a folder of uncompressed archives: (file, offset, record_type, record_id, date,
    uri, refers_to, header_digest, header_length, n_bytes, digest), and `payload` if asked for.

    `n_bytes` and `digest` are those of the block as read. A file that is cut short or broken raises
    BrokenArchive; with `broken="skip"` its records up to the break are read.
    """
    if broken not in ("raise", "skip"):
        raise ValueError(f"broken is 'raise' or 'skip', not {broken!r}")
    ship()
    scan = materialize(_scan(spark, path, payload), "warc-scan")
    totals = scan.where(F.col("kind") == TOTAL).select("file", "block", F.col("at").alias("size"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    # One row per split.
    splits = materialize(
        totals.withColumn("base", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("bigint"))), "splits"
    )
    # The split that an entry lies in: the last one of its file that starts no later.
    place = splits.select("file", "block", "base", (F.col("base") + F.col("size")).alias("stop"))
    reached = _entries(scan, splits)
    if broken == "raise":
        ends = splits.groupBy("file").agg(F.max(F.col("base") + F.col("size")).alias("place"))
        lost = ends.join(reached, ["file", "place"], "left_anti")
        first, n = lost.agg(F.min("file"), F.count("*")).first()
        if n:
            raise BrokenArchive(f"{n} file(s) whose records do not reach the end, {first} first")
    entries = reached.join(place, "file").where("place >= base and place < stop").select(
        "file", "block", (F.col("place") - F.col("base")).alias("at")
    )
    chain = scan.where(F.col("kind") == RECORD).select("file", "block", "at", "successor")

    def follow(candidates: pa.Table, starts: pa.Table) -> pa.Table:
        # One split: its candidates, and the offsets at which the chain comes in (one, in a sound file).
        after = dict(zip(candidates.column("at").to_pylist(), candidates.column("successor").to_pylist()))
        on_chain: set[int] = set()
        for start in starts.column("at").to_pylist():
            while start in after and start not in on_chain:
                on_chain.add(start)
                start = after[start]
        n = len(on_chain)
        file = candidates.column("file")[0].as_py() if n else None
        block = candidates.column("block")[0].as_py() if n else None
        return pa.table({
            "file": pa.array([file] * n, pa.string()), "block": pa.array([block] * n, pa.int64()),
            "at": pa.array(sorted(on_chain), pa.int64()),
        })

    true = chain.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInArrow(
        follow, "file string, block bigint, at bigint"
    )
    found = scan.where(F.col("kind") == RECORD).join(true, ["file", "block", "at"], "left_semi")
    found = found.join(splits.select("file", "block", "base", "size"), ["file", "block"])
    records = _complete(spark, path, found, splits)
    urn = r"^<urn:record:(.*)>$"
    # A block that names no length of its payload is the payload.
    columns = ["n_bytes", "digest", *(["payload"] if payload else [])]
    return records.select(
        "file", (F.col("base") + F.col("at") - len(MAGIC)).alias("offset"), "record_type",
        F.regexp_extract("record_id", urn, 1).alias("record_id"), "date", "uri",
        F.regexp_extract("refers_to", urn, 1).alias("refers_to"),
        F.regexp_replace("header_digest", "^sha1:", "").alias("header_digest"),
        F.expr("try_cast(header_length as bigint)").alias("header_length"), *columns,
    )


def _complete(spark: SparkSession, path: str, found: DataFrame, splits: DataFrame) -> DataFrame:
    """Put together the payloads that go on in later splits, at most a few per split.

    A record that the end of its file cuts short is left out.
    """
    cut = materialize(found.where("missing > 0"), "cut")
    if cut.isEmpty():
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = None, 0
        for batch in batches:
            starts = []
            pieces, files, blocks = (column.to_pylist() for column in batch.columns)
            for piece, *where in zip(pieces, files, blocks):
                if where != place:
                    place, at = where, 0
                starts.append(at)
                at += len(piece) + len(MAGIC)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(starts, pa.int64()), batch.column(0)],
                ["file", "block", "piece_at", "piece"],
            )

    magic = F.lit(MAGIC.encode())
    pieces = _pieces(spark, path).mapInArrow(run, "file string, block bigint, piece_at bigint, piece binary")
    pieces = pieces.join(splits.select("file", "block", "base"), ["file", "block"]).select(
        "file", (F.col("base") + F.col("piece_at") - len(MAGIC)).alias("start"),
        F.concat(magic, F.col("piece")).alias("bytes"),
    )
    gap = F.col("base") + F.col("size") - len(MAGIC)  # the magic after the split's last piece
    wanted = cut.select("file", "block", "at", gap.alias("first"), (gap + F.col("missing")).alias("stop"))
    inside = F.substring(F.col("bytes"), F.lit(1), (F.col("stop") - F.col("start")).cast("int"))
    rest = (
        wanted.join(pieces, "file").where("start >= first and start < stop")
        .groupBy("file", "block", "at")
        .agg(F.sort_array(F.collect_list(F.struct("start", inside.alias("bytes")))).alias("parts"))
    )
    whole = F.aggregate("parts", F.col("payload"), lambda bytes_, part: F.concat(bytes_, part["bytes"]))
    wanted_bytes = F.col("n_bytes") + F.col("missing")
    done = (
        cut.join(rest, ["file", "block", "at"]).withColumn("payload", whole).drop("parts")
        .where(F.octet_length("payload") == wanted_bytes)
        .withColumn("n_bytes", wanted_bytes).withColumn("digest", base32_sha1(F.col("payload")))
    )
    return found.where("missing = 0").unionByName(done)
