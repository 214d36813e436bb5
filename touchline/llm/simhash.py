"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has 64 bits; bit b is 1 if it is set in more than half of the hashes of the text's
word shingles. Distinct fingerprints are put into tiles by the population counts of their four
16-bit quarters. Two fingerprints at distance d differ in these counts by d at most in all, so a
tile is only compared with the tiles whose counts differ by no more than the radius; those pairs are
compared in full, by numpy exclusive-or and bit counts. Large tiles are cut into chunks of a fixed
size, and a task holds one chunk while the fingerprints to compare stream past it.

From each comparison a spanning forest of the links is kept: never more edges than fingerprints
read. Components are the least document id that can be reached.

Null and empty texts have fingerprint 0 and link like any other. Equal fingerprints are one node.
Documents without an id count for nothing as a component's name unless they have only their like.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import add_columns, bytes_of, ship, unused
from touchline.sources.scratch import materialize

SEED = 42
QUARTERS = 4
# Fingerprints that a task holds at a time; a larger tile is held in several chunks.
CHUNK = 1 << 17
# Edges that one task of a round of components writes.
EDGES_PER_FILE = 100_000
_SPAN = 17  # a quarter has 0 to 16 bits set
_BLOCK = 1 << 21  # comparisons per numpy step


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The SimHash of the words of a text, A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    stops = (ends - 1)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    set_ = np.zeros(64, np.int64)
    for block in np.array_split(hashes, len(hashes) // 65536 + 1):
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_ += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * set_ > len(hashes), bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprints(
    df: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint", keep: list[str] | None = None
) -> DataFrame:
    """Add the fingerprint of each whole text as a 64-bit integer. No shuffle."""
    def make() -> Callable[[pa.Array], list[pa.Array]]:
        def compute(column: pa.Array) -> list[pa.Array]:
            found = np.array([fingerprint_of(one, shingle) for one in bytes_of(column)], np.uint64)
            return [pa.array(found.view(np.int64), pa.int64())]

        return compute

    return add_columns(df, text, f"`{name}` bigint", make, keep)


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """The count differences, by quarter, of at most `radius` in all."""
    found = [()]
    for _ in range(QUARTERS):
        found = [
            (*some, step) for some in found for step in range(-radius, radius + 1)
            if sum(map(abs, some)) + abs(step) <= radius
        ]
    return found


def _tile(fingerprint: Column) -> Column:
    """The population counts of the quarters as one number."""
    number = F.lit(0)
    for quarter in range(QUARTERS):
        part = F.shiftrightunsigned(fingerprint, 16 * quarter).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
        number = number * _SPAN + F.bit_count(part)
    return number


class Forest:
    """The chunk a task holds, with its components; visitors join or bridge them."""

    def __init__(self, home: np.ndarray, radius: int) -> None:
        self.home, self.radius = home, radius
        self.label = np.arange(len(home))

    def meet(self, visitors: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links from visitors to one member of each component that they link to."""
        step = max(1, _BLOCK // max(1, len(self.home)))
        for start in range(0, len(visitors), step):
            block = visitors[start:start + step]
            close = np.bitwise_count(block[:, None] ^ self.home[None, :]) <= self.radius
            for row in np.flatnonzero(close.any(axis=1)).tolist():
                near = np.flatnonzero(close[row])
                roots, first = np.unique(self.label[near], return_index=True)
                for partner in near[first].tolist():
                    if self.home[partner] != block[row]:
                        yield int(block[row]), int(self.home[partner])
                if len(roots) > 1:
                    self.label[np.isin(self.label, roots)] = roots[0]


def links(distinct: DataFrame, radius: int = 3, column: str = "fingerprint") -> DataFrame:
    """Pairs (a, b) of at most `radius` bits that connect all fingerprints which such pairs connect.

    `distinct` holds each fingerprint once. A fingerprint visits the tiles that can hold partners,
    in one direction of each tile pair, at most 65 of them, and there each chunk: so the rows that move grow
    with the chunks of a tile, one for each 131,072 fingerprints (1 MB) in it. Fingerprints are few bytes in few
    files, so they are dealt over the shuffle partitions before each becomes its visits.
    """
    ship()
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = distinct.select(F.col(column).alias("fp")).repartition(partitions, "fp")
    tiles = fps.withColumn("tile", _tile(F.col("fp")))
    # At most 17 ** 4 rows, whatever the input, of two integers.
    sizes = materialize(
        tiles.groupBy("tile").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).coalesce(1), "tiles"
    )
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF).cast("bigint")))
              for q in range(QUARTERS)]
    near = []
    for offset in _offsets(radius):
        if offset < (0,) * QUARTERS:
            continue  # the pair of tiles is met from the other side
        target, inside = F.lit(0), F.lit(True)
        for count, step in zip(counts, offset):
            target = target * _SPAN + (count + step)
            if step:
                inside = inside & (count + step).between(0, _SPAN - 1)
        near.append(F.when(inside, target))
    visits = fps.select("fp", F.explode(F.array_compact(F.array(*near))).alias("tile"))
    visits = visits.join(F.broadcast(sizes), "tile").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("visitor"), "fp"
    )
    home = tiles.join(F.broadcast(sizes), "tile").select(
        "tile", F.pmod(F.xxhash64("fp"), F.col("chunks").cast("bigint")).cast("int").alias("chunk"),
        F.lit(0).alias("visitor"), "fp",
    )
    both = home.unionByName(visits).repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "visitor")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, forest = None, [], None

        for batch in batches:
            tile, chunk, visitor = (batch.column(at).to_numpy() for at in range(3))
            fp = batch.column(3).to_numpy().view(np.uint64)
            change = (tile[1:] != tile[:-1]) | (chunk[1:] != chunk[:-1]) | (visitor[1:] != visitor[:-1])
            edges: list[tuple[int, int]] = []
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fp)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if (tile[start], chunk[start]) != place:
                    place, held, forest = (tile[start], chunk[start]), [], None
                if not visitor[start]:
                    held.append(fp[start:stop].copy())
                    continue
                if forest is None:
                    forest = Forest(np.concatenate(held) if held else fp[:0], radius)
                if len(forest.home):
                    edges += forest.meet(fp[start:stop])
            if edges:
                pairs = np.array(edges, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return both.mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): the least node of each component.

    Large-star and small-star steps in turn: each node points its larger neighbours, then its smaller
    ones, to the least of them, until only stars are left; the number of rounds grows with the
    logarithm of the nodes. Each round is written, so that lineage stays short. A hub's neighbours
    are joined to their least by a plain join that Spark may split.
    """
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    last, edges_left = None, current.count()
    while True:
        # Rounds never have more edges than the one before; a few edges need no more than a few files.
        files = max(1, -(-edges_left // EDGES_PER_FILE))
        # Each node's larger neighbours are pointed to the least of the node and its neighbours.
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Each node and its smaller neighbours are pointed to the least of them.
        smaller = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smaller, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        current = materialize(small.where("a <> b").distinct().coalesce(files), "edges")
        state = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == last:
            break
        last, edges_left = state, state.n
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(
    df: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add `fingerprint` (64-bit integer) and `component_id`, the least id of the linked documents.

    Documents move as (id, fingerprint) only, unless `keep` names wide columns.
    """
    kept = [name for name in (df.columns if keep is None else keep)]
    marked = fingerprints(df, shingle, text, "fingerprint", [*dict.fromkeys([*kept, doc_id])])
    if keep is not None:
        marked = materialize(marked, "fingerprints")
        nodes = marked.select("fingerprint", F.col(f"`{doc_id}`").alias("id"))
    else:
        nodes = materialize(fingerprints(df, shingle, text, "fingerprint", [doc_id]), "fingerprints")
        nodes = nodes.select("fingerprint", F.col(f"`{doc_id}`").alias("id"))
    first = materialize(nodes.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    found = components(links(first, radius))

    # Each component's least id, then back to every fingerprint that is in one.
    member = found.join(first, found["node"] == first["fingerprint"]).select("node", "root", "least")
    named = member.groupBy("root").agg(F.min("least").alias("component"))
    joined = member.join(named, "root").select(F.col("node").alias("fingerprint"), "component")
    names = materialize(
        first.join(joined, "fingerprint", "left")
        .select("fingerprint", F.coalesce("component", "least").alias("component_id")), "components"
    )
    marked = marked.select(*[f"`{name}`" for name in marked.columns if name.lower() != "component_id"])
    return marked.join(names, "fingerprint", "left")


def first_of_each(
    df: DataFrame, shingle: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of df whose id is their component's least: one document of each group stays.

    Rows that repeat an id stay or go together. A row without an id stays if its component has none.
    """
    marks = near_duplicates(df, shingle, radius, doc_id, text, keep=[doc_id])
    gone = marks.where(~F.col(f"`{doc_id}`").eqNullSafe(F.col("component_id"))).select(
        F.col(f"`{doc_id}`").alias("_gone"), F.lit(True).alias("_out")
    ).distinct()
    gone = materialize(gone, "near-copies")
    id_, out = unused(df, "_gone"), unused(df, "_out")
    gone = gone.toDF(id_, out)
    return df.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col(id_)), "left_anti")


def as_hex(fingerprint: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
