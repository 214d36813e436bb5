"""Prefix trie of conversations, by double-array tries per prefix shard.

A conversation is a sequence of turns (role, text); a node of depth d is a distinct sequence of first d
turns, the root the empty one. Turns are compared by 128-bit digests.

Conversations that are equal as a whole become one sequence with their number, least id and the
digest of their ids. Sequences are dealt by their shard: the shortest beginning that at most `most`
sequences share, so that a beginning of a third of all conversations is split where they part. A task
numbers the turns of a few whole shards densely and packs a double array for them: the child of state s
by turn t is state BASE[s] + t, if CHECK there says s. Traversing it level by level gives the nodes and,
from the last level back, the sums over their subtrees. Nodes above a shard's own beginning are shared
with other shards: there each task gives its part, and the parts are merged over all tasks. Only the
beginnings of more than `most` sequences are shared, besides the root; their sums over subtrees take
a number of rounds that grows with the logarithm of their depth.

Turns without a conversation id belong to none and are left out. Null roles and texts are empty. Turns
are in the order of their number, null first, those with the same number by digest; turns that are
repeated as a whole count each. Ids are integers. A conversation's turns are read in a stream, and its
digests, 16 bytes a turn, are held by one task; texts are never held together. An empty table has no
conversation and so no node, not even a root. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import list_array, ship
from touchline.sources.scratch import materialize

# Sequences that share a beginning before it is split further, and turns of the shards packed together.
MOST_SEQUENCES = 1 << 9
PACKED_TURNS = 1 << 16
# Whole-conversation groups are handed on after so many bytes of ids and turns.
HELD_BYTES = 16 << 20
# Slots that are tried for a state with several children before they go behind the last one.
TRIES = 64
ROOT = 0  # the key of the root among the shared nodes
NO_IDS = hashlib.sha256(b"").hexdigest()
_DIGEST = 16


# --- conversations ------------------------------------------------------------------------


def turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, digest, size): a row a turn; texts end here, as digests and sizes in bytes."""
    r, t = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in (role, text))
    # The role's length keeps (ab, c) and (a, bc) apart.
    joined = F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary")
    return df.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(joined)).alias("digest"), F.octet_length(t).cast("bigint").alias("size"),
    )


class _Groups:
    """Equal conversations put together while they stream past in the order of their ids."""

    def __init__(self) -> None:
        self.held: dict[bytes, list] = {}
        self.bytes = 0

    def add(self, conv: int, path: bytes, sizes: bytes) -> None:
        key = hashlib.md5(path).digest()
        found = self.held.get(key)
        if found is None:
            found = self.held[key] = [conv, 0, [], path, sizes]
            self.bytes += len(path) + len(sizes) + 300
        found[1] += 1
        found[2].append(str(conv))
        self.bytes += 64

    def take(self) -> pa.RecordBatch:
        rows = list(self.held.items())
        out = pa.RecordBatch.from_arrays([
            pa.array([key for key, _ in rows], pa.binary()), pa.array([row[0] for _, row in rows], pa.int64()),
            pa.array([row[1] for _, row in rows], pa.int64()), pa.array([",".join(row[2]) for _, row in rows], pa.string()),
            pa.array([row[3] for _, row in rows], pa.binary()), pa.array([row[4] for _, row in rows], pa.binary()),
        ], ["key", "least", "n", "ids", "path", "sizes"])
        self.held, self.bytes = {}, 0
        return out


_BLOCKS = "key binary, least bigint, n bigint, ids string, path binary, sizes binary"


def shared_starts(span: int = 5, most: int = 9) -> Callable[[int], tuple[int, int]]:
    """The rule by which the query rebuilds conversations: c begins with the first h turns of the one at
    c - c % span, h being the CRC-32 of c in decimal modulo `most`."""
    return lambda c: (c - c % span, zlib.crc32(str(c).encode()) % most)


def sequences(
    found: DataFrame, starts: Callable[[int], tuple[int, int]] | None = None, span: int = 1, most_start: int = 0,
) -> DataFrame:
    """(key, n, least, ends, path, sizes) of the distinct whole conversations of `turns()`.

    `path` holds the digests, `sizes` the sizes of the turns; `ends` is the SHA-256 of the ids, ascending,
    joined by commas. With `starts`, a conversation c is rebuilt from the first h turns of another one, a,
    and its own from there on, for (a, h) = starts(c); a must be the least id of c's block of `span` ids,
    and h at most `most_start`.

    Turns move once, in the order of their ids, blocks whole; equal conversations are put together
    before they move on, so a group of any size sends few rows, and its ids are read in a stream.
    """
    ship()
    block = F.col("conv_id") - F.pmod("conv_id", F.lit(span).cast("bigint"))
    ordered = found.withColumn("block", block).repartitionByRange("block").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "digest"
    ).select("block", "conv_id", "digest", "size")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups()
        at = here = None
        first: list[tuple[bytes, int]] = []  # the first turns of the block's least id, if that is there
        skip, seen, path, sizes = 0, 0, [], []

        def close() -> None:
            if here is not None:
                groups.add(here, b"".join(path), np.array(sizes, np.int64).tobytes())

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("block", "conv_id", "digest", "size"))
            for own, conv, digest, size in zip(*columns):
                if conv != here:
                    close()
                    if own != at:
                        at, first = own, []
                    here, seen, path, sizes = conv, 0, [], []
                    skip = 0
                    if starts is not None:
                        source, skip = starts(conv)
                        # The first conversation of a block begins with itself.
                        start = first[:skip] if source != conv else []
                        skip = skip if source != conv else 0
                        path, sizes = [one[0] for one in start], [one[1] for one in start]
                if conv == own and len(first) < most_start:
                    first.append((digest, size))
                if seen >= skip:
                    path.append(digest)
                    sizes.append(size)
                seen += 1
                if groups.bytes > HELD_BYTES:
                    yield groups.take()
        close()
        yield groups.take()

    # Each task has a range of ids, and its blocks come in their order.
    blocks = ordered.mapInArrow(rebuild, _BLOCKS)
    dealt = blocks.repartition("key").sortWithinPartitions("key", "least")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, ids = None, None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            names = ["key", "n", "least", "ends", "path", "sizes", "chain"]
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            chains = [chain_of(row[4]) for row in rows]
            values = pa.array(np.concatenate([np.empty(0, np.int64), *chains]), pa.int64())
            return pa.RecordBatch.from_arrays([*arrays, list_array(values, [len(one) for one in chains])], names)

        for batch in batches:
            done = []
            for one in zip(*(batch.column(name) for name in ("key", "least", "n", "ids", "path", "sizes"))):
                own, least, n, listed = (value.as_py() for value in one[:4])
                if own != key:
                    if key is not None:
                        done.append((key, row[0], row[1], ids.hexdigest(), *row[2:]))
                    key, row, ids = own, [0, least, one[4].as_py(), one[5].as_py()], hashlib.sha256()
                elif row[0]:
                    ids.update(b",")
                row[0] += n
                ids.update(listed.encode())
            if done:
                yield table(done)
        if key is not None:
            yield table([(key, row[0], row[1], ids.hexdigest(), *row[2:])])

    schema = "key binary, n bigint, least bigint, ends string, path binary, sizes binary, chain array<bigint>"
    return dealt.mapInArrow(merge, schema)


def chain_of(path: bytes) -> np.ndarray:
    """A key for each beginning of a sequence, from the one of length 1 on; never that of the root."""
    words = np.frombuffer(path, np.uint64).reshape(-1, 2)
    found, state = np.empty(len(words), np.uint64), 0x9E3779B97F4A7C15
    for at, (low, high) in enumerate(words.tolist()):
        state = ((state ^ low) * 0xBF58476D1CE4E5B9 + high) & 0xFFFFFFFFFFFFFFFF
        state = ((state ^ (state >> 29)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        state ^= state >> 32
        found[at] = state or 1
    return found.view(np.int64)


# --- double arrays ------------------------------------------------------------------------


class DoubleArray:
    """A trie over sequences of dense turn ids (from 1 on), built level by level.

    State 0 is the root. `base` may be negative, as long as all children have slots from 1 on.
    """

    def __init__(self) -> None:
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self.check[0] = 0
        self.low, self.end = 1, 1  # no slot below `low` is free, none from `end` on is taken

    def _reserve(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free(self, wanted: int) -> np.ndarray:
        """The first `wanted` free slots; behind the last one taken all are free."""
        taken = self.check[self.low: self.end]
        holes = self.low + np.flatnonzero(taken < 0)[:wanted]
        return np.concatenate([holes, np.arange(self.end, self.end + wanted - len(holes))])

    def _claim(self, slots: np.ndarray, owner) -> None:
        self._reserve(int(slots.max()) + 1)
        self.check[slots] = owner
        self.end = max(self.end, int(slots.max()) + 1)

    def add_level(self, parent: np.ndarray, label: np.ndarray) -> None:
        """Give the children (parent, label), distinct and in that order, their slots."""
        if not len(parent):
            return
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(parent)]]))
        for start, count in sorted(zip(starts[counts > 1].tolist(), counts[counts > 1].tolist()), key=lambda one: -one[1]):
            labels = label[start:start + count]
            span = int(labels[-1] - labels[0])
            base = None
            for first in self._free(TRIES).tolist():
                self._reserve(first + span + 1)
                if (self.check[first + labels - labels[0]] < 0).all():
                    base = first - int(labels[0])
                    break
            if base is None:
                base = self.end - int(labels[0])
            self.base[parent[start]] = base
            self._claim(base + labels, parent[start])
        # An only child takes any free slot: so the holes are filled.
        alone = starts[counts == 1]
        if len(alone):
            slots = self._free(len(alone))
            self.base[parent[alone]] = slots - label[alone]
            self._claim(slots, parent[alone])
        taken = self.check[self.low: self.end]
        holes = np.flatnonzero(taken < 0)
        self.low = self.low + int(holes[0]) if len(holes) else self.end

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The states reached; -1 where there is none."""
        to = self.base[state] + label
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == state) & (to > 0), to, -1)


class Packed:
    """The trie of some sequences with what is known of its nodes, by state."""

    def __init__(self, paths: list[np.ndarray]) -> None:
        """`paths`: the digests of each sequence, as rows of two words."""
        self.lengths = np.array([len(path) for path in paths], np.int64)
        flat = np.concatenate([np.empty((0, 2), np.uint64), *paths])
        # Dense turn ids.
        _, ids = np.unique(flat.view([("a", np.uint64), ("b", np.uint64)]).reshape(-1), return_inverse=True)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.trie = DoubleArray()
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (sequences that reach the depth, their states)
        at = np.zeros(len(paths), np.int64)
        active = np.arange(len(paths))
        self.levels.append((active, at))
        depth = 0
        while True:
            going = self.lengths[active] > depth
            active, at = active[going], at[going]
            if not len(active):
                break
            label = ids[self.starts[active] + depth] + 1
            self.trie.add_level(*np.divmod(np.unique(at * (len(ids) + 1) + label), len(ids) + 1))
            at = self.trie.step(at, label)
            self.levels.append((active, at))
            depth += 1

    def totals(self, n: np.ndarray, least: np.ndarray, sizes: np.ndarray, inner: np.ndarray) -> dict[str, np.ndarray]:
        """By state: members, least id, size of the last turn, children, leaves and saved bytes of the subtree.

        `inner` is the depth from which on a sequence's nodes are its shard's own. Only those count as
        children and in the sums over subtrees; the others are shared, and their own part is added later.
        """
        width = self.trie.end
        found = {name: np.zeros(width, np.int64) for name in ("n", "size", "children", "leaves", "saved", "depth")}
        found["least"] = np.full(width, np.iinfo(np.int64).max)
        found["own"], found["sequence"] = np.zeros(width, bool), np.full(width, -1)
        for depth, (active, at) in enumerate(self.levels):
            np.add.at(found["n"], at, n[active])
            np.minimum.at(found["least"], at, least[active])
            found["depth"][at] = depth
            found["sequence"][at] = active
            found["own"][at] = inner[active] <= depth
            if depth:
                found["size"][at] = sizes[self.starts[active] + depth - 1]
        for depth in range(len(self.levels) - 1, -1, -1):
            states = np.unique(self.levels[depth][1])
            own = states[found["own"][states]]
            found["leaves"][own[found["children"][own] == 0]] = 1
            found["saved"][own] += (found["n"][own] - 1) * found["size"][own]
            if depth:
                # Shared nodes get the sums of their own children's subtrees, and hand nothing on here.
                above = self.trie.check[own]
                np.add.at(found["leaves"], above, found["leaves"][own])
                np.add.at(found["saved"], above, found["saved"][own])
                np.add.at(found["children"], above, 1)
        return found


_NODES = (
    "own boolean, key bigint, parent_key bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, ends_sha256 string"
)


def _nodes_of(rows: list[tuple]) -> pa.RecordBatch:
    """The nodes of some whole shards; rows of (n, least, ends, path, sizes, chain, inner)."""
    packed = Packed([np.frombuffer(row[3], np.uint64).reshape(-1, 2) for row in rows])
    n, least = (np.array([row[i] for row in rows], np.int64) for i in (0, 1))
    sizes = np.frombuffer(b"".join(row[4] for row in rows), np.int64)
    found = packed.totals(n, least, sizes, np.array([row[6] for row in rows], np.int64))
    ends: dict[int, str] = {}
    for depth, (active, at) in enumerate(packed.levels):
        last = packed.lengths[active] == depth
        ends.update((state, rows[one][2]) for state, one in zip(at[last].tolist(), active[last].tolist()))
    states = np.unique(np.concatenate([at for _, at in packed.levels]))
    above = packed.trie.check[states]
    own, depth = found["own"][states], found["depth"][states]

    def keys(of: np.ndarray) -> pa.Array:
        """The key of shared states; that of the root is ROOT."""
        values = []
        for state in of.tolist():
            d = int(found["depth"][state])
            values.append(ROOT if d == 0 else int(rows[found["sequence"][state]][5][d - 1]))
        return values

    # Keys are needed of shared nodes, and of those above a shard's own.
    shared, edge = ~own, ~found["own"][above] & (states > 0)
    key, parent_key = [None] * len(states), [None] * len(states)
    for at, value in zip(np.flatnonzero(shared).tolist(), keys(states[shared])):
        key[at] = value
    for at, value in zip(np.flatnonzero(edge).tolist(), keys(above[edge])):
        parent_key[at] = value
    parents = [None if cut else int(conv) for cut, conv in zip((edge | (states == 0)).tolist(), found["least"][above].tolist())]
    columns = [
        pa.array(own), pa.array(key, pa.int64()), pa.array(parent_key, pa.int64()), pa.array(found["least"][states]),
        pa.array(depth), pa.array(parents, pa.int64()),
        *[pa.array(found[name][states]) for name in ("n", "children", "leaves", "saved", "size")],
        pa.array([ends.get(state, None if not mine else NO_IDS) for state, mine in zip(states.tolist(), own.tolist())], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [part.strip().split()[0] for part in _NODES.split(",")])


def _shards(found: DataFrame, most: int) -> DataFrame:
    """`sequences()` with `inner`, the length of the shard's beginning, and `shard`, its key.

    Beginnings are counted over all sequences, combined before they move. Those of more than `most` are
    at most (sequences / most) at each depth; the sequences that have them learn how far they go.
    """
    each = found.select("key", F.explode("chain").alias("start"))
    hot = materialize(each.groupBy("start").count().where(F.col("count") > most).select("start"), "shared-starts")
    placed = found.select("key", F.posexplode("chain").alias("place", "start"))
    deep = placed.join(hot, "start").groupBy("key").agg((F.max("place") + 2).alias("inner"))
    deep = deep.withColumnRenamed("key", "_key")
    out = found.join(deep, found["key"] == deep["_key"], "left").drop("_key")
    out = out.withColumn("inner", F.coalesce("inner", F.lit(1)))
    # A sequence that ends within shared beginnings goes by the last of them.
    last = F.least(F.col("inner"), F.size("chain"))
    return out.withColumn("shard", F.coalesce(F.get("chain", last - 1), F.lit(ROOT).cast("bigint")))


def _merged(parts: DataFrame) -> DataFrame:
    """The shared nodes from their parts, with the sums over their subtrees, by pointer jumping upwards."""
    nodes = materialize(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("size").alias("size"), F.max("ends_sha256").alias("ends_sha256"),
    ), "shared-nodes")
    below = nodes.where("parent_key is not null").groupBy("parent_key").count()
    below = below.select(F.col("parent_key").alias("_of"), F.col("count").alias("more"))
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    nodes = materialize(nodes.join(below, nodes["key"] == below["_of"], "left").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", "size", "ends_sha256", children.alias("n_children"),
        # Without children a shared node is a leaf itself.
        (F.col("n_leaves") + (children == 0).cast("bigint")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    ), "shared-nodes")
    sums = nodes.select("key", F.col("parent_key").alias("up"), "n_leaves", "saved_tokens")
    while not sums.where("up is not null").isEmpty():
        # Each node's sums reach twice as far down as in the round before.
        given = sums.where("up is not null").groupBy("up").agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        ).withColumnRenamed("up", "_to")
        further = sums.select(F.col("key").alias("_key"), F.col("up").alias("further"))
        sums = materialize(
            sums.join(given, sums["key"] == given["_to"], "left").join(further, F.col("up") == F.col("_key"), "left").select(
                "key", F.col("further").alias("up"), (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
            ), "shared-sums",
        )
    return nodes.drop("n_leaves", "saved_tokens").join(sums.drop("up"), "key")


def prefix_nodes(found: DataFrame, most: int = MOST_SEQUENCES, packed: int = PACKED_TURNS) -> DataFrame:
    """The nodes of the trie over `sequences()`: conv_id (the least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    ship()
    dealt = _shards(materialize(found, "sequences"), most).select(
        "shard", "n", "least", "ends", "path", "sizes", "chain", "inner"
    ).repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, turns_, at = [], 0, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("shard", "n", "least", "ends", "path", "sizes")]
            chains = batch.column("chain")
            for row, (shard, *one) in enumerate(zip(*columns)):
                if shard != at and turns_ >= packed:
                    yield _nodes_of(rows)
                    rows, turns_ = [], 0
                at = shard
                inner = batch.column("inner")[row].as_py()
                rows.append((*one, chains[row].values.to_numpy(), inner))
                turns_ += len(one[3]) // _DIGEST
        if rows:
            yield _nodes_of(rows)

    nodes = materialize(dealt.mapInArrow(run, _NODES), "nodes")
    shared = materialize(_merged(nodes.where("not own")), "shared")
    above = shared.select(F.col("key").alias("_key"), F.col("conv_id").alias("above"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    edge = nodes.where("own and parent_key is not null").join(above, F.col("parent_key") == F.col("_key"), "left")
    inside = nodes.where("own and parent_key is null")
    top = shared.join(above, F.col("parent_key") == F.col("_key"), "left")
    top = top.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    return inside.select(*names).unionByName(edge.withColumn("parent_conv_id", F.col("above")).select(*names)).unionByName(
        top.withColumn("parent_conv_id", F.col("above")).select(*names)
    )
