"""Prefix trie of conversations: which beginnings they share, and what sharing would save.

A node stands for a sequence of turns (role and text) that at least one conversation starts with;
the root stands for none. Turns are known by two 64-bit hashes of role and text, beginnings by two
rolling hashes over those, so any beginning of a conversation is told by 16 bytes (among 10^12
different ones the chance of any clash is below 10^-14).

Method: every task holds its conversations, a bounded number of turns at a time, in a z-fast trie.
That is a compacted trie whose nodes are hashed at a handle, the beginning whose length is the
two-fattest number on the node's edge. A fat binary search over lengths finds the exit node of a
conversation with a look-up per halving; a batch of conversations is located first and then
inserted, those that leave by one edge after another. At the end the edges are expanded, and
each turn's node goes out once for the whole batch of conversations, with its counts. Spark adds up
the nodes of all tasks, so a beginning that very many share arrives as one row a batch, and no
task holds all that start alike.

Sums over subtrees need no recursion over tasks. Each node belongs to its smallest conversation,
and a conversation owns the end of its path from some depth on. Once those depths are known, which
takes a first pass, every sum over a subtree is one over the members of its top: a task adds what
they own below it.

One conversation's hashes (24 bytes a turn) lie in one task, as do the conversations of one hundred
numbers that share a beginning. The hash of the ids that end in a node is a chain and is computed
in one task, over a stream of sorted pieces.

Edge cases: rows without conv_id belong to no conversation; null roles and texts are empty; turns
of equal number follow one another by their hashes, so repeated rows are repeated turns. A
conversation may have no turn: it ends in the root. No conversation, no node. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.operators.joins import lookup_join
from sparkmart.session import materialise, workspace

from . import text as tx

BATCH_TURNS = 1 << 18
PIECE_IDS = 1 << 16

_U = np.uint64
_BASES = (0xD1342543DE82EF95, 0x9E3779B97F4A7C15)

_FIRST = "k1 long, k2 long, p1 long, p2 long, depth long, owner long, deepest long"
_SECOND = (
    "k1 long, k2 long, depth long, owner long, parent long, n_convs long, n_children long, "
    "n_leaves long, saved long"
)


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & -1 << (low ^ high).bit_length() - 1


class Paths:
    """The beginnings of some conversations, by 16 bytes each; the root's come first."""

    def __init__(self, sizes: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """``sizes`` are numbers of turns, the others the hashes of all turns."""
        self.sizes = sizes
        ends = np.cumsum(sizes)
        self.starts = ends - sizes + np.arange(len(sizes))  # where each one's root key lies
        lanes = []
        for base, hashes in zip(_BASES, (first, second), strict=True):
            # The powers go on over all turns, and are taken back to the conversation's first.
            n = len(hashes)
            factors = np.full(n + 1, base, np.uint64)
            factors[0] = 1
            factors = np.cumprod(factors, dtype=np.uint64)
            inverse = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            inverse = np.cumprod(inverse, dtype=np.uint64)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(tx.mix(hashes) * factors[:n], out=sums[1:])
            at = tx.ranges(ends - sizes, sizes + 1)
            origin = np.repeat(ends - sizes, sizes + 1)
            depth = (at - origin).astype(np.uint64)
            lanes.append(tx.mix((sums[at] - sums[origin]) * inverse[origin] + depth))
        self.keys = np.stack(lanes, axis=1)
        self.spelled = self.keys.tobytes()

    def key(self, i: int, depth: int) -> bytes:
        """The first ``depth`` turns of conversation i."""
        at = 16 * (int(self.starts[i]) + depth)
        return self.spelled[at : at + 16]

    def common(self, i: int, j: int, low: int, high: int) -> int:
        """How many turns i and j share, known to be between ``low`` and ``high``."""
        while low < high:
            middle = (low + high + 1) // 2
            if self.key(i, middle) == self.key(j, middle):
                low = middle
            else:
                high = middle - 1
        return low


class ZFastTrie:
    """A compacted trie of paths, with handles; node 0 is the root."""

    def __init__(self, paths: Paths) -> None:
        self.paths = paths
        self.above, self.ends, self.path, self.parent = [-1], [0], [-1], [-1]
        self.handles: dict[tuple[int, bytes], int] = {}
        self.edges: dict[tuple[int, bytes], int] = {}
        self.stops: dict[int, int] = {}  # the node at which each path ends

    def _link(self, node: int, above: int, parent: int) -> None:
        """Hang ``node`` below depth ``above``, with its handle and the first turn of its edge."""
        self.above[node], self.parent[node] = above, parent
        i, end = self.path[node], self.ends[node]
        fat = two_fattest(above, end)
        self.handles[fat, self.paths.key(i, fat)] = node
        self.edges[above + 1, self.paths.key(i, above + 1)] = node

    def _grow(self, i: int, above: int, end: int, parent: int) -> int:
        node = len(self.ends)
        self.above.append(above)
        self.ends.append(end)
        self.path.append(i)
        self.parent.append(parent)
        self._link(node, above, parent)
        return node

    def exit(self, i: int, node: int = 0) -> tuple[int, int]:
        """The node on whose edge path i leaves the trie (or ends), and the turns they share.

        The search starts below ``node``, which lies on the path.
        """
        key, size = self.paths.key, int(self.paths.sizes[i])
        low, high = self.ends[node], size
        while low < high:
            fat = two_fattest(low, high)
            found = self.handles.get((fat, key(i, fat)))
            if found is None:
                high = fat - 1
                continue
            end = self.ends[found]
            if end > size or key(i, end) != key(self.path[found], end):
                return found, self.paths.common(i, self.path[found], fat, min(end, size))
            node, low = found, end
        if low < size:
            below = self.edges.get((low + 1, key(i, low + 1)))
            if below is not None:  # it leaves before the handle of that edge
                end = min(self.ends[below], size)
                return below, self.paths.common(i, self.path[below], low + 1, end)
        return node, low

    def _split(self, node: int, depth: int) -> int:
        """A node in the middle of an edge; what was below it stays there."""
        above, parent, i = self.above[node], self.parent[node], self.path[node]
        fat = two_fattest(above, self.ends[node])
        del self.handles[fat, self.paths.key(i, fat)]
        middle = self._grow(i, above, depth, parent)
        self._link(node, depth, middle)
        return middle

    def insert(self, batch: Iterable[int]) -> None:
        """Locate all paths of the batch, then insert them by exit node."""
        waiting: dict[int, list[int]] = {}
        for i in batch:
            node, shared = self.exit(i)
            if shared == self.ends[node] == self.paths.sizes[i]:
                self.stops[i] = node
            else:
                waiting.setdefault(node, []).append(i)
        for node, paths in waiting.items():
            # Edges change only below the depth at which this one begins, where the search goes on.
            top = self.parent[node] if node else 0
            for i in paths:
                self._add(i, top)

    def _add(self, i: int, top: int) -> None:
        node, shared = self.exit(i, top)
        if shared < self.ends[node]:
            node = self._split(node, shared)
        if shared < self.paths.sizes[i]:
            node = self._grow(i, shared, int(self.paths.sizes[i]), node)
        self.stops[i] = node


class Batch:
    """Conversations of one batch in a trie, and the sums over its edges."""

    def __init__(self, columns: dict[str, np.ndarray], sizes: np.ndarray) -> None:
        self.columns = columns
        self.paths = Paths(sizes, columns["h1"].view(np.uint64), columns["h2"].view(np.uint64))
        trie = ZFastTrie(self.paths)
        # Paths that end alike are one path.
        last = self.paths.keys[self.paths.starts + sizes]
        _, firsts, group = np.unique(
            last, axis=0, return_index=True, return_inverse=True
        )
        for low in range(0, len(firsts), 1024):
            trie.insert(int(i) for i in firsts[low : low + 1024])
        stop = np.array([trie.stops[int(i)] for i in firsts], np.int64)[group.reshape(-1)]
        self.above = np.array(trie.above)
        self.ends = np.array(trie.ends)
        self.path = np.array(trie.path)
        self.path[0] = 0  # any path begins with the root
        self.parent = np.array(trie.parent)
        n = len(self.ends)
        ids = columns["conv_id"]
        self.convs = np.bincount(stop, minlength=n).astype(np.int64)
        self.owner = np.full(n, np.iinfo(np.int64).max)
        self.leader = np.full(n, -1)  # the place of the smallest conversation
        for place in np.argsort(-ids, kind="stable"):
            self.leader[stop[place]] = place
        np.minimum.at(self.owner, stop, ids)
        self.deepest = self.ends.copy()
        self.upwards = np.argsort(-self.ends, kind="stable")
        for node in self.upwards:
            above = self.parent[node]
            if above >= 0:
                self.convs[above] += self.convs[node]
                self.deepest[above] = max(self.deepest[above], self.deepest[node])
                if self.owner[node] < self.owner[above]:
                    self.owner[above], self.leader[above] = self.owner[node], self.leader[node]
        # The expanded edges: node, depth and place among the keys of every turn's node.
        spans = self.ends - self.above
        self.node = np.repeat(np.arange(n), spans)
        self.depth = tx.ranges(self.above + 1, spans)
        self.at = self.paths.starts[self.path[self.node]] + self.depth

    def _keys(self, at: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(self.paths.keys[at, i]).view(np.int64) for i in (0, 1)]

    def first(self) -> list[np.ndarray]:
        """Rows of ``_FIRST``."""
        above = np.where(self.depth > 0, self.at - 1, self.at)
        return [
            *self._keys(self.at),
            *self._keys(above),
            self.depth,
            self.owner[self.node],
            self.deepest[self.node],
        ]

    def second(self) -> list[np.ndarray]:
        """Rows of ``_SECOND``, what the owners' depths tell."""
        lead = self.leader[self.node]
        since = self.columns["since"][lead]
        own = since <= self.depth  # is the smallest one here the smallest of all?
        tokens = np.zeros(len(self.depth), np.int64)
        inner = self.depth > 0
        turn = self.at - self.path[self.node] - 1  # without the roots' keys
        tokens[inner] = self.columns["size"][turn[inner]]
        saved = (self.convs[self.node] - own) * tokens
        leaf = own & (self.depth == self.ends[self.node]) & self.columns["leaf"][lead]
        leaf &= self.columns["n"][lead] == self.depth
        n = len(self.ends)
        below = np.zeros((3, n), np.int64)  # sums below the end of each edge: saved, leaves, children
        total = [np.bincount(self.node, w, n).astype(np.int64) for w in (leaf,)]
        saved_total = np.zeros(n, np.int64)
        np.add.at(saved_total, self.node, saved)
        first_own = np.zeros(n, np.int64)  # whether the edge's first node is owned
        starts = np.cumsum(self.ends - self.above) - (self.ends - self.above)
        first_own[:] = own[starts]
        for node in self.upwards:
            above = self.parent[node]
            if above >= 0:
                below[0, above] += saved_total[node] + below[0, node]
                below[1, above] += total[0][node] + below[1, node]
                below[2, above] += first_own[node]

        def onwards(values: np.ndarray) -> np.ndarray:
            """Sums from each node to the end of its edge."""
            sums = np.append(0, np.cumsum(values))
            ends = starts + (self.ends - self.above)
            return sums[ends[self.node]] - sums[:-1]

        at_end = self.depth == self.ends[self.node]
        children = np.where(at_end, below[2][self.node], np.append(own[1:], False))
        top = self.columns["top_parent"][lead]
        parent = np.where(since < self.depth, self.owner[self.node], top)
        return [
            *self._keys(self.at),
            self.depth,
            self.owner[self.node],
            np.where(own & (self.depth > 0), parent, np.iinfo(np.int64).min),
            self.convs[self.node],
            children.astype(np.int64),
            onwards(leaf.astype(np.int64)) + below[1][self.node],
            onwards(saved) + below[0][self.node],
        ]


def _turns(batch: pa.RecordBatch) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The columns of a batch of conversations, and their numbers of turns."""
    columns, sizes = {}, None
    for name in batch.schema.names:
        column = batch.column(name)
        if name == "turns":
            sizes = np.diff(np.asarray(column.offsets)).astype(np.int64)
            turns = column.flatten()
            for inner in ("h1", "h2", "size"):
                columns[inner] = np.asarray(turns.field(inner)).astype(np.int64)
        else:
            columns[name] = np.asarray(column.to_numpy(zero_copy_only=False))
    columns["n"] = sizes
    return columns, sizes


def _in_batches(rows: Callable[[Batch], list[np.ndarray]], names: list[str], most: int) -> Callable:
    """Run tries over the conversations of a task, ``most`` turns at a time."""

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            columns = {k: np.concatenate([c[k] for c, _ in held]) for k in held[0][0]}
            out = rows(Batch(columns, np.concatenate([s for _, s in held])))
            nulls = [
                pa.array(c, pa.int64(), mask=(c == np.iinfo(np.int64).min) if n == "parent" else None)
                for n, c in zip(names, out, strict=True)
            ]
            done = pa.RecordBatch.from_arrays(nulls, names=names)
            for low in range(0, done.num_rows, 1 << 16):
                yield done.slice(low, 1 << 16)

        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_turns(batch))
            n += int(held[-1][1].sum()) + batch.num_rows
            if n >= most:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    return expand


def rebuilt(
    conversations: DataFrame, head: Callable[[Column], Column] | None = None, per: int = 100
) -> DataFrame:
    """``conv_id`` and ``turns`` (h1, h2 and size, the text's code points, in order) of each one.

    With ``head``, the first ``head(conv_id)`` turns of conversation ``c - c % per`` take the place
    of as many own ones. The shuffle moves hashes, and one serves the grouping and the heads.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select(
        conv.alias("conv_id"),
        (conv - conv % per).alias("hub"),
        F.struct(
            F.col("turn"),
            F.xxhash64(role, text).alias("h1"),
            F.xxhash64(F.lit(1), role, text).alias("h2"),
            F.length(text).cast("long").alias("size"),
        ).alias("turn"),
    )
    grouped = (
        turns.repartition("hub")
        .groupBy("hub", "conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .withColumn("turns", F.transform("turns", lambda t: t.dropFields("turn")))
    )
    if head is None:
        return grouped.select("conv_id", "turns")
    hub = Window.partitionBy("hub")
    n = head(F.col("conv_id")).cast("int")
    first = F.first(F.when(F.col("conv_id") == F.col("hub"), F.col("turns")), True).over(hub)
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0)))
    headed = grouped.withColumn("_head", first)
    return headed.select(
        "conv_id",
        F.concat(F.coalesce(F.slice("_head", F.lit(1), n), none), own).alias("turns"),
    )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, which come one after another."""
    key, state, done = None, None, []

    def out() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else ([], [], [])
        types = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (k1, k2) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        yield out()
        done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield out()


def _ends(stops: DataFrame) -> DataFrame:
    """The hash of the ids that end in each node; ``stops`` has k1, k2 and conv_id.

    Ids are joined in pieces of neighbouring numbers first, so a node where very many end comes
    to its task in few rows.
    """
    pieces = (
        stops.withColumn("piece", F.floor(F.col("conv_id") / PIECE_IDS))
        .groupBy("k1", "k2", "piece")
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("k1", "k2", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )
    return (
        pieces.repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "piece")
        .mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    )


def _stop_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of the whole of each conversation."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns, sizes = _turns(batch)
        paths = Paths(sizes, columns["h1"].view(np.uint64), columns["h2"].view(np.uint64))
        last = paths.keys[paths.starts + sizes].view(np.int64)
        arrays = [pa.array(c) for c in (last[:, 0], last[:, 1], columns["conv_id"])]
        yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "conv_id"])


def trie(convs: DataFrame, *, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """One row per node of the trie of ``convs``, which has conv_id (unique) and turns.

    conv_id is the smallest conversation that passes through or ends, depth the number of turns,
    parent_conv_id the parent's conv_id (the root has none), n_convs the conversations,
    n_children and n_leaves nodes below, saved_tokens the code points that sharing saves in the
    subtree, and ends_sha256 the hash of the conversations that end here.
    """
    folder = workspace(convs.sparkSession, "prefix-trie")
    convs = materialise(convs.select("conv_id", "turns"), f"{folder}/turns")
    names = [c.split()[0] for c in _FIRST.split(", ")]
    parts = convs.mapInArrow(_in_batches(Batch.first, names, batch_turns), _FIRST)
    nodes = parts.groupBy("k1", "k2", "depth").agg(
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.min("owner").alias("owner"),
        F.max("deepest").alias("deepest"),
    )
    nodes = materialise(nodes, f"{folder}/nodes")

    # From which depth on each conversation owns its path, and who owns the node above.
    above = F.struct("p1", "p2")
    owned = nodes.groupBy("owner").agg(
        F.min("depth").alias("since"),
        F.min_by(above, "depth").alias("_above"),
        F.bool_or(F.col("deepest") == F.col("depth")).alias("leaf"),
    )
    owned = owned.select(
        F.col("owner").alias("conv_id"), "since", "leaf", F.col("_above.p1").alias("k1"), F.col("_above.p2").alias("k2")
    )
    owners = nodes.select("k1", "k2", F.col("owner").alias("top_parent"))
    owned = materialise(owned, f"{folder}/owned")
    owned = lookup_join(owned, owners, ["k1", "k2"], "left").drop("k1", "k2")
    never = F.lit((1 << 63) - 1)
    known = convs.join(owned, "conv_id", "left").select(
        "conv_id",
        "turns",
        F.coalesce("since", never).alias("since"),
        F.coalesce("leaf", F.lit(False)).alias("leaf"),
        F.coalesce("top_parent", F.lit(0)).alias("top_parent"),
    )
    names = [c.split()[0] for c in _SECOND.split(", ")]
    parts = known.mapInArrow(_in_batches(Batch.second, names, batch_turns), _SECOND)
    summed = parts.groupBy("k1", "k2").agg(
        F.min("owner").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.max("parent").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")],
        F.sum("saved").alias("saved_tokens"),
    )
    stops = convs.mapInArrow(_stop_rows, "k1 long, k2 long, conv_id long")
    empty = hashlib.sha256().hexdigest()
    return (
        summed.join(_ends(stops), ["k1", "k2"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
        .drop("k1", "k2")
    )


def crc_head(most: int) -> Callable[[Column], Column]:
    """Number of shared turns from the CRC-32 of the decimal id, below ``most``."""
    return lambda conv: F.crc32(conv.cast("string").cast("binary")) % most
