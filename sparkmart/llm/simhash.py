"""SimHash near-dedup: fingerprints of word shingles, linked within a Hamming radius.

Method: tiled exact comparison with numpy exclusive-or and bit counts; tile pairs whose
population counts differ by more than the radius are skipped.

Equal fingerprints are one node first. Which tiles can meet follows from the pigeonhole
principle: of ``radius + 1`` bit bands of a linked pair, at least one is equal, so nodes are
dealt by band value and compared, tile against tile, among those with the same value.
A band value with more than ``TILE`` nodes is split by population count, and a count with many
nodes once more by a hash: each such cell is a task of its own that meets the cells within the
radius. Every tile pair gives the edges of a spanning forest, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.joins import salted_join
from sparkmart.session import materialise, workspace

from . import text as tx
from .components import components

TILE = 4096
TILES_PER_TASK = 16
#: Rows of one fingerprint (exact copies, texts without a word) that a single task may be given.
ROWS_PER_TASK = 4_000_000
SEED = 42

_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[0x41:0x5B] += 0x20


def _fingerprints_of(shingle: int):
    def fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, 1, 1 << 20):
            data, offsets = tx.text_bytes(piece.column(1))
            data = _UPPER[data]
            starts, ends, firsts = tx.words(data, offsets)
            size = np.diff(firsts)
            # one space between words: each shingle is a slice of the joined words
            joined = b" ".join(data.tobytes().split())
            lengths = ends - starts
            at = np.concatenate([[0], np.cumsum(lengths + 1)])
            if at[-1] != len(joined) + (len(starts) > 0):  # words of two texts that touch
                joined = b" ".join(data[s:e].tobytes() for s, e in zip(starts, ends, strict=True))
            count = np.where(size > 0, np.maximum(size - shingle + 1, 1), 0)
            first = tx.ranges(firsts[:-1], count)
            width = np.repeat(np.minimum(size, shingle), count)
            low, high = at[first].tolist(), (at[first + width] - 1).tolist()
            digest = xxhash.xxh64_intdigest
            hashes = np.fromiter(
                (digest(joined[a:b], SEED) for a, b in zip(low, high, strict=True)),
                np.uint64,
                len(low),
            )
            prints = _majority(hashes, count)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(prints.view(np.int64)), *piece.columns[2:]],
                names=["doc_id", "print", *piece.schema.names[2:]],
            )

    return fingerprints


def _majority(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each run of ``count`` hashes the bits that are set in over half of them."""
    out = np.zeros(len(count), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(count)])
    step = 1 << 15
    ones = np.zeros((len(count), 64), np.int64)
    owner = np.repeat(np.arange(len(count)), count)
    for low in range(0, len(hashes), step):
        part = hashes[low : low + step]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        texts = owner[low : low + step]
        new = np.flatnonzero(np.diff(texts, prepend=-1))
        ones[texts[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    set_bits = (2 * ones > np.diff(bounds)[:, None]).astype(np.uint8)
    out[:] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, keys: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``print`` (the 64 bits as a signed long) and long ``keys`` of every row.

    A-Z are lower-cased; words are separated by ASCII white space. A text with fewer words
    than ``shingle`` is one shingle; null and empty texts have fingerprint zero.
    """
    schema = ", ".join(f"{name} long" for name in ("doc_id", "print", *keys))
    return docs.select(F.col("doc_id").cast("long"), "text", *keys).mapInArrow(
        _fingerprints_of(shingle), schema
    )


def _bands(radius: int) -> list[tuple[int, int]]:
    """Shift and width of ``radius + 1`` bands that cover the 64 bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two tiles (or within one)."""
    counts = np.bitwise_count
    nodes = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    other = left if right is None else right
    base = 0 if right is None else len(left)
    rows = max(1, (1 << 20) // max(1, len(other)))
    for low in range(0, len(left), rows):
        apart = counts(left[low : low + rows, None] ^ other[None, :])
        i, j = np.nonzero(apart <= radius)
        i += low
        if right is None:
            i, j = i[j > i], j[j > i]
        for a, b in zip(i.tolist(), (j + base).tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[y] = x
                edges.append((int(nodes[a]), int(nodes[b])))
    return edges


def _compare(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def tile_edges(rows: dict[str, list[np.ndarray]]):
        """Own nodes among themselves, then own against visitors, tile by tile."""

        def tiles(values):
            if not values:
                return []
            values = np.unique(np.concatenate(values)).view(np.uint64)
            values = values[np.argsort(np.bitwise_count(values), kind="stable")]
            return [values[i : i + TILE] for i in range(0, len(values), TILE)]

        own, guests = tiles(rows["own"]), tiles(rows["guest"])
        for i, a in enumerate(own):
            yield from _forest(a, None, radius)
            for b in own[i + 1 :] + guests:
                (a0, a1), (b0, b1) = (np.bitwise_count(t[[0, -1]]).astype(int) for t in (a, b))
                if b0 - a1 <= radius and a0 - b1 <= radius:
                    yield from _forest(a, b, radius)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {"own": [], "guest": []}

        def edges():
            found = list(tile_edges(held))
            if found:
                u, v = np.array(found, np.uint64).T.copy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=schema
                )

        for batch in batches:
            cells = batch.column(0).to_numpy()
            guest = batch.column(1).to_numpy(zero_copy_only=False)
            prints = batch.column(2).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                if low == high:
                    continue
                if cells[low] != key and key is not None:
                    yield from edges()
                    held = {"own": [], "guest": []}
                key = cells[low]
                part, is_guest = prints[low:high], guest[low:high]
                held["own"].append(part[~is_guest])
                held["guest"].append(part[is_guest])
        if key is not None:
            yield from edges()

    return compare


def near_edges(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (u, v) whose connected components are those of all pairs within ``radius`` bits.

    ``prints`` has distinct longs ``print``.
    """
    n = tx.partitions(prints.sparkSession)
    bands = F.array(
        *[
            F.struct(
                F.lit(i).alias("band"),
                F.shiftrightunsigned("print", low)
                .bitwiseAND(F.lit((1 << width) - 1).cast("long"))
                .alias("value"),
            )
            for i, (low, width) in enumerate(_bands(radius))
        ]
    )
    dealt = prints.select("print", F.explode(bands).alias("b")).select(
        "print", F.xxhash64("b.band", "b.value").alias("group")
    )
    sizes = dealt.groupBy("group").count().where(F.col("count") > TILE)
    small = dealt.join(sizes, "group", "left_anti").select(
        F.col("group").alias("cell"), F.lit(False).alias("guest"), "print"
    )
    crowd = dealt.join(sizes.select("group"), "group", "left_semi").withColumn(
        "ones", F.bit_count("print")
    )
    tiles = (
        crowd.groupBy("group", "ones")
        .agg(F.ceil(F.count("*") / (TILE * TILES_PER_TASK)).alias("tiles"))
        .withColumnRenamed("ones", "host")
    )
    # A node is at home in one tile of its bit count, and a guest in the lower tiles of the
    # same count and in all tiles of the counts up to the radius below its own.
    large = (
        crowd.withColumn("host", F.explode(F.sequence(F.col("ones") - radius, F.col("ones"))))
        .join(tiles, ["group", "host"])
        .withColumn("home", F.pmod(F.xxhash64("print", F.lit(1)), "tiles"))
        .withColumn(
            "last", F.when(F.col("host") == F.col("ones"), F.col("home")).otherwise(F.col("tiles") - 1)
        )
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .select(
            F.xxhash64("group", "host", "tile").alias("cell"),
            ((F.col("host") != F.col("ones")) | (F.col("tile") != F.col("home"))).alias("guest"),
            "print",
        )
    )
    return (
        small.unionAll(large)
        .repartition(n, "cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_compare(radius), "u long, v long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that links of at most ``radius`` differing bits
    lead to. Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows share a component. A null ``doc_id`` has the component of its
    fingerprint, null where no row in it has a ``doc_id``. Other columns are ignored.
    """
    return _linked(docs, shingle, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def _row_hash(docs: DataFrame, seed: int) -> Column:
    """A hash of all columns, where NULLs are included; maps and variants by their JSON."""
    plain, others = [], []
    for f in docs.schema.fields:
        text = f.dataType.simpleString()
        (others if "map<" in text or "variant" in text else plain).append(F.col(f"`{f.name}`"))
    nulls = F.concat(*[c.isNull().cast("string") for c in plain + others])
    spelled = [F.to_json(F.struct(c.alias("c"))) for c in others]
    return F.xxhash64(F.lit(seed), nulls, *plain, *spelled)


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component: of the smallest ``doc_id``, rows with a null one last.

    Of rows with that ``doc_id`` the one with the smallest hash of all its columns stays, so
    it is the same one in every run; of equal rows one stays. All columns come back as they are,
    whatever their names. Two 64-bit hashes tell rows apart; decisions are taken on them, and
    texts are moved once.
    """
    keys = tx.free_names(docs.columns, "key_a", "key_b")
    keyed = docs.select("*", *[_row_hash(docs, i).alias(k) for i, k in enumerate(keys)])
    firsts = (
        _linked(keyed, shingle, radius, keys)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *keys)).alias("first"))
        .select(*[F.col("first").getField(k).alias(k) for k in keys])
    )
    return keyed.join(firsts, list(keys), "left_semi").dropDuplicates(list(keys)).select(
        *[f"`{c}`" for c in docs.columns]
    )


def _linked(
    docs: DataFrame, shingle: int, radius: int, keys: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``keys``, ``print``, ``component`` (a print) and ``component_id`` of every row."""
    spark = docs.sparkSession
    folder = workspace(spark, "simhash")
    prints = materialise(fingerprints(docs, shingle, keys), f"{folder}/prints")
    nodes = materialise(
        prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")), f"{folder}/nodes"
    )
    edges = near_edges(nodes.select("print"), radius)
    linked = components(edges, f"{folder}/components", ROWS_PER_TASK)  # node, component: a print each
    label = (
        nodes.join(linked, nodes["print"] == linked["node"], "left")
        .select("print", "doc_id", F.coalesce("component", "print").alias("component"))
    )
    least = label.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = label.join(least, "component").select("print", "component", "component_id")
    return salted_join(
        prints, named, ["print"], "inner", left_rows=prints.count(), rows_per_task=ROWS_PER_TASK
    )
