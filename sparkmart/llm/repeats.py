"""Which hashed positions of documents repeat, over all documents.

A task hashes positions of its documents in bounded chunks and deals them to shards by hash,
one packed row per chunk and shard. What repeats within a chunk is settled there, and one
document (or one entry) stands for the hash from then on, so a passage in a third of all
documents costs a shard one entry per chunk. A shard is read one at a time.

Hashes are told apart by 56 bits and their shard: two different strings among n collide with a
probability of about n * n / (2**57 * shards).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

CHUNK = 3_000_000
SHARDS_PER_PARTITION = 4

FLAGS = "shard int, found binary, entries binary"
_SCHEMA = pa.schema([("shard", pa.int32()), ("found", pa.binary()), ("entries", pa.binary())])


def flag_rows(doc_id, crc, position, shards: int) -> Iterator[tuple]:
    """Repeated positions as runs, one packed row per shard of documents."""
    order = np.lexsort((position, crc, doc_id))
    doc_id, crc = doc_id[order], crc[order]
    position = position[order].astype(np.int64)
    if not len(position):
        return
    step = np.diff(position, prepend=position[0] - 2)
    new = (step != 1) & (step != 0)
    new[1:] |= (np.diff(doc_id) != 0) | (np.diff(crc) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(position)) - 1
    count = position[last] - position[first] + 1
    yield from flag_runs(doc_id[first], crc[first], position[first], count, shards)


def flag_runs(doc_id, crc, start, count, shards: int) -> Iterator[tuple]:
    """Runs (start, count), one packed row per shard of documents.

    Rows are as many as tasks times shards, however many documents have a run in each task.
    """
    if not len(doc_id):
        return
    mixed = tx.mix(doc_id.astype(np.uint64) ^ (crc.astype(np.uint64) << np.uint64(32)))
    shard = shard_of(mixed, shards)
    order = np.argsort(shard, kind="stable")
    columns = [np.asarray(c, np.int64)[order] for c in (doc_id, crc, start, count)]
    shard = shard[order]
    new = np.flatnonzero(np.diff(shard)) + 1
    bounds = [0, *new.tolist(), len(shard)]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(shard[low]), tx.pack(*(c[low:high] for c in columns)), None


def flag_table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_SCHEMA)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def flag_batches(rows: Iterable[tuple], size: int = 64) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield flag_table(held)
            held = []
    if held:
        yield flag_table(held)


def _settle(hashes: np.ndarray, owner: np.ndarray, earlier: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which entries repeat, and which need not travel on.

    ``earlier``: an entry repeats if a smaller owner has its hash; else if any other entry
    has it, and then the first one stands for all.
    """
    order = np.argsort(hashes, kind="stable")
    new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
    size = np.diff(new, append=len(order))
    repeat, settled = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    if earlier:
        least = np.repeat(np.minimum.reduceat(owner[order], new), size)
        repeat[order] = settled[order] = owner[order] > least
    else:
        repeat[order] = np.repeat(size > 1, size)
        settled[order] = True
        settled[order[new]] = False
    return repeat, settled


def _chunks(batches, hashed: Callable):
    """Entries of bounded chunks of documents: hash, document, crc and position."""
    held, count = [], 0
    for piece in tx.pieces(batches, 2, 2 << 20):
        hashes, row, position = hashed(piece.column(2))
        ids, crcs = piece.column(0).to_numpy(), piece.column(1).to_numpy()
        held.append((hashes, ids[row], crcs[row], position.astype(np.uint32)))
        count += len(hashes)
        if count >= CHUNK:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, count = [], 0
    if count:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _deal(shards: int, homes: int, hashed: Callable, earlier: bool):
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, doc_id, crc, position in _chunks(batches, hashed):
            repeat, settled = _settle(hashes, doc_id, earlier)
            yield from flag_batches(flag_rows(doc_id[repeat], crc[repeat], position[repeat], homes))
            keep = np.flatnonzero(~settled)
            shard = shard_of(hashes[keep], shards)
            by = np.argsort(shard, kind="stable")  # within a shard in document order
            keep, shard = keep[by], shard[by]
            bounds = np.searchsorted(shard, np.arange(shards + 1))
            rows = (
                (s, None, _pack_entries(hashes[k], doc_id[k], crc[k], position[k]))
                for s in range(shards)
                if len(k := keep[bounds[s] : bounds[s + 1]])
            )
            yield from flag_batches(rows)

    return deal


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash, by its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _pack_entries(hashes, doc_id, crc, position) -> bytes:
    new = np.flatnonzero((np.diff(doc_id) != 0) | (np.diff(crc) != 0)) + 1
    first = np.concatenate([[0], new])
    step = np.diff(position.astype(np.int32), prepend=np.int32(0))
    step[first] = position[first]
    low = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
    return tx.pack(
        np.frombuffer(low, np.uint8),
        np.diff(doc_id[first], prepend=0),
        crc[first].astype(np.uint32),
        np.diff(first, append=len(doc_id)).astype(np.uint32),
        step,
    )


def _unpack_entries(blob: bytes):
    low, ids, crcs, counts, step = tx.unpack(blob)
    hashes = np.zeros((len(step), 8), np.uint8)
    hashes[:, :7] = low.reshape(-1, 7)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    total = np.cumsum(step.astype(np.int64))
    position = total - np.repeat(total[first] - step[first], counts)
    return (
        hashes.view(np.uint64).ravel(),
        np.repeat(np.cumsum(ids), counts),
        np.repeat(crcs.astype(np.int64), counts),
        position.astype(np.uint32),
    )


def _judge(homes: int, earlier: bool):
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        flagged, count = [], 0

        def settle():
            hashes, doc_id, crc, position = (np.concatenate(c) for c in zip(*held, strict=True))
            at, _ = _settle(hashes, doc_id, earlier)
            return doc_id[at], crc[at], position[at]

        def flush():
            columns = [np.concatenate(c) for c in zip(*flagged, strict=True)]
            yield from flag_batches(flag_rows(*columns, homes))

        for batch in batches:
            for shard, found, entries in zip(
                *(batch.column(i).to_pylist() for i in range(3)), strict=True
            ):
                if entries is None:
                    yield flag_table([(shard, found, None)])
                    continue
                if shard != current and held:
                    flagged.append(settle())
                    count += len(flagged[-1][0])
                    held = []
                    if count >= CHUNK:
                        yield from flush()
                        flagged, count = [], 0
                current = shard
                held.append(_unpack_entries(entries))
        if held:
            flagged.append(settle())
        if flagged:
            yield from flush()

    return judge


def repeated_positions(docs: DataFrame, hashed: Callable, earlier: bool) -> DataFrame:
    """``doc_id``, ``crc`` (of the text) and packed runs ``found`` of repeated positions.

    ``hashed`` maps a column of texts to hash, row and position arrays. ``earlier``: only
    what also is in a document of smaller ``doc_id`` repeats; else whatever is found twice.
    Rows of ``docs`` with a null id or text take no part.
    """
    n = tx.partitions(docs.sparkSession)
    shards = n * SHARDS_PER_PARTITION
    dealt = keyed(docs).where("doc_id is not null and text is not null")
    judged = (
        dealt.mapInArrow(_deal(shards, n, hashed, earlier), FLAGS)
        .repartition(n, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_judge(n, earlier), FLAGS)
    )
    return gathered(judged, n)


def gathered(flags: DataFrame, n: int) -> DataFrame:
    """``doc_id``, ``crc`` and packed runs ``found``: one row per document that has any."""
    return (
        flags.select("shard", "found")
        .repartition(n, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_gather, "doc_id long, crc long, found binary")
    )


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, held = None, []

    def settle():
        doc_id, crc, start, count = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((crc, doc_id))
        doc_id, crc = doc_id[order], crc[order]
        found = np.stack([start[order], count[order]], axis=1).astype(np.int32)
        new = np.flatnonzero((np.diff(doc_id) != 0) | (np.diff(crc) != 0)) + 1
        first = np.concatenate([[0], new])
        bounds = [*first.tolist(), len(doc_id)]
        packed = [found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_id[first]), pa.array(crc[first]), pa.array(packed, pa.binary())],
            names=["doc_id", "crc", "found"],
        )

    for batch in batches:
        for shard, found in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            if shard != current and held:
                yield from settle()
                held.clear()
            current = shard
            held.append(tx.unpack(found))
    if held:
        yield from settle()


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``crc`` and ``text``: the crc keeps rows of one id with two texts apart."""
    return docs.select(F.col("doc_id").cast("long"), F.crc32("text").alias("crc"), "text")


def with_found(docs: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """Rows of ``docs`` as (doc_id, crc, text, found): the packed runs of each text."""
    return keyed(docs).join(found, ["doc_id", "crc"], how).select("doc_id", "crc", "text", "found")


def unpack_runs(found: bytes) -> np.ndarray:
    """Rows (start, length) of the packed runs."""
    return np.frombuffer(found, np.int32).reshape(-1, 2)
