"""Suffix-array dedup: byte strings of a fixed length that occur twice are removed.

Method: a distributed merge sort of suffixes that knows common prefixes. Tasks sort
suffixes into runs, exchange them front-coded, and shards merge them with loser trees that
never compare a known prefix again; the shared prefixes of neighbours then tell which
strings occur twice.

Sorting every suffix of the corpus to a depth of 400 bytes would exchange many times the input.
So the suffixes are sampled by content: every window of ``length`` bytes belongs to the
position of its smallest ``GRAM``-byte hash (its anchor), and equal windows have equal anchors
at equal offsets. Anchors whose gram is found once cannot be in a repeated window and are
left out. Of the others the suffix, and the reversed prefix, up to the ends of the anchor's
windows are sorted and merged: a window that starts ``o`` bytes before its anchor repeats if
another anchor shares ``length - o`` bytes to the right and ``o`` to the left. That is
exact for every window, while the hashes only choose what to compare.

Equal surroundings of anchors within a task collapse into one entry of a run. Anchors in
one passage that has other neighbours in each document meet in one shard, one entry each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import merge_runs, repeats
from . import text as tx

GRAM = 32
CHUNK_BYTES = 24 << 20
_LONG = 4 << 20  # longer texts are read in parts that overlap by a window
_POSITION = np.uint64((1 << 24) - 1)



def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` keys in a row."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _parts(texts: pa.Array, length: int):
    """Bytes, bounds, row and base of the texts that have a window, long ones in parts."""
    data, offsets = tx.text_bytes(texts)
    if len(texts) > 1 or len(data) <= _LONG:
        yield data, offsets, np.arange(len(texts)), 0
        return
    for low in range(0, len(data) - length + 1, _LONG):
        part = data[low : low + _LONG + length - 1]
        yield part, np.array([0, len(part)]), np.zeros(1, np.int64), low


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """Per anchor: its hash, place, text, and the first and last start of its windows."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none, none
    hashes = tx.rolling(data, GRAM)
    keys = hashes & ~_POSITION
    keys |= np.arange(len(keys), dtype=np.uint64)
    least = _smallest(keys, length - GRAM + 1)
    least &= _POSITION
    # starts of windows inside a text, and where the anchor changes from one to the next
    sizes = np.diff(offsets)
    texts = np.flatnonzero(sizes >= length)
    low, high = offsets[texts], offsets[texts] + sizes[texts] - length
    inside = np.zeros(len(least) + 1, np.int8)
    inside[low] += 1
    inside[high + 1] -= 1
    changes = np.empty(len(least), bool)
    changes[:1] = True
    np.not_equal(least[1:], least[:-1], out=changes[1:])
    changes[low] = True
    changes &= np.cumsum(inside[:-1], dtype=np.int8) > 0
    first = np.flatnonzero(changes)
    place = least[first].astype(np.int64)
    text = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(data)) - 1, offsets[text + 1] - length)
    return tx.mix(hashes[place]), place, text, first, last


def _anchor_hashes(length: int):
    def hashed(texts: pa.Array):
        out = []
        for data, offsets, rows, base in _parts(texts, length):
            hashes, place, text, _, _ = _anchors(data, offsets, length)
            out.append((hashes, rows[text], place - offsets[text] + base))
        if not out:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none
        hashes, rows, places = (np.concatenate(c) for c in zip(*out, strict=True))
        # an anchor where two parts of a long text meet is listed once
        once = np.unique(np.stack([rows, places]), axis=1, return_index=True)[1]
        return hashes[once], rows[once], places[once]

    return hashed


class _Entries:
    """Anchors with the strings to the left (reversed) and right of them."""

    def __init__(self) -> None:
        self.right: list[bytes] = []
        self.left: list[bytes] = []
        self.hashes: list[int] = []
        self.owners: list[tuple[int, int, int]] = []  # doc_id, crc, place

    def add(self, hash_, doc_id, crc, place, left, right) -> None:
        self.hashes.append(hash_)
        self.owners.append((doc_id, crc, place))
        self.left.append(left)
        self.right.append(right)


def _surround(length: int, shards: int, homes: int):
    """Runs of the surroundings of repeated anchors, per shard of their hash."""

    def runs(entries: _Entries):
        order = sorted(range(len(entries.right)), key=lambda i: (entries.right[i], entries.left[i]))
        keep, twice = [], []
        for i in order:
            if (
                keep
                and entries.right[i] == entries.right[keep[-1]]
                and entries.left[i] == entries.left[keep[-1]]
            ):
                twice += (i, keep[-1])  # all their windows repeat
            else:
                keep.append(i)
        if twice:
            twice = sorted(set(twice))
            doc_id, crc, place = (
                np.array(c) for c in zip(*(entries.owners[i] for i in twice), strict=True)
            )
            left = np.array([len(entries.left[i]) for i in twice])
            count = left + [len(entries.right[i]) - length + 1 for i in twice]
            yield from repeats.flag_batches(
                repeats.flag_runs(doc_id, crc, place - left, count, homes)
            )
        shard = repeats.shard_of(np.array(entries.hashes, np.uint64)[keep], shards)
        held: dict[int, list[int]] = {}
        for i, s in zip(keep, shard.tolist(), strict=True):
            held.setdefault(s, []).append(i)
        rows = ((s, None, _pack(entries, own)) for s, own in sorted(held.items()))
        yield from repeats.flag_batches(rows)

    def surround(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, size = _Entries(), 0
        for piece in tx.pieces(batches, 2, 2 << 20):
            ids, crcs = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            wanted = []
            for found in piece.column(3).to_pylist():
                runs_ = repeats.unpack_runs(found)
                wanted.append(np.unique(tx.ranges(runs_[:, 0], runs_[:, 1])))
            for data, offsets, rows, base in _parts(piece.column(2), length):
                raw = data.tobytes()
                hashes, place, text, first, last = _anchors(data, offsets, length)
                key = rows[text] << 40 | (place - offsets[text] + base)
                asked = np.concatenate([np.full(len(w), r) << 40 | w for r, w in enumerate(wanted)])
                for i in np.flatnonzero(np.isin(key, asked)).tolist():
                    row, p, a, b = rows[text[i]], int(place[i]), int(first[i]), int(last[i])
                    where = p - int(offsets[text[i]]) + base
                    left, right = raw[a:p][::-1], raw[p : b + length]
                    entries.add(int(hashes[i]), ids[row], crcs[row], where, left, right)
                    size += b - a + length
            if size >= CHUNK_BYTES:
                yield from runs(entries)
                entries, size = _Entries(), 0
        if entries.right:
            yield from runs(entries)

    return surround


def _pack(entries: _Entries, own: list[int]) -> bytes:
    """One run, sorted by the strings to the right; another one by those to the left."""
    by_left = sorted(range(len(own)), key=lambda k: entries.left[own[k]])
    right = merge_runs.front_code([entries.right[i] for i in own])
    left = merge_runs.front_code([entries.left[own[k]] for k in by_left])
    doc_id, crc, place = (np.array(c, np.int64) for c in zip(*(entries.owners[i] for i in own), strict=True))
    return tx.pack(
        doc_id,
        crc.astype(np.uint32),
        place,
        np.array(by_left, np.uint32),
        right[0],
        right[1],
        np.frombuffer(right[2], np.uint8),
        left[0],
        left[1],
        np.frombuffer(left[2], np.uint8),
    )


def _neighbours(run_lists, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each entry in merged order, and the prefix shared with the one before, by rank."""
    shared, names = [], []
    for common, _, name in merge_runs.merge(run_lists):
        shared.append(common)
        names.append(name)
    rank = np.empty(n, np.int64)
    rank[names] = np.arange(n)
    return rank, np.array([*shared, 0], np.int64), np.array(names, np.int64)


def _repeated_windows(blobs: list[bytes], length: int):
    """doc_id, crc and starts of windows that are in the runs twice."""
    runs = [tx.unpack(b) for b in blobs]
    sizes = [len(r[0]) for r in runs]
    bases = np.concatenate([[0], np.cumsum(sizes)])
    n = int(bases[-1])
    doc_id, crc, place = (np.concatenate([r[i] for r in runs]).astype(np.int64) for i in range(3))
    right_size = np.concatenate([r[5] for r in runs]).astype(np.int64)
    left_size = np.empty(n, np.int64)
    for r, b in zip(runs, bases, strict=False):
        left_size[b + r[3]] = r[8]
    right_rank, right_shared, _ = _neighbours(
        [
            merge_runs.front_coded(r[4], r[5], r[6].tobytes(), b + np.arange(len(r[0])))
            for r, b in zip(runs, bases, strict=False)
        ],
        n,
    )
    left_rank, left_shared, _ = _neighbours(
        [
            merge_runs.front_coded(r[7], r[8], r[9].tobytes(), b + r[3].astype(np.int64))
            for r, b in zip(runs, bases, strict=False)
        ],
        n,
    )

    def most(rank, shared):  # with either neighbour
        return np.maximum(shared[rank], shared[rank + 1])

    right_most, left_most = most(right_rank, right_shared), most(left_rank, left_shared)
    least = np.maximum(length - right_size, length - right_most)  # offsets o worth a look
    greatest = np.minimum(left_size, left_most)
    right_shared, left_shared = right_shared[:-1], left_shared[:-1]
    entry, start = [], []
    open_ = np.flatnonzero(least <= greatest)
    if len(open_):
        for o in range(int(least[open_].min()), int(greatest[open_].max()) + 1):
            own = open_[(least[open_] <= o) & (greatest[open_] >= o)]
            if len(own) < 2:
                continue
            right_class = np.cumsum(right_shared < length - o)[right_rank[own]]
            left_class = np.cumsum(left_shared < o)[left_rank[own]] if o else 0
            code = right_class * (n + 1) + left_class
            order = np.argsort(code, kind="stable")
            same = np.diff(code[order]) == 0
            twice = np.zeros(len(own) + 1, bool)
            twice[1:-1] = same
            hit = own[order[twice[1:] | twice[:-1]]]
            entry.append(hit)
            start.append(place[hit] - o)
    if not entry:
        none = np.zeros(0, np.int64)
        return none, none, none
    entry = np.concatenate(entry)
    return doc_id[entry], crc[entry], np.concatenate(start)


def _merge(length: int, homes: int):
    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, flagged = None, [], []

        def settle():
            flagged.append(_repeated_windows(held, length))
            if sum(len(f[0]) for f in flagged) >= repeats.CHUNK:
                yield from flush()

        def flush():
            columns = [np.concatenate(c) for c in zip(*flagged, strict=True)]
            yield from repeats.flag_batches(repeats.flag_rows(*columns, homes))
            flagged.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                shard, found, entries = (batch.column(c)[i].as_py() for c in range(3))
                if entries is None:
                    yield repeats.flag_table([(shard, found, None)])
                    continue
                if shard != current and held:
                    yield from settle()
                    held.clear()
                current = shard
                held.append(entries)
        if held:
            yield from settle()
        if flagged:
            yield from flush()

    return merge


def _removal(length: int):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, 2):
            data, offsets = tx.text_bytes(piece.column(2))
            bounds = offsets.tolist()
            sizes, gone_sizes, spans, digests, kepts = [], [], [], [], []
            for i, found in enumerate(piece.column(3).to_pylist()):
                own = data[bounds[i] : bounds[i + 1]]
                sizes.append(len(own))
                removed = n_spans = 0
                if found:
                    gone = tx.covered(len(own), repeats.unpack_runs(found), length)
                    removed = int(gone.sum())
                    n_spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    own = own[~gone]
                kept = own.tobytes()
                gone_sizes.append(removed)
                spans.append(n_spans)
                digests.append(hashlib.sha256(kept).hexdigest())
                kepts.append(kept)
            columns = (
                piece.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(gone_sizes, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kepts, pa.binary()),
            )
            yield pa.RecordBatch.from_arrays(list(columns), names=list(names))

    return remove


def remove_repeats(docs: DataFrame, length: int = 400, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept bytes.

    A byte goes if a string of ``length`` bytes around it also starts anywhere else, in the
    same text too; texts are UTF-8, null is empty. Texts shorter than ``length`` are kept
    whole. Repeated rows repeat each other. Rows with a null ``doc_id`` are kept whole and
    take no part. Other columns are ignored; an empty table gives an empty result.
    """
    n = tx.partitions(docs.sparkSession)
    shards = n * repeats.SHARDS_PER_PARTITION
    anchors = repeats.repeated_positions(docs, _anchor_hashes(length), earlier=False)
    merged = (
        repeats.with_found(docs, anchors, "inner")
        .mapInArrow(_surround(length, shards, n), repeats.FLAGS)
        # Shard numbers are even hashes already: hashed again, some tasks would get many of them.
        .repartitionById(n, F.pmod("shard", F.lit(n)).cast("int"))
        .sortWithinPartitions("shard")
        .mapInArrow(_merge(length, n), repeats.FLAGS)
    )
    out = repeats.with_found(docs, repeats.gathered(merged, n)).mapInArrow(
        _removal(length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return out if with_text else out.drop("kept")
