"""Numpy helpers over the text bytes of Arrow batches: words, rolling hashes, runs, packing.

The functions work on one bounded piece of a batch at a time, so a task never holds more
than one piece of texts (or one text, where a single one is longer than a piece).
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import SparkSession

PIECE_BYTES = 4 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def free_names(taken: Iterable[str], *wanted: str) -> tuple[str, ...]:
    """Column names like the wanted ones that are not taken, in any case of letters."""
    held = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return tuple(out)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each (null: empty)."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(
    batches: Iterable[pa.RecordBatch], column: int, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` bytes of one column (or of one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i] .. starts[i] + counts[i] - 1`` of all i, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def words(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first word (and the end).

    ``between`` tells of each byte value whether it stands between words.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~between[data]
    joins = np.empty(len(data) + 1, bool)  # the byte before and the byte at i are one word
    joins[0] = joins[-1] = False
    np.logical_and(solid[1:], solid[:-1], out=joins[1:-1])
    joins[offsets] = False
    starts = np.flatnonzero(solid & ~joins[:-1])
    ends = np.flatnonzero(solid & ~joins[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if n <= PIECE_BYTES * 2:
            _powers[base] = known
    return known[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of value times power: the difference of two is a Rabin-Karp hash."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes (modulo 2**64, then mixed) of value ranges of equal or free length."""
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def byte_sums(data: np.ndarray) -> np.ndarray:
    """``prefix_sums`` over bytes, each replaced by a fixed 64-bit value."""
    return prefix_sums(_BYTES[data])


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A Rabin-Karp hash of the ``width`` bytes from each place on (not mixed)."""
    sums = byte_sums(data)
    hashes = sums[width:] - sums[:-width]
    hashes *= powers(_INVERSE, len(hashes))
    return hashes


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit Rabin-Karp hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + (1 << 20), "right"))
        last = max(last, first + 1)
        low = starts[first]
        sums = byte_sums(data[low : ends[last - 1]])
        out[first:last] = range_hashes(sums, starts[first:last] - low, ends[first:last] - low)
        first = last
    return out


def window_starts(firsts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start indices of all windows of ``length`` items within texts, and each one's text."""
    counts = np.maximum(np.diff(firsts) - length + 1, 0)
    return ranges(firsts[:-1], counts), np.repeat(np.arange(len(counts)), counts)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A rolling hash of the ``length`` word hashes from each start on."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return range_hashes(prefix_sums(hashes), starts, starts + length)


def runs(positions: np.ndarray) -> np.ndarray:
    """Sorted distinct positions as rows (start, length) of maximal runs."""
    if not len(positions):
        return np.zeros((0, 2), np.int64)
    positions = positions.astype(np.int64)
    first = np.flatnonzero(np.diff(positions, prepend=positions[0] - 2) != 1)
    return np.stack([positions[first], np.diff(first, append=len(positions))], axis=1)


def covered(n: int, found: np.ndarray, length: int) -> np.ndarray:
    """Which of n items are in a window of ``length`` whose start is in one of the runs."""
    change = np.zeros(n + 1, np.int64)
    if len(found):
        np.add.at(change, found[:, 0], 1)
        np.add.at(change, np.minimum(found[:, 0] + found[:, 1] - 1 + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string."""
    parts = []
    for a in arrays:
        parts += [struct.pack("<cq", a.dtype.char.encode(), len(a)), a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    """What ``pack`` was given."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<cq", raw, at)
        dtype = np.dtype(kind.decode())
        out.append(np.frombuffer(raw, dtype, n, at + 9))
        at += 9 + n * dtype.itemsize
    return out
