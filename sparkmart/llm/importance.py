"""Importance resampling: documents drawn in proportion to their likeness to target texts.

Words are runs of digits, letters and non-ASCII characters, A-Z in lower case; features are the
runs of up to ``max_n`` words, joined by one space; the CRC-32 of a feature's UTF-8 bytes modulo
``buckets`` is its bucket. A bucket's gain is the logarithm, in thousandths, of how much more
often the target's features fall into it than the documents' (each bucket starts with one). A
document's weight is the sum over its features. Gumbel noise by document and ranking draw without
replacement.

Method: a head of frequent words travels to the tasks by broadcast, each with the state of its
CRC, from which a longer feature goes on, and likewise the buckets of frequent pairs of head
words. Features outside the head take their CRC byte by byte. Both give exact buckets, so what is
in the head changes the time and not the result; the totals cover all features.

The head is bounded: a task hands on the words that make up at least one in ``4 * HEAD`` of a
stretch of a million and more, and of those that reach one in ``2 * HEAD`` of all words there are
``2 * HEAD`` at most. Words of over 16 bytes are never in it. Totals, and the gains, are one
number per bucket.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.session import materialise, workspace

from . import text as tx

HEAD = 16_384
BUCKETS = 10_000
STRETCH_WORDS = 1 << 20

_U = np.uint64
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_COUNT = "low long, high long, n long"
_TOTAL = "side int, bucket int, n long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_on(
    states: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """CRC-32 states after the bytes from ``starts`` to ``ends`` (a fresh state is 0).

    Byte by byte over all words at once, longest first, so that those still running are the
    first ones; what is left of words of over 64 bytes is done word by word.
    """
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    running = ~states[order]
    at, rest = starts[order], lengths[order]
    for i in range(min(64, int(rest[0]) if len(rest) else 0)):
        n = int(np.searchsorted(-rest, -i, "left"))
        part = running[:n]
        running[:n] = _CRC[(part ^ data[at[:n] + i]) & np.uint32(0xFF)] ^ part >> np.uint32(8)
    out = np.empty_like(running)
    out[order] = ~running
    for i in np.flatnonzero(lengths > 64):
        out[i] = zlib.crc32(data[starts[i] + 64 : ends[i]], int(out[i]))
    return out


def short_keys(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each word of up to 16 as two numbers; no word holds a zero byte.

    ``data`` must go on for 16 bytes after the last word. Longer words give 0, 0.
    """
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    lengths = ends - starts
    mask = np.append(~(~_U(0) << np.arange(0, 64, 8, dtype=np.uint64)), ~_U(0))
    fits = lengths <= 16
    low = eight[starts] & mask[np.where(fits, np.minimum(lengths, 8), 0)]
    high = eight[starts + 8] & mask[np.where(fits, np.clip(lengths - 8, 0, 8), 0)]
    return low, high


def _key_hash(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return tx.mix(low ^ tx.mix(high + _U(1)))


@dataclass(frozen=True)
class Head:
    """Frequent words, by the hash of their bytes, and the buckets of frequent pairs of them."""

    hashes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    states: np.ndarray
    pairs: np.ndarray
    pair_buckets: np.ndarray

    @staticmethod
    def of(low: np.ndarray, high: np.ndarray) -> Head:
        """A head of words without pairs; of equal hashes one word stays."""
        hashes = _key_hash(low, high)
        hashes, first = np.unique(hashes, return_index=True)
        low, high = low[first], high[first]
        spelled = np.stack([low, high], axis=1).astype("<u8").view(np.uint8).reshape(-1)
        starts = np.arange(len(low)) * 16
        sizes = (spelled.reshape(-1, 16) != 0).sum(axis=1) if len(low) else starts
        states = crc_on(np.zeros(len(low), np.uint32), spelled, starts, starts + sizes)
        none = np.zeros(0, np.int64)
        return Head(hashes, low, high, states, none, none)

    def spot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The index of each word in the head, -1 for words of the tail; bytes decide."""
        if not len(self.hashes):
            return np.full(len(low), -1, np.int64)
        at = np.searchsorted(self.hashes, _key_hash(low, high))
        at = np.minimum(at, len(self.hashes) - 1)
        same = (self.low[at] == low) & (self.high[at] == high) & (low != 0)
        return np.where(same, at, -1)

    def with_pairs(self, pairs: np.ndarray, buckets: int) -> Head:
        """The head with frequent pairs, each ``first * len(head) + second``."""
        pairs = np.sort(pairs)
        n = max(1, len(self.hashes))
        first, second = pairs // n, pairs % n
        spelled = np.stack([self.low[second], self.high[second]], axis=1).astype("<u8")
        spelled = np.concatenate(
            [np.full((len(pairs), 1), 0x20, np.uint8), spelled.view(np.uint8).reshape(-1, 16)],
            axis=1,
        )
        starts = np.arange(len(pairs)) * 17
        ends = starts + (spelled != 0).sum(axis=1)
        states = crc_on(self.states[first], spelled.reshape(-1), starts, ends)
        found = (states % buckets).astype(np.int64)
        return Head(self.hashes, self.low, self.high, self.states, pairs, found)


class Words:
    """The words of a piece of texts, in lower case."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = tx.text_bytes(column)
        self.starts, self.ends, self.firsts = tx.words(data, offsets, _BETWEEN)
        self.data = np.concatenate([_LOWER[data], np.zeros(16, np.uint8)])

    def stretches(self, size: int = STRETCH_WORDS) -> Iterator[tuple[int, int]]:
        """Parts of the words, for a very long text not to be taken at once."""
        for low in range(0, len(self.starts), size):
            yield low, min(low + size, len(self.starts))

    def keys(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        return short_keys(self.data, self.starts[low:high], self.ends[low:high])

    def room(self, low: int, high: int) -> np.ndarray:
        """How many words there are from each one on to the end of its text."""
        at = np.arange(low, high)
        return self.firsts[np.searchsorted(self.firsts, at, "right")] - at

    def states(self, head: Head, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """CRC states of the words and their places in the head."""
        spots = head.spot(*self.keys(low, high))
        states = np.zeros(high - low, np.uint32)
        known = spots >= 0
        states[known] = head.states[spots[known]]
        tail = np.flatnonzero(~known)
        fresh = np.zeros(len(tail), np.uint32)
        states[tail] = crc_on(fresh, self.data, self.starts[low + tail], self.ends[low + tail])
        return states, spots

    def buckets(
        self, head: Head, max_n: int, buckets: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of first words and buckets of the features, by stretch and length."""
        for low, high in self.stretches():
            room = self.room(low, high)
            states, spots = self.states(head, low, high)
            yield np.arange(low, high), (states % buckets).astype(np.int64)
            at = np.arange(high - low)
            for n in range(2, max_n + 1):
                at = at[room[at] >= n]
                last = low + at + n - 1
                found = np.full(len(at), -1, np.int64)
                if n == 2 and len(head.pairs):
                    second = head.spot(*short_keys(self.data, self.starts[last], self.ends[last]))
                    code = spots[at] * len(head.hashes) + second
                    place = np.minimum(np.searchsorted(head.pairs, code), len(head.pairs) - 1)
                    both = (spots[at] >= 0) & (second >= 0) & (head.pairs[place] == code)
                    found = np.where(both, head.pair_buckets[place], -1)
                # A longer feature goes on from the states of pairs, so all are needed for it.
                slow = np.flatnonzero(found < 0) if n == max_n else np.arange(len(at))
                state = states[at[slow]]
                spaced = np.full(len(slow), 0x20, np.uint8)
                state = crc_on(state, spaced, np.arange(len(slow)), np.arange(1, len(slow) + 1))
                state = crc_on(state, self.data, self.starts[last[slow]], self.ends[last[slow]])
                states[at[slow]] = state
                found[slow] = state % buckets
                yield low + at, found


class _Heavy:
    """Counts of keys by stretch; what is rarer than one in ``4 * HEAD`` of one is let go."""

    def __init__(self, bound: int) -> None:
        self.bound, self.kept, self.n = bound, [], 0

    def add(self, low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes, first, counts = np.unique(
            _key_hash(low, high), return_index=True, return_counts=True
        )
        self.kept.append((hashes, low[first], high[first], counts))
        self.n += len(low)
        if self.n >= STRETCH_WORDS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.kept, strict=True)] if self.kept else None
        low = high = np.zeros(0, np.uint64)
        counts = np.zeros(0, np.int64)
        if columns is not None:
            hashes, first, group = np.unique(columns[0], return_index=True, return_inverse=True)
            counts = np.zeros(len(hashes), np.int64)
            np.add.at(counts, group, columns[3])
            heavy = (counts * self.bound >= self.n) & (columns[1][first] != 0)
            first, counts = first[heavy], counts[heavy]
            low, high = columns[1][first], columns[2][first]
        # The words of the stretch themselves are counted under the key 0, 0 of no word.
        out = [np.append(low, _U(0)), np.append(high, _U(0)), np.append(counts, self.n)]
        self.kept, self.n = [], 0
        names = ["low", "high", "n"]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in out], names=names)


def _counting(head_size: int, head) -> Callable:
    """Counts of frequent words or, with a head, of frequent pairs of its words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = _Heavy(4 * head_size)
        for piece in tx.pieces(batches, 0):
            words = Words(piece.column(0))
            for low, high in words.stretches():
                if head is None:
                    yield from heavy.add(*words.keys(low, high))
                    continue
                known = head.value
                after = min(high + 1, len(words.starts))
                spots = known.spot(*words.keys(low, after))
                first, second = spots[: after - low - 1], spots[1:]
                inside = words.room(low, low + len(first)) >= 2
                both = inside & (first >= 0) & (second >= 0)
                code = first[both] * len(known.hashes) + second[both] + 1
                yield from heavy.add(code.astype(np.uint64), np.zeros(len(code), np.uint64))
        yield heavy.flush()

    return count


def _totals(head, max_n: int, buckets: int) -> Callable:
    """Features per side and bucket of one task."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), np.int64)
        for piece in tx.pieces(batches, 0):
            words = Words(piece.column(0))
            sides = np.asarray(piece.column(1))
            owners = np.repeat(sides, np.diff(words.firsts))
            for at, found in words.buckets(head.value, max_n, buckets):
                for side in (0, 1):
                    own = found[owners[at] == side]
                    sums[side] += np.bincount(own, minlength=buckets)
        side, bucket = np.nonzero(sums)
        columns = [
            pa.array(side.astype(np.int32)),
            pa.array(bucket.astype(np.int32)),
            pa.array(sums[side, bucket]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["side", "bucket", "n"])

    return count


def _weighing(model, at: int) -> Callable:
    """Column ``at`` holds the texts, the columns before it come back with the counts."""

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model.value
        for piece in tx.pieces(batches, at):
            words = Words(piece.column(at))
            counts = np.diff(words.firsts)
            owners = np.repeat(np.arange(len(counts)), counts)
            weights = np.zeros(len(counts), np.int64)
            for first, found in words.buckets(held.head, held.max_n, len(held.gains)):
                np.add.at(weights, owners[first], held.gains[found])
            features = sum(np.maximum(counts - n, 0) for n in range(held.max_n))
            added = [pa.array(c) for c in (counts, features, weights)]
            columns = [*(piece.column(i) for i in range(at)), *added]
            names = [f"c{i}" for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return weigh


@dataclass(frozen=True)
class Model:
    """The head and the gain of every bucket."""

    head: Head
    gains: np.ndarray
    max_n: int


def _frequent(
    texts: DataFrame, head_size: int, head, folder: str
) -> tuple[np.ndarray, np.ndarray]:
    """Keys that make up one in ``2 * head_size`` of all, so ``2 * head_size`` at most."""
    counts = texts.select("text").mapInArrow(_counting(head_size, head), _COUNT)
    counts = materialise(counts.groupBy("low", "high").agg(F.sum("n").alias("n")), folder)
    total = counts.where("low = 0 AND high = 0").agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.col("low") != 0) & (F.col("n") * 2 * head_size >= total))
    keys = np.array(found.select("low", "high").collect(), np.int64).reshape(-1, 2)
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))].astype(np.uint64)
    return keys[:, 0], keys[:, 1]


def fit(
    docs: DataFrame,
    target: DataFrame,
    *,
    max_n: int = 1,
    buckets: int = BUCKETS,
    head_size: int = HEAD,
) -> Model:
    """Learn the gains from all texts of ``docs`` and ``target`` (column text; null: none).

    Without any feature on either side every gain is 0.
    """
    if max_n < 1 or buckets < 1 or head_size < 1:
        raise ValueError("max_n, buckets and head_size must be positive")
    spark = docs.sparkSession
    texts = docs.select("text", F.lit(0).alias("side")).unionAll(
        target.select("text", F.lit(1).alias("side"))
    )
    folder = workspace(spark, "importance")
    head = Head.of(*_frequent(texts, head_size, None, f"{folder}/words"))
    if max_n > 1:
        sent = spark.sparkContext.broadcast(head)
        pairs = _frequent(texts, head_size, sent, f"{folder}/pairs")[0]
        head = head.with_pairs(pairs.astype(np.int64) - 1, buckets)
    sent = spark.sparkContext.broadcast(head)
    totals = texts.mapInArrow(_totals(sent, max_n, buckets), _TOTAL)
    sums = [[0] * buckets, [0] * buckets]
    for side, bucket, n in totals.groupBy("side", "bucket").agg(F.sum("n")).collect():
        sums[side][bucket] = n
    mine, theirs = sum(sums[0]) + buckets, sum(sums[1]) + buckets
    gains = [
        math.floor(1000 * math.log((t + 1.0) * mine / ((s + 1.0) * theirs)))
        for s, t in zip(*sums, strict=True)
    ]
    return Model(head, np.array(gains, np.int64), max_n)


def weigh(
    docs: DataFrame, model: Model, keep: Sequence[str] | None = None, into: str = "importance"
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_features and weight of every row's text.

    A null text has none of them. ``keep`` names the columns to return (all); a column that is
    already called ``into`` gives way.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != into]
    added = ("_n_words", "_n_features", "_weight")
    types = [docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in added]
    # By place and not by name, so that no column's name can clash.
    arranged = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text"))
    out = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(types)])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    done = arranged.mapInArrow(_weighing(sent, len(keep)), out)
    inner = [F.col(f"c{len(keep) + i}").alias(c[1:]) for i, c in enumerate(added)]
    return done.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.struct(*inner).alias(into)
    )


def noise(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise in thousandths, from the SHA-256 of seed and id (null: no digits)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(text.cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(
    weighed: DataFrame,
    *,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    importance: str = "importance",
) -> DataFrame:
    """``score`` and ``rank`` of every row; the best ``percent`` of those long enough have a rank.

    ``weighed`` has doc_id and the struct of ``weigh``. Equal scores go by doc_id, rows without
    one last, and then as they lie. Ranks come from a range partitioning, in which also equal
    rows part, and the rows before each range; no window holds them all.
    """
    spark = weighed.sparkSession
    folder = workspace(spark, "importance-draw")
    taken = [c for c in weighed.columns if c not in ("score", "rank")]
    scored = weighed.select(
        *taken,
        (F.col(f"{importance}.weight") + noise(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("_place"),
    )
    scored = materialise(scored, f"{folder}/scored")
    long_enough = F.col(f"{importance}.n_words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_place")]
    ranged = scored.where(long_enough).repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts the rows of each range, the range's number being above the low 33 bits.
    placed = ranged.withColumn("_place", F.monotonically_increasing_id())
    placed = materialise(placed, f"{folder}/placed")
    number = F.shiftright("_place", 33)
    sizes = placed.groupBy(number.alias("_range")).agg(F.count("*").alias("_n"))
    drawn = F.floor(F.sum("_n").over(Window.partitionBy()) * percent / 100)
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, as many as there are shuffle partitions.
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        drawn.alias("_drawn"),
    )
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    columns = [*taken, "score"]
    ranked = placed.withColumn("_range", number).join(F.broadcast(starts), "_range")
    ranked = ranked.select(*columns, F.when(rank <= F.col("_drawn"), rank).alias("rank"))
    others = scored.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionAll(others)
