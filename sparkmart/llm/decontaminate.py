"""Benchmark decontamination: test items found in documents within an edit budget.

Method: pigeonhole edit matching. An item of m characters may be found with up to
``m // chars_per_error`` edits; cut into one piece more than that, at least one piece is in
the document unchanged. An Aho-Corasick automaton finds the pieces. Around each hit Myers'
bit-parallel algorithm computes the smallest edit distance to a part of the text, of the
piece with its neighbour first (by the same principle one such pair has one edit at most),
and then of the whole item.

Texts and items are compared in lower case with white-space runs as one space. The items go to
the tasks in blocks of bounded size; each block is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.joins import lookup_join
from sparkmart.session import workspace

from . import text as tx

CHARS_PER_ERROR = 12
BLOCK_BYTES = 8 << 20

_MATCH = "doc_id long, item_id long, n_edits int"


def normal(text: str | None) -> str:
    """Lower case, white-space runs as one space."""
    return " ".join((text or "").lower().split())


def cut(item: str, chars_per_error: int) -> list[tuple[int, str]]:
    """Offset and text of each piece: one more than the edit budget, of about equal length."""
    n = len(item) // chars_per_error + 1
    bounds = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def block(pieces: list[tuple[int, str]], i: int) -> tuple[int, str, int]:
    """Offset, text and edit budget of the pair (or the last three pieces) that holds piece i.

    The budget is one less than its pieces: if every block had more edits than that, the item
    would have more than its own budget. So one block is within, and has a piece unchanged.
    """
    first = i - i % 2
    if first >= len(pieces) - 1 and first >= 2:
        first -= 2
    last = len(pieces) if first + 3 >= len(pieces) else first + 2
    part = pieces[first:last]
    return part[0][0], "".join(text for _, text in part), len(part) - 1


class Pattern:
    """Myers' bit-parallel matching of one item anywhere in a text."""

    def __init__(self, item: str) -> None:
        self.size = len(item)
        self.masks: dict[str, int] = {}
        for i, letter in enumerate(item):
            self.masks[letter] = self.masks.get(letter, 0) | 1 << i

    def distance(self, text: str, most: int) -> int:
        """The smallest number of edits that turn the item into a part of the text."""
        full, top = (1 << self.size) - 1, 1 << self.size - 1
        plus, minus, score, least = full, 0, self.size, self.size
        masks = self.masks
        for letter in text:
            equal = masks.get(letter, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(horizontal | plus) & full
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < least:
                    least = score
                    if not least:
                        return 0
            up = up << 1 & full
            down = down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
        return least


class Finder:
    """The items of one block in an automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int) -> None:
        self.items, self.chars_per_error = items, chars_per_error
        self.automaton, self.patterns = ahocorasick.Automaton(), {}
        places: dict[str, list] = {}
        for i, (_, item) in enumerate(items):
            own = cut(item, chars_per_error)
            for p, (offset, piece) in enumerate(own):
                places.setdefault(piece, []).append((i, offset, block(own, p)))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def _distance(self, item: str, window: str, most: int) -> int:
        if item in window:
            return 0
        if item not in self.patterns:
            self.patterns[item] = Pattern(item)
        return self.patterns[item].distance(window, most)

    def find(self, text: str | None) -> Iterator[tuple[int, int]]:
        """``item_id`` and fewest edits of each item found."""
        text = normal(text)
        spots: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, offset, (at, part, most) in where:
                start = end + 1 - length - offset
                if start not in spots.get(i, ()):
                    window = text[max(0, start + at - most) : start + at + len(part) + most]
                    if self._distance(part, window, most) <= most:
                        spots.setdefault(i, set()).add(start)
        for i, starts in sorted(spots.items()):
            item_id, item = self.items[i]
            most = len(item) // self.chars_per_error
            best = most + 1
            for low, high in _spans(sorted(starts), len(item), most):
                best = min(best, self._distance(item, text[max(0, low) : high], most))
            if best <= most:
                yield item_id, best


def _finding(items: list[tuple[int, str]], chars_per_error: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, chars_per_error)
        for piece in tx.pieces(batches, 1):
            found = [
                (doc_id, item_id, edits)
                for doc_id, text in zip(*(piece.column(i).to_pylist() for i in (0, 1)), strict=True)
                for item_id, edits in finder.find(text)
            ]
            columns = zip(*found, strict=True) if found else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "item_id", "n_edits"],
            )

    return find


def _cleaning(items: list[tuple[int, str]], chars_per_error: int, at: int):
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, chars_per_error)
        for piece in tx.pieces(batches, at):
            texts = piece.column(at).to_pylist()
            yield piece.filter(pa.array([next(finder.find(t), None) is None for t in texts]))

    return keep


def _hitting(items: list[tuple[int, str]], chars_per_error: int):
    def hit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, chars_per_error)
        for piece in tx.pieces(batches, 2):
            found = [next(finder.find(t), None) is not None for t in piece.column(2).to_pylist()]
            yield piece.select([0, 1]).filter(pa.array(found, pa.bool_()))

    return hit


def _spans(starts: list[int], size: int, most: int) -> Iterator[tuple[int, int]]:
    """Parts of the text that hold every match whose piece was hit, overlaps united."""
    low = high = None
    for start in starts:
        a, b = start - most, start + size + most
        if high is not None and a <= high - size:
            high = b
            continue
        if high is not None:
            yield low, high
        low, high = a, b
    if high is not None:
        yield low, high


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        held = ((r.item_id, normal(r.text)) for r in part.collect())
        held = sorted((x for x in held if x[1]), key=lambda x: (x[0] is None, x))
        if held:
            yield held


def matches(
    docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR
) -> DataFrame:
    """``doc_id``, ``item_id`` and ``n_edits`` of every row of ``docs`` and item found in it.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Null or blank items are not
    looked for, null or empty texts have no match. ``n_edits`` is the smallest number over all
    places. Repeated rows on either side give repeated matches; other columns are ignored.
    Where the benchmark has more than one block, the matches of each are written before the next
    but one is read, so the driver and the plan hold two blocks, however many there are.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    blocks, path, written = _blocks(benchmark), None, 0
    items = next(blocks, None)
    while items:
        found = texts.mapInArrow(_finding(items, chars_per_error), _MATCH)
        items = next(blocks, None)
        if not written and not items:
            return found
        path = path or workspace(spark, "matches")
        found.write.mode("overwrite").parquet(f"{path}/block={written}")
        written += 1
    if not written:
        return spark.createDataFrame([], _MATCH)
    return spark.read.schema(_MATCH).parquet(*[f"{path}/block={i}" for i in range(written)])


def clean(
    docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR
) -> DataFrame:
    """The rows of ``docs``, with all columns, in whose ``text`` no item is found.

    Null and empty texts stay, repeated rows stay or go together, and an empty benchmark keeps
    all. Where the benchmark has more than one block, two 64-bit hashes of the texts with an item
    are written block by block (the driver and the plan hold two blocks, however many there are),
    and the rows with these hashes go.
    """
    blocks = _blocks(benchmark)
    items, following = next(blocks, None), next(blocks, None)
    if not items:
        return docs
    if not following:
        keep = _cleaning(items, chars_per_error, docs.columns.index("text"))
        return docs.mapInArrow(keep, docs.schema)
    spark = docs.sparkSession
    keys = tx.free_names(docs.columns, "key_a", "key_b")
    has_text = F.col("text").isNotNull()
    hashes = [F.when(has_text, F.xxhash64(F.lit(i), "text")).alias(k) for i, k in enumerate(keys)]
    texts = docs.where(has_text).select(*hashes, "text")
    schema = ", ".join(f"{k} long" for k in keys)
    path, written = workspace(spark, "contaminated"), []
    while items:
        found = texts.mapInArrow(_hitting(items, chars_per_error), schema).distinct()
        written.append(f"{path}/block={len(written)}")
        found.write.mode("overwrite").parquet(written[-1])
        items, following = following, next(blocks, None)
    gone = spark.read.schema(schema).parquet(*written).distinct()
    kept = lookup_join(docs.select("*", *hashes), gone, list(keys), "left_anti")
    return kept.select(*[f"`{c}`" for c in docs.columns])
