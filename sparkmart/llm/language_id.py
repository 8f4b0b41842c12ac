"""Language ID with hyperdimensional profiles.

Method: every letter has a random bipolar vector; a trigram is the product (binding) of its
letters' vectors, each permuted by its place; a text is the sum (bundle) of its trigrams, a
language the sum of its texts. A text gets the language whose prototype has the largest
cosine with it.

Training is one pass: each task adds up its texts' vectors per language, and Spark adds up
the tasks' sums. The model is one vector per learned language and the only thing collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from . import text as tx

DIMENSIONS = 1024
SEED = 7
_SLOTS = 1024  # letters have a slot by code point; those beyond share slots
_LABELS = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
_GAP = 0  # whatever is no letter
#: Texts with fewer letters are too short to be told from a language that was not learned.
LEAST_LETTERS = 20


@lru_cache(maxsize=1)
def _slots() -> np.ndarray:
    """The slot of each code point of the basic plane, lower-cased; 0 for what is no letter."""
    table = np.zeros(1 << 16, np.int64)
    for point in range(1 << 16):
        letter = chr(point)
        if letter.isalpha():
            table[point] = ord(letter.lower()[0]) % (_SLOTS - 1) + 1
    return table


@lru_cache(maxsize=2)
def _letters(dimensions: int) -> np.ndarray:
    vectors = np.random.default_rng(SEED).integers(0, 2, (_SLOTS, dimensions), dtype=np.int8)
    return (2 * vectors - 1).astype(np.int8)


def _trigram_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    letters = _letters(dimensions)
    first, second, third = codes // _SLOTS**2, codes // _SLOTS % _SLOTS, codes % _SLOTS
    bound = np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second]
    return (bound * letters[third]).astype(np.float32)


def _counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, trigram) with counts, and which texts have a letter."""
    joined = "".join("\n" + (t or "") + "\n" for t in texts)  # both gaps are the text's own
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    slots = _slots()
    wide = points >= 1 << 16
    slot = slots[np.where(wide, 0, points)]
    if wide.any():
        alpha = np.array([chr(p).isalpha() for p in points[wide].tolist()])
        slot[wide] = np.where(alpha, points[wide] % (_SLOTS - 1) + 1, _GAP)
    owner = np.repeat(np.arange(len(texts)), [len(t or "") + 2 for t in texts])
    # runs of gaps count as one gap
    keep = np.ones(len(slot), bool)
    keep[1:] = (slot[1:] != _GAP) | (slot[:-1] != _GAP) | (owner[1:] != owner[:-1])
    slot, owner = slot[keep], owner[keep]
    lettered = np.bincount(owner[slot != _GAP], minlength=len(texts)) > 0
    if len(slot) < 3:
        none = np.zeros(0, np.int64)
        return none, none, none, lettered
    code = (slot[:-2] * _SLOTS + slot[1:-1]) * _SLOTS + slot[2:]
    inside = (owner[:-2] == owner[2:]) & (slot[1:-1] != _GAP)
    keys, counts = np.unique(owner[:-2][inside] << 30 | code[inside], return_counts=True)
    return keys >> 30, keys & ((1 << 30) - 1), counts, lettered


def _bundles(texts: list[str | None], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The vector of each text and whether it has a letter."""
    owner, code, count, lettered = _counts(texts)
    columns, at = np.unique(code, return_inverse=True)
    out = np.zeros((len(texts), dimensions), np.float32)
    step = 4096  # of distinct trigrams, which bounds both matrices
    for low in range(0, len(columns), step):
        mine = (at >= low) & (at < low + step)
        table = np.zeros((len(texts), len(columns[low : low + step])), np.float32)
        table[owner[mine], at[mine] - low] = count[mine]
        out += table @ _trigram_vectors(columns[low : low + step], dimensions)
    return out, lettered


def _pieces(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for piece in tx.pieces(batches, column, 1 << 20):
        for low in range(0, piece.num_rows, 1000):
            yield piece.slice(low, 1000)


def _summer(dimensions: int):
    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for piece in _pieces(batches, 1):
            vectors, _ = _bundles(piece.column(1).to_pylist(), dimensions)
            languages = np.array(piece.column(0).to_pylist(), object)
            for language in dict.fromkeys(languages.tolist()):
                total = vectors[languages == language].sum(axis=0, dtype=np.float64)
                sums[language] = sums.get(language, 0) + total
        for language, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language] * dimensions),
                    pa.array(np.arange(dimensions, dtype=np.int32)),
                    pa.array(total.round().astype(np.int64)),
                ],
                names=["lang", "dimension", "total"],
            )

    return add_up


def train(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A unit prototype per language from rows (text, lang) with both not null."""
    sums = (
        labelled.where("text is not null and lang is not null")
        .select("lang", "text")
        .mapInArrow(_summer(dimensions), "lang string, dimension int, total long")
        .groupBy("lang", "dimension")
        .agg(F.sum("total").alias("total"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("dimension", "total"))).alias("totals"))
    )
    model = {}
    for language, totals in sorted(map(tuple, sums.collect())):
        vector = np.array([t["total"] for t in totals], np.float64)
        if vector.any():
            model[language] = (vector / np.linalg.norm(vector)).astype(np.float32)
    return model


def label(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    ``score`` is the cosine with the best prototype, 0 at least. Null texts, texts without a
    letter and an empty model give ``und`` and 0; of equal cosines the first language in
    alphabetical order counts. Repeated rows, null ids and other columns do no harm.
    """
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")
    names = [*docs.columns, "lang_pred", "score"]
    languages = sorted(model)
    matrix = np.stack([model[x] for x in languages]) if languages else np.zeros((0, 1), np.float32)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, at):
            found, scores = ["und"] * piece.num_rows, np.zeros(piece.num_rows)
            if languages:
                vectors, lettered = _bundles(piece.column(at).to_pylist(), matrix.shape[1])
                norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)
                cosines = (vectors @ matrix.T) / norms[:, None]
                best = cosines.argmax(axis=1)
                found = [languages[b] if y else "und" for b, y in zip(best, lettered, strict=True)]
                scores = np.where(lettered, cosines.max(axis=1).clip(0, 1), 0).astype(np.float64)
            columns = [*piece.columns, pa.array(found, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([*docs.schema, *_LABELS])
    return docs.mapInArrow(judge, schema)


def predict(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs``; see ``label``."""
    return label(docs.select(F.col("doc_id").cast("long"), "text"), model)


def long_enough() -> F.Column:
    """Which texts have the letters that a rejection needs."""
    return F.coalesce(F.col("text").rlike(rf"(?:\P{{L}}*+\p{{L}}){{{LEAST_LETTERS}}}"), F.lit(False))


def least_score(labelled: DataFrame, model: dict[str, np.ndarray]) -> float:
    """The cosine below which a text of ``LEAST_LETTERS`` or more is in no learned language.

    Half of what all but a thousandth of the held-out rows (doc_id, text, lang) reach that are
    labelled rightly, so that texts like them stay. Without such rows 0, which rejects nothing.
    """
    held = labelled.where(held_out() & long_enough() & F.col("lang").isin(sorted(model)))
    least = (
        label(held.select("text", "lang"), model)
        .where("lang_pred = lang")
        .agg(F.percentile_approx("score", 0.001, 10_000))
        .first()[0]
    )
    return (least or 0.0) / 2


def held_out() -> F.Column:
    """Which documents no model may learn from: a quarter, by a hash of ``doc_id``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
