"""Byte-level BPE: encode texts to token ids and decode ids to texts.

Method: batched numpy merge rounds. The symbols of many words lie in one flat array; the
rank of every adjacent pair is found by binary search over the sorted keys of all merges, and
each round merges the pair of lowest rank in every word at once.

The vocabulary file is a parameter (a ``tokenizers`` JSON file of a byte-level BPE model,
found on every executor); it is read once per Python worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

#: Fixed value: how byte-level BPE cuts a text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

_NONE = np.iinfo(np.int64).max
CACHED_WORDS = 300_000


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, and its byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merge keys, ranks and token bytes as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        size = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, i in vocab.items():
            tokens[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        special = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})") if special else None
        self.words = regex.compile(WORDS)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, or ``_NONE``."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one after another, and the number of each word's ids."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        while len(symbols):
            rank = np.full(len(symbols), _NONE)
            rank[:-1] = self.merge_ranks(symbols[:-1], symbols[1:])
            rank[:-1][word[:-1] != word[1:]] = _NONE
            first = np.flatnonzero(np.diff(word, prepend=-1))
            count = np.diff(first, append=len(word))
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            over = best == _NONE
            done_ids.append(symbols[over])
            done_words.append(word[over])
            symbols, word, rank, best = (a[~over] for a in (symbols, word, rank, best))
            at = np.flatnonzero(rank == best)
            if not len(at):
                break
            # of overlapping pairs of equal symbols the first, third, ... of a run are merged
            new = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            place = np.arange(len(at)) - np.repeat(new, np.diff(new, append=len(at)))
            at = at[place % 2 == 0]
            symbols[at] = self.merged[best[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done_ids:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(words))


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Cache:
    """Ids of the words met so far, in one flat array."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        special = self.vocabulary.special
        self.index = {("special", t): i for i, t in enumerate(special)}
        self.ids = np.array(list(special.values()), np.int32)
        self.counts = np.ones(len(special), np.int64)

    def add(self, words: list[str]) -> None:
        ids, counts = self.vocabulary.encode_words([w.encode() for w in words])
        base = len(self.index)
        self.index.update(zip(words, range(base, base + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.counts = np.concatenate([self.counts, counts])

    def look_up(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``words`` and the number of ids of each."""
        missing = [w for w in set(words) if w not in self.index]
        if missing and len(self.index) + len(missing) > CACHED_WORDS:
            self.clear()
            missing = [w for w in set(words) if w not in self.index]
        if missing:
            self.add(missing)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        counts = self.counts[at]
        starts = np.cumsum(self.counts) - self.counts
        return self.ids[tx.ranges(starts[at], counts)], counts


def _encoder(path: str):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        cache, find, special = _Cache(vocabulary), vocabulary.words.findall, vocabulary.special
        for piece in tx.pieces(batches, 1, 2 << 20):
            words, sizes = [], []
            for text in piece.column(1).to_pylist():
                before = len(words)
                text = text or ""
                if special and any(t in text for t in special):
                    for part in vocabulary.cut.split(text):
                        words += [("special", part)] if part in special else find(part)
                else:
                    words += find(text)
                sizes.append(len(words) - before)
            ids, counts = cache.look_up(words)
            ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *sizes])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column(0), lists], names=["doc_id", "ids"])

    return encode


def _decoder(path: str):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            step = 500
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                lists = part.column(1)
                sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()])
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                texts, at = [], 0
                for size in sizes.tolist():
                    own = ids[at : at + size]
                    at += size
                    spots = tx.ranges(vocabulary.starts[own], vocabulary.lengths[own])
                    texts.append(vocabulary.bytes[spots].tobytes().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    return decode


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs`` (doc_id, text).

    Special tokens that occur in a text get their own id. Null and empty texts have no ids; a
    null ``doc_id``, repeated rows and other columns do no harm.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encoder(path), "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that the ids stand for (null ids: empty).

    Special tokens are kept; bytes that are no UTF-8 become replacement characters.
    """
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(path), "doc_id long, ids array<int>, text string"
    )
