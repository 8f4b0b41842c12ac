"""Substring dedup: word windows that also start in an earlier document are removed.

Method: Rabin-Karp hashes of every window of ``length`` words, rolled with prefix sums
modulo 2**64. Windows are dealt to shards by their hash, one packed row per chunk of
documents and shard, and each shard finds the smallest document of every hash. Windows in
other documents are repeats; they merge into maximal intervals of removed words.

What repeats within a chunk is settled there (see ``repeats``), where the probability of a
collision is given too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats
from . import text as tx


def _window_hashes(length: int):
    def hashed(texts: pa.Array):
        data, offsets = tx.text_bytes(texts)
        starts, ends, firsts = tx.words(data, offsets)
        at, row = tx.window_starts(firsts, length)
        hashes = tx.window_hashes(tx.word_hashes(data, starts, ends), at, length)
        return hashes, row, at - firsts[row]

    return hashed


def _removal(length: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
            ("kept", pa.string()),
        ]
    )

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, 2):
            out = []
            for doc_id, text, found in zip(
                piece.column(0).to_pylist(),
                piece.column(2).to_pylist(),
                piece.column(3).to_pylist(),
                strict=True,
            ):
                kept = all_words = (text or "").encode().split()
                if found:
                    gone = tx.covered(len(all_words), repeats.unpack_runs(found), length)
                    kept = list(compress(all_words, ~gone))
                joined = b" ".join(kept)
                digest = hashlib.sha256(joined).hexdigest()
                n = len(all_words)
                out.append((doc_id, n, n - len(kept), digest, joined.decode()))
            columns = zip(*out, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return remove


def remove_repeats(docs: DataFrame, length: int = 13, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and the kept words.

    Words are separated by the six ASCII white-space bytes. Null or empty texts have no
    words. Rows with a null ``doc_id`` are kept whole and remove nothing elsewhere. Rows
    that share a ``doc_id`` are one document: neither is before the other. Columns other than
    ``doc_id`` and ``text`` are ignored; an empty table gives an empty result.
    """
    found = repeats.repeated_positions(docs, _window_hashes(length), earlier=True)
    out = repeats.with_found(docs, found).mapInArrow(
        _removal(length),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string",
    )
    return out if with_text else out.drop("kept")
