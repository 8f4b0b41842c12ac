"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Method: every rule votes good, bad or abstains on each document. The votes are reduced to
counts per vote pattern in Spark; expectation-maximisation over these patterns estimates each
rule's accuracy (abstaining says nothing), and the posterior probability of a pattern is the
document's quality. The patterns are at most 3 to the power of the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import materialise, workspace

from . import text as tx

REPEAT_WORDS = 8
GOOD, BAD = 1, -1

_FEATURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, n_lines long, n_plain long, n_upper long, n_letters long"
)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_SYMBOL = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _table("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True  # letters beyond ASCII, as far as bytes can tell
_STOP = _table(".,;:?!")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[offsets])


def _repeated_words(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Which words are in a window that is found twice or more in its text."""
    at, owner = tx.window_starts(firsts, REPEAT_WORDS)
    keys = tx.window_hashes(hashes, at, REPEAT_WORDS) ^ tx.mix(owner.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys) + 1, bool)
    twice[1:-1] = same
    found = at[order[twice[1:] | twice[:-1]]] if len(keys) else at
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, found, 1)
    np.add.at(change, found + REPEAT_WORDS, -1)
    return np.cumsum(change[:-1]) > 0


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tx.pieces(batches, 1):
        data, offsets = tx.text_bytes(piece.column(1))
        starts, ends, firsts = tx.words(data, offsets)
        raw = data.tobytes()
        lines, dup_lines = [], []
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = [x for x in raw[low:high].split(b"\n") if x.strip()]
            lines.append(len(own))
            dup_lines.append(len(own) - len(set(own)))
        solid = np.zeros(len(data) + 1, np.int8)
        np.add.at(solid, starts, 1)
        np.add.at(solid, ends, -1)
        in_word = np.cumsum(solid[:-1], dtype=np.int8) > 0
        letter = _LETTER[data]
        odd = np.concatenate([[0], np.cumsum(~letter, dtype=np.int64)])
        odd = odd[ends] - odd[starts]
        plain = (odd == 0) | ((odd == 1) & (ends - starts > 1) & _STOP[data[ends - 1]])
        repeated = _repeated_words(tx.word_hashes(data, starts, ends), firsts)
        columns = (
            np.diff(firsts),
            _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
            _per_text(_SYMBOL[data], offsets),
            dup_lines,
            _per_text(repeated, firsts),
            lines,
            _per_text(plain, firsts),
            _per_text(_UPPER[data], offsets),
            _per_text(letter, offsets),
        )
        names = [c.split()[0] for c in _FEATURES.split(",")]
        arrays = [piece.column(0), *(pa.array(c, pa.int64()) for c in columns)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def measure(docs: DataFrame) -> DataFrame:
    """Counts per row of ``docs`` (doc_id, text) that the rules look at.

    Words are separated by ASCII white space; null and empty texts have counts of zero.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_measure, _FEATURES)


def base_failed() -> Column:
    """Too short, or mostly repeated."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _vote(bad: Column, good: Column | None = None) -> Column:
    out = F.when(bad, BAD)
    return (out.when(good, GOOD) if good is not None else out).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """The votes. Each detector knows one kind of junk, so it votes bad or abstains."""
    n, chars = F.col("n_words"), F.greatest("word_chars", F.lit(1))
    letters = F.greatest("n_letters", F.lit(1))
    return {
        "symbols": _vote(20 * F.col("n_symbols") > chars),
        "plain_words": _vote(10 * F.col("n_plain") < 7 * n, 20 * F.col("n_plain") >= 17 * n),
        "shouting": _vote(2 * F.col("n_upper") > letters),
        "repeats": _vote(100 * F.col("n_repeat_words") > 30 * n),
        "duplicate_lines": _vote(10 * F.col("n_dup_lines") > 6 * F.col("n_lines")),
        "word_length": _vote((chars > 25 * n) | (chars < 2 * n)),
    }


def estimate(
    patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200
) -> tuple[float, list[float]]:
    """Share of good documents and accuracy of each rule, by EM over pattern counts."""
    if not patterns:
        return 0.5, []
    votes = np.array([p for p, _ in patterns], np.float64)
    counts = np.array([c for _, c in patterns], np.float64)
    prior, accuracy = 0.7, np.full(votes.shape[1], 0.8)
    for _ in range(rounds):
        good = posterior(votes, prior, accuracy)
        right = np.where(votes > 0, good[:, None], 1 - good[:, None]) * (votes != 0)
        total = ((votes != 0) * counts[:, None]).sum(axis=0)
        new = ((right * counts[:, None]).sum(axis=0) + 8) / (total + 10)
        new = new.clip(0.55, 0.99)
        share = ((good * counts).sum() + 7) / (counts.sum() + 10)
        done = abs(share - prior) + np.abs(new - accuracy).sum() < 1e-9
        prior, accuracy = share, new
        if done:
            break
    return float(prior), accuracy.tolist()


def posterior(votes: np.ndarray, prior: float, accuracy: np.ndarray) -> np.ndarray:
    """Probability of good for each row of votes."""
    accuracy = np.asarray(accuracy)
    odds = np.log(prior / (1 - prior)) + votes @ np.log(accuracy / (1 - accuracy))
    return 1 / (1 + np.exp(-odds))


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The counts, the votes (``vote_*``), ``quality`` and ``kept`` of every row of ``docs``.

    ``quality`` is the posterior probability, and ``kept`` whether it reaches ``least`` in a
    document that did not fail outright (``base_failed``). Null and empty texts fail. Repeated
    rows are judged alike; null ids and other columns do no harm; an empty table gives none.
    """
    spark = docs.sparkSession
    votes = {f"vote_{k}": v for k, v in rules().items()}
    measured = measure(docs).withColumn("base_failed", base_failed()).withColumns(votes)
    measured = materialise(measured, f"{workspace(spark, 'quality')}/measured")
    names = list(votes)
    counted = measured.groupBy(*names).count().orderBy(*names).collect()
    patterns = [(tuple(r[n] for n in names), r["count"]) for r in counted]
    prior, accuracy = estimate(patterns)
    odds = F.lit(float(np.log(prior / (1 - prior))))
    for name, a in zip(names, accuracy, strict=False):
        odds = odds + F.col(name) * F.lit(float(np.log(a / (1 - a))))
    return measured.withColumn("quality", 1 / (1 + F.exp(-odds))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= least)
    )
