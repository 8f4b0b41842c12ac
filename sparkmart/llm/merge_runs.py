"""Sorted runs of byte strings: front coding, and merging with a common-prefix loser tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings whose first ``known`` bytes are equal."""
    at, end = known, min(len(a), len(b))
    while at < end:
        x, y = a[at : at + 64], b[at : at + 64]
        if x == y:
            at += 64
            continue
        n = min(len(x), len(y))
        apart = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
        if apart:
            return at + n - (apart.bit_length() + 7) // 8
        return at + n
    return end


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted strings the prefix shared with the one before, the length, and the rest."""
    shared, rest, last = [], [], b""
    for s in strings:
        n = common_prefix(last, s)
        shared.append(n)
        rest.append(s[n:])
        last = s
    lengths = np.array([len(s) for s in strings], np.uint32)
    return np.array(shared, np.uint32), lengths, b"".join(rest)


def front_coded(
    shared: np.ndarray, lengths: np.ndarray, rest: bytes, names: np.ndarray
) -> Iterator[tuple[int, bytes, int]]:
    """A run: prefix shared with the string before, the string, its name."""
    last, at = b"", 0
    for n, length, name in zip(shared.tolist(), lengths.tolist(), names.tolist(), strict=True):
        more = length - n
        last = last[:n] + rest[at : at + more]
        at += more
        yield n, last, name


def merge(runs: Iterable[Iterator[tuple[int, bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """The runs as one sorted run: the prefix shared with the string before, string, name.

    Each loser is stored with the prefix it shares with the winner that beat it, which is the
    last output when the loser is met again. Of two strings the one that shares more with the
    last output is smaller; characters are compared only behind equal shared prefixes.
    """
    runs = list(runs)
    size = 1
    while size < len(runs):
        size *= 2
    heads = [next(r, None) for r in runs] + [None] * (size - len(runs))
    shared = [0] * size  # with the last output

    def play(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        a, b = heads[i], heads[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if shared[i] != shared[j]:
            return (i, j) if shared[i] > shared[j] else (j, i)
        n = common_prefix(a[1], b[1], shared[i])
        if a[1][n : n + 1] <= b[1][n : n + 1]:
            shared[j] = n
            return i, j
        shared[i] = n
        return j, i

    losers = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:  # the first round, from the leaves up
        level //= 2
        nxt = []
        for k in range(level):
            winner, loser = play(winners[2 * k], winners[2 * k + 1])
            losers[level + k] = loser
            nxt.append(winner)
        winners = nxt
    winner = winners[0]
    while heads[winner] is not None:
        _, string, name = heads[winner]
        yield shared[winner], string, name
        heads[winner] = next(runs[winner], None)
        if heads[winner] is not None:
            shared[winner] = heads[winner][0]
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
