"""The trie of conversations against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = (defaultdict(int) for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            own[0], len(node), members[node[:-1]][0] if node else -1, len(own), children[node],
            leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def rows_of(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               "saved_tokens", "ends_sha256")
    return sorted(
        tuple(-1 if v is None else v for v in r) for r in df.select(*columns).collect()
    )


def conversations(seed, n):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(3 * n), n):
        length = rng.choice([1, 2, 3, 7, 8, 20])
        for d in range(length):
            text = rng.choice(["a", "bb", "é😀"]) if rng.random() < 0.5 else f"same{d}"
            out.append((c, d if rng.random() < 0.95 or d else None, rng.choice([None, "user"]), text))
    return out


@pytest.mark.parametrize("batch_turns", [1, 64, pt.BATCH_TURNS])
def test_trie_matches_brute_force(spark, batch_turns):
    rows = conversations(1, 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = pt.trie(pt.rebuilt(df, pt.crc_head(6)), batch_turns=batch_turns)
    assert rows_of(got) == brute(rebuild(rows))


def test_search_and_split_in_one_trie():
    rng = random.Random(5)
    for _ in range(60):
        paths = [[rng.randint(0, 1) for _ in range(rng.randint(0, 40))] for _ in range(30)]
        paths += [p[: len(p) // 2] for p in paths]
        sizes = np.array([len(p) for p in paths])
        flat = np.array([x for p in paths for x in p], np.uint64)
        held = pt.Paths(sizes, flat, flat + np.uint64(7))
        trie = pt.ZFastTrie(held)
        for low in range(0, 60, 9):
            trie.insert(range(low, min(60, low + 9)))
        seen = {tuple(p) for p in paths}
        nodes = {tuple(paths[i][:e]) for i, e in zip(trie.path, trie.ends, strict=True) if e}
        inner = {p[:d] for p in seen for d in range(len(p) + 1)}
        fork = {p for p in inner if (*p, 0) in inner and (*p, 1) in inner}
        assert nodes == {p for p in seen | fork if p}
        assert len(trie.handles) == len(trie.edges) == len(nodes)
        assert all(trie.exit(i) == (trie.stops[i], len(paths[i])) for i in range(60))


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.trie(pt.rebuilt(empty, pt.crc_head(6))).collect() == []
    rows = [(None, 0, "user", "lost"), (100, 0, None, None), (100, 0, None, None),
            (100, None, "", "x" * 100_000), (-3, 1, "user", "b"), (7, 0, "user", "no hub")]
    rows += [(205, i, "user", f"t{i}") for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS hub", "3 AS k1")
    assert rows_of(pt.trie(pt.rebuilt(df))) == brute(
        {100: [("", "x" * 100_000), ("", ""), ("", "")], -3: [("user", "b")], 7: [("user", "no hub")],
         205: [("user", f"t{i}") for i in range(120)]}
    )
    # Without a turn of its own left, and without a hub, a conversation ends in the root.
    lone = spark.createDataFrame([(7, 0, "user", "gone")], SCHEMA)
    got = rows_of(pt.trie(pt.rebuilt(lone, lambda c: F.lit(3))))
    assert got == [(7, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


def test_many_copies_of_one_conversation(spark):
    rows = [(c, d, "user", f"t{d}") for c in range(0, 300_000, 400) for d in range(3)]
    got = rows_of(pt.trie(pt.rebuilt(spark.createDataFrame(rows, SCHEMA)), batch_turns=100))
    ids = ",".join(str(c) for c in range(0, 300_000, 400))
    assert [r[3:7] for r in got] == [(750, 1, 1, 749 * 6), (750, 1, 1, 749 * 6), (750, 1, 1, 749 * 4), (750, 0, 1, 749 * 2)]
    assert got[3][7] == hashlib.sha256(ids.encode()).hexdigest()
