"""Importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import importance
from sparkmart.llm import text as tx

SCHEMA = "doc_id long, text string"


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["The", "a1", "éß😀", "x" * 15, "y" * 16, "z" * 17, "Long" * 30, "İstanbul"]
    pool += [f"w{rng.randint(0, 10**9)}" for _ in range(200)]
    joins = [" ", ", ", "\n", "--", "\x7f", "\x00", "_"]
    out = []
    for i in range(n):
        size = rng.choice([0, 3, 19, 20, 60])
        words = [rng.choice(pool[:3] if rng.random() < 0.5 else pool) for _ in range(size)]
        out.append((i, "".join(w + rng.choice(joins) for w in words)))
    return out


def features(text, max_n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute(docs, target, max_n, buckets, percent=10, min_words=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for rows, sums in ((docs, s), (target, t)):
        for _, text in rows:
            for f in features(text, max_n)[1]:
                sums[bucket(f)] += 1
    a, b = sum(s) + buckets, sum(t) + buckets
    gains = [math.floor(1000 * math.log((y + 1) * a / ((x + 1) * b))) for x, y in zip(s, t, strict=True)]
    found = {}
    for i, text in docs:
        n, runs = features(text, max_n)
        weight = sum(gains[bucket(f)] for f in runs)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found[i] = [n, len(runs), weight, score, None]
    able = sorted((-v[3], i) for i, v in found.items() if v[0] >= min_words)
    for r, (_, i) in enumerate(able[: percent * len(able) // 100], 1):
        found[i][4] = r
    return {(i, *v) for i, v in found.items()}


@pytest.mark.parametrize(("max_n", "head"), [(1, importance.HEAD), (2, 64), (3, 64), (2, 1)])
def test_matches_brute_force_with_any_head(spark, max_n, head):
    docs, target = texts(1, 150), texts(2, 40)
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    model = importance.fit(
        df, spark.createDataFrame(target, SCHEMA), max_n=max_n, buckets=97, head_size=head
    )
    got = importance.draw(importance.weigh(df, model, keep=["doc_id"]))
    got = got.select("doc_id", "importance.*", "score", "rank")
    assert {tuple(r) for r in got.collect()} == brute(docs, target, max_n, 97)
    if head == 64:
        assert len(model.head.hashes) and len(model.head.pairs)


def test_crc_of_words_of_any_length():
    words = [bytes([97 + i % 26]) * n for i, n in enumerate([1, 2, 8, 9, 63, 64, 65, 300, 0])]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    seed = np.full(len(words), zlib.crc32(b"first"), np.uint32)
    got = importance.crc_on(seed, data, starts, ends)
    assert got.tolist() == [zlib.crc32(b"first" + w) for w in words]


def test_a_text_longer_than_a_stretch(monkeypatch, spark):
    monkeypatch.setattr(importance.Words.stretches, "__defaults__", (7,))
    words = importance.Words(tx.pa.array(["a b c a b", None, "c " * 40]))
    head = importance.Head.of(*(np.zeros(0, np.uint64),) * 2)
    found = [(i, b) for at, bucket in words.buckets(head, 2, 1 << 31) for i, b in zip(at, bucket, strict=True)]
    spelled = [*"abcab", *"c" * 40]
    expected = [(i, zlib.crc32(w.encode()) % (1 << 31)) for i, w in enumerate(spelled)]
    expected += [
        (i, zlib.crc32(f"{spelled[i]} {spelled[i + 1]}".encode()) % (1 << 31))
        for i in range(len(spelled) - 1)
        if i != 4
    ]
    assert sorted(found) == sorted(expected)


def test_edges(spark, edge, empty):
    df = edge.withColumn("rank", F.lit("mine")).withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    model = importance.fit(df, empty)
    weighed = importance.weigh(df, model)
    assert weighed.columns == [*df.columns, "importance"]
    drawn = importance.draw(weighed, percent=50, min_words=1)
    rows = drawn.select("doc_id", "importance.n_words", "score", "rank", "m", "shard").collect()
    assert len(rows) == 8
    # Five rows have words; the row without an id is among them, and repeated rows both rank.
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2]
    assert all(r["score"] is not None for r in rows)
    assert max(r["n_words"] for r in rows) == 40_000
    nothing = importance.draw(importance.weigh(empty, importance.fit(empty, empty)))
    assert nothing.collect() == []


def test_ties_in_score_and_id_part_between_ranges(spark):
    df = spark.createDataFrame([(1, "same words " * 10)] * 400, SCHEMA).repartition(7)
    model = importance.fit(df, df)
    got = importance.draw(importance.weigh(df, model), percent=100)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 401))
