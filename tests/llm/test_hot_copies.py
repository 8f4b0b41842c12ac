"""Keys that hold most rows are spread over tasks, and the results stay the same."""

from __future__ import annotations

import random

import pytest

from sparkmart.llm import license_scan, simhash
from sparkmart.llm.components import components


@pytest.mark.parametrize("rows_per_task", [20, 4_000_000])
def test_components_with_a_crowded_node(spark, tmp_path, rows_per_task):
    rng = random.Random(3)
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(400, 440)]
    edges += [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120)]
    edges += [(5, 5), (0, 1), (-9, 440)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            top[b] = a
    expected = sorted((x, find(x)) for x in top if any(x in e and e[0] != e[1] for e in edges))
    df = spark.createDataFrame(edges, "u long, v long")
    got = components(df, str(tmp_path / "parts"), rows_per_task).distinct()
    assert sorted(map(tuple, got.collect())) == expected


def test_many_copies_of_one_text(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(20)]
    rows = [(i, texts[0]) for i in range(200)] + [(200 + i, "") for i in range(100)]
    rows += [(300 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def outcome():
        found = simhash.near_duplicates(docs).collect()
        return sorted(map(str, found)), sorted(map(str, simhash.keep_one(docs).collect()))

    plain = outcome()
    monkeypatch.setattr(simhash, "ROWS_PER_TASK", 25)
    assert outcome() == plain
    assert len(plain[0]) == len(rows) and len(plain[1]) == 21


def test_one_licence_line_in_most_documents(spark, monkeypatch):
    line = "Licensed under the Apache License, Version 2.0"
    rows = [(i, f"text {i}\n{line}") for i in range(120)]
    rows += [(i, f"plain words of document {i}") for i in range(120, 160)] + [(None, line), (1, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = license_scan.train(docs)
    plain = sorted(map(str, license_scan.scan(docs, model).collect()))
    monkeypatch.setattr(license_scan, "ROWS_PER_TASK", 10)
    assert sorted(map(str, license_scan.scan(docs, model).collect())) == plain
    assert len(plain) == 121
