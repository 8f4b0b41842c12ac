"""The SimHash stage keeps one defined row of each group, whatever the ids."""

from __future__ import annotations

import random

import corpus_pipeline


def test_shared_and_null_ids(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(5, a, "x"), (5, b, "x"), (5, b, "x"), (6, a, "x"), (None, b, "x"), (None, c, "x"), (None, c, "x"),
            (None, c, "y"), (7, d, "x"), (7, d, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = []
    for part in (docs, docs.repartition(7), docs.orderBy("source", ascending=False)):
        got = corpus_pipeline.simhash_stage(spark, part, "")
        assert got.columns == docs.columns
        runs.append(sorted(map(tuple, got.collect()), key=str))
    assert runs[0] == runs[1] == runs[2]
    assert sorted([(i, t) for i, t, _ in runs[0]], key=str) == sorted([(5, a), (5, b), (None, c), (7, d)], key=str)
