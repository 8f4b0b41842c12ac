"""The pipeline against brute force, stage by stage, and the registered queries."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sparkmart.llm import decontaminate, queries

from test_text_operators import brute_simhash


@pytest.fixture
def folder(spark, table):
    rng, out = random.Random(1), table("sf")
    words = [f"wort{chr(97 + i)}" for i in range(26)]
    rows = [(i, " ".join(rng.choices(words, k=60)), "de", "s", 1) for i in range(30)]
    rows += [(100, rows[3][1], "de", "s", 1), (101, "12 34 !!", "de", "s", 8), (102, None, "de", "s", None)]
    rows += [(103, rows[5][1][:80] + " benchmark item of some length " + rows[6][1], "de", "s", 1)]
    rows += [(104, 'the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + " ".join(reversed(rows[7][1].split())), "de", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{out}/documents.parquet")
    benchmark = spark.createDataFrame([(1, "Benchmark item of some length")], "item_id long, text string")
    benchmark.write.parquet(f"{out}/benchmark.parquet")
    return out, rows


def test_pipeline(spark, folder):
    out, rows = folder
    texts = {r[0]: r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    texts = {i: texts[i] for i, _, first in brute_simhash(texts.items()) if i == first}
    texts = {i: t for i, t in texts.items() if "benchmark item of some length" not in decontaminate.normal(t)}
    secret = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962'
    texts = {i: t.replace(secret, "[secret]") for i, t in texts.items()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, out).collect()}
    assert {i: r["text"] for i, r in got.items()} == texts
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in got.values())
    assert 104 in got and not {100, 101, 102, 103} & got.keys()


def test_stages_keep_the_columns_and_take_edges(spark, folder, edge, empty):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns
        assert stage(spark, empty, folder[0]).count() == 0
    ids = [r["doc_id"] for r in corpus_pipeline.simhash_stage(spark, docs, folder[0]).collect()]
    assert sorted(ids, key=str) == [10, 11, 12, 7, None]  # 8 and 9 are as empty as 7
    redacted = corpus_pipeline.secret_stage(
        spark, docs.withColumn("text", F.lit("x secret=abcdefgh")), folder[0]
    )
    assert {(r["text"], r["n_chars"]) for r in redacted.collect()} == {("x [secret]", 10)}


def test_queries_are_registered():
    names = list(contract.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)
