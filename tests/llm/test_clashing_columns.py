"""Every stage brings back all columns with their values, whatever their names and types."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import license_scan, simhash


@pytest.fixture
def wide(edge):
    return edge.withColumns(
        {
            "lang_pred": F.lit("given"),
            "secrets": F.lit("mine"),
            "first_id": F.col("doc_id"),
            "first_key": F.lit(3),
            "_row_key": F.lit(4),
            "key_a": F.lit("a"),
            "component": F.lit("c"),
            "print": F.lit("p"),
            "tags": F.create_map(F.lit("k"), F.col("source")),
        }
    ).drop("n_chars")


def test_stages_bring_back_all_columns(spark, wide, tmp_path):
    spark.createDataFrame([(1, "an item that is in none of them")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    given = {(r["doc_id"], r["text"]): r for r in wide.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns and out.dtypes == wide.dtypes
        found = out.collect()
        assert found and all(r == given[r["doc_id"], r["text"]] for r in found), name


def test_rows_are_told_apart_by_where_nulls_are_and_by_maps(spark):
    rows = [(1, "t", None, "x", {"a": 1}), (1, "t", "x", None, {"a": 1}), (1, "t", "x", None, {"a": 2})]
    df = spark.createDataFrame(rows, "doc_id long, text string, p string, q string, m map<string,int>")
    hashes = df.select(*[simhash._row_hash(df, i).alias(f"h{i}") for i in (0, 1)]).collect()
    assert len({r["h0"] for r in hashes}) == len({r["h1"] for r in hashes}) == 3
    assert simhash.keep_one(df.unionAll(df)).count() == 1


def test_licence_sample_is_the_same_wherever_rows_lie(spark):
    rows = [(i % 50 or None, f"line {i % 300}") for i in range(2000)] + [(7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [
        {tuple(r) for r in license_scan._sample(part, 60).collect()}
        for part in (df, df.repartition(9), df.orderBy("text"))
    ]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 60
    assert license_scan._sample(df, 10_000).count() == len({r for r in rows if r[1]})
    assert license_scan._sample(df.limit(0), 10).count() == 0
