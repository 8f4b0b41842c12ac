"""Corpus pipeline: documents to token ids, in stages that each write and reread Parquet."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import bpe, decontaminate, language_id, secret_scan, simhash
from sparkmart.llm.text import free_names
from sparkmart.session import materialise, workspace

VOCABULARY = "byte_bpe_50k.json"


def _aside(
    docs: DataFrame, *names: str
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` without columns of these names, which an operator adds, and the way back to all.

    Given columns of these names wait under others and come back as they were.
    """
    clash = [c for c in docs.columns if c.lower() in names]
    others = dict(zip(clash, free_names([*docs.columns, *names], *clash), strict=True))
    given = docs.select(*[F.col(f"`{c}`").alias(others.get(c, c)) for c in docs.columns])

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{others.get(c, c)}`").alias(c) for c in docs.columns])

    return given, back


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no learned language: null, without a letter, or like none of them.

    The model learns from the stage's own labelled rows, without the held-out quarter, which
    sets the least cosine that a text must have. With no labelled rows nothing can be told
    apart, and the stage keeps whatever has a letter. So it does with very short texts.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    if not model:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    least = language_id.least_score(docs, model)
    known = ~language_id.long_enough() | (F.col("score") >= least)
    aside, back = _aside(docs, "lang_pred", "score")
    return back(language_id.label(aside, model).where((F.col("lang_pred") != "und") & known))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, that of the smallest ``doc_id``.

    Rows are told apart by all their columns: of repeated rows one stays, and texts that share a
    ``doc_id`` are judged one by one. Rows without ``doc_id`` stand for a group without others.
    """
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within its edit budget."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; ``n_chars`` follows, where there is one."""
    aside, back = _aside(docs, "secrets")
    done = secret_scan.redact(secret_scan.scan(aside, by_part=True))
    if "n_chars" in docs.columns:
        changed, kind = F.size("secrets") > 0, docs.schema["n_chars"].dataType
        length = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", length)
    return back(done)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ``ids``, ``n_tokens``, and the ``text`` decoded from the ids."""
    path = public_tokenizers.path(VOCABULARY)
    done = bpe.decode(bpe.encode(docs, path), path)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe", bpe_stage),
]

#: Training and tokenisation cannot be written in SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = workspace(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"{folder}/{i}-{name}")
    return docs
