"""A benchmark of many blocks gives the matches of one block."""

from __future__ import annotations

from sparkmart.llm import decontaminate


def test_blocks_give_the_same_matches(spark, monkeypatch):
    said = [f"question number {i} asks how many of the {i * 37} birds came home in spring" for i in range(40)]
    items = [(i, t) for i, t in enumerate(said)] + [(None, said[0]), (40, None), (41, " "), (1, said[1])]
    rows = [(i, f"before it {t[:30]}x{t[30:]} and after") for i, t in enumerate(said)]
    rows += [(100, said[3] + "\n" + said[4]), (100, said[3] + "\n" + said[4]), (None, said[5]), (101, None), (102, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def found():
        return sorted(map(str, decontaminate.matches(docs, benchmark).collect()))

    def kept():
        return sorted(map(str, decontaminate.clean(docs, benchmark).collect()))

    once, clean = found(), kept()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert len(list(decontaminate._blocks(benchmark))) > 3
    assert found() == once and len(once) > 40
    assert kept() == clean and len(clean) == 2
    assert decontaminate.matches(docs, benchmark.limit(0)).count() == 0


def test_clean_by_blocks_gives_rows_back_as_they_were(spark, edge, empty, monkeypatch):
    said = [f"question number {i} asks how many of the {i * 37} birds came home in spring" for i in range(40)]
    benchmark = spark.createDataFrame(list(enumerate(said)), "item_id long, text string")
    rows = [(1, said[7], "en", "s", 1)] * 2 + [(2, f"{said[7]} and {said[9]}", None, "s", 1)]
    docs = edge.unionByName(spark.createDataFrame(rows, empty.schema), allowMissingColumns=True)
    docs = docs.selectExpr("*", "3 AS key_a", "map('k', doc_id) AS key_B", "4 AS `a.b`")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    got = decontaminate.clean(docs, benchmark)
    assert got.columns == docs.columns
    kept = docs.where("doc_id IS NULL OR doc_id > 2")
    assert sorted(map(str, got.collect())) == sorted(map(str, kept.collect()))
    assert decontaminate.clean(empty, benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == docs.count()
