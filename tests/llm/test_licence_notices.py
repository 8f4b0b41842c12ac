"""Licences: unseen wording, every family's short forms, edge rows, and a brute-force scan."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import license_scan as ls

PLAIN = [
    (100 + i, f"plain line of text number {i}\nthe house of the sea and this is a use of it\nfree as the {i} winds")
    for i in range(60)
]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(PLAIN, "doc_id long, text string")


@pytest.fixture(scope="module")
def model(plain):
    return ls.train(plain)


def test_unseen_notices_and_names(plain):
    rows = ls.training_rows(plain)
    folds = rows.where("label <> 'none'").groupBy("label").agg(F.count_distinct("fold").alias("n"))
    assert {r["n"] for r in folds.collect() if r["label"] != "mpl"} == {ls.FOLDS}
    scored = ls.held_out(rows)
    named = scored.where(~F.col("family").isin(ls.NONE, ls.UNKNOWN))
    right, all_named = named.agg(F.count_if(F.expr("label = family")), F.count("*")).first()
    assert all_named > 300 and right >= 0.95 * all_named
    assert scored.where("label = 'none' and family not in ('none', 'unknown')").count() == 0
    slope, shift = ls.calibration(scored)
    assert slope >= 0 and math.isfinite(shift)
    assert ls.calibration(scored.limit(0)) == (1.0, 0.0)


def test_calibration_follows_the_share_of_right_names(spark):
    rows = [("mit" if i % 10 < (9 if p > 0.5 else 2) else "gpl", "mit", p) for p in (0.3, 0.9) for i in range(500)]
    scored = spark.createDataFrame(rows, "label string, family string, probability double")
    slope, shift = ls.calibration(scored)
    for p, share in ((0.3, 0.2), (0.9, 0.9)):
        assert abs(1 / (1 + math.exp(-slope * math.log(p / (1 - p)) - shift)) - share) < 0.02


def test_corpus_lines_that_look_like_a_licence_are_no_negatives(spark, plain):
    lines = ["Licensed under the Moonbase Sharing License, Version 7.0.", "License: Moonbase Agreement"]
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    rows = ls.training_rows(plain.unionAll(odd))
    kept = ls.without_doubtful(rows, ls.held_out(rows))
    assert rows.where(F.col("paragraph").isin(lines)).count() == 2
    assert kept.where(F.col("paragraph").isin(lines)).count() == 0
    assert rows.count() - kept.count() < 5


def test_short_forms_of_every_family(spark, model):
    texts = [(f, ls.SPDX.format(i)) for f, ids in ls.IDENTIFIERS.items() for i in ids]
    texts += [(f, s.format(n)) for f, names in ls.NAMES.items() for n in names for s in ls.SAYINGS]
    texts += [(f, t) for f, sentences in ls.SENTENCES.items() for t in sentences]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["family"] for r in ls.scan(docs, model).collect()}
    wrong = [(f, t, found.get(i)) for i, (f, t) in enumerate(texts) if found.get(i) not in (f, ls.UNKNOWN)]
    assert not wrong
    assert sum(found.get(i) == f for i, (f, _) in enumerate(texts)) >= 0.95 * len(texts)


def brute_force(rows, model):
    """The scan without anchors, joins and SQL."""

    def grams(text):
        tokens = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower())
        return {*tokens, *(f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False))}

    def like(own, template):
        common, short = len(own & template), min(len(own), len(template))
        if short >= 5 and common >= 4:
            return common / short
        return common // len(template) if short else 0

    weights = {gram: w for gram, *w in model.weights}
    out = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            own = grams(line)
            known = [weights[g] for g in own if g in weights]
            if not known:
                continue
            odds = [b + sum(w[k] for w in known) for k, b in enumerate(model.intercepts)]
            best = max(range(len(odds)), key=odds.__getitem__)
            family = model.classes[best]
            if family == ls.NONE:
                continue
            rest = max(sum(math.exp(x - odds[best]) for k, x in enumerate(odds) if k != best), 1e-12)
            p = 1 / (1 + math.exp(model.slope * math.log(rest) - model.shift))
            most = max((like(own, grams(t)) for t in ls.TEMPLATES.get(family, [])), default=0)
            if p < model.threshold or most < ls.CONFIRM:
                family = ls.UNKNOWN
            n, top = out.get((doc_id, family), (0, 0.0))
            out[doc_id, family] = n + 1, max(top, p)
    return out


def test_scan_equals_brute_force(spark, model):
    said = [t for _, _, t in ls.wordings()][::5]
    rows = PLAIN + [(i, f"before it\n{t} and {i}\n\n{t}") for i, t in enumerate(said)]
    rows += [(900, "Licensed under the Moonbase Charter, version 3.\nAll rights reserved. MIT License"), (901, None)]
    rows += [(902, "word " * 40_000 + "\nReleased under the MIT License."), (None, "GPLv3"), (None, "License: GPLv3")]
    rows += [(903, "License: MPL 2.0")] * 3 + [(904, ""), (905, " \n\t \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.selectExpr("*", "'p' AS paragraph", "'q' AS probability", "1 AS family", "2 AS grams", "3 AS times")
    found = {(r["doc_id"], r["family"]): (r["n_paragraphs"], r["probability"]) for r in ls.scan(clash, model).collect()}
    expected = brute_force(rows, model)
    assert found.keys() == expected.keys()
    for key, (n, p) in expected.items():
        assert found[key][0] == n and abs(found[key][1] - p) < 1e-9
    assert found[902, "mit"][0] == 1 and found[903, "mpl"][0] == 3


def test_edge_rows(edge, empty, model):
    assert ls.scan(edge, model).count() == 0
    assert ls.scan(empty).count() == 0
