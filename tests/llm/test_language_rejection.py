"""Scores do not depend on neighbours; texts in no learned language are rejected."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np

from sparkmart.llm import language_id


def test_texts_end_the_same_alone_and_among_others():
    texts = ["a", "das haus", None, "", "b", "ends in a letter", "x."]
    together, lettered = language_id._bundles(texts, 256)
    for i, text in enumerate(texts):
        alone, _ = language_id._bundles([text], 256)
        assert np.array_equal(alone[0], together[i])
    assert together[0].any() and together[4].any()
    assert lettered.tolist() == [True, True, False, False, True, True, True]


def test_stage_rejects_what_is_like_no_learned_language(spark):
    rng, words = random.Random(2), {"de": "das haus und wasser mit ding für", "fr": "la maison et eau avec chose être"}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(words))
        rows.append((i, " ".join(rng.choices(words[lang].split(), k=12)), lang, "s", 1))
    strange = ["Это длинный текст на русском языке, который никто не видел", "αυτό είναι ένα μεγάλο κείμενο"]
    rows += [(1000 + i, text, None, "s", 1) for i, text in enumerate([*strange, "ok", "12 34", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert got == {*range(300), 1002}
