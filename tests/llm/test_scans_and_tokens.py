"""Scans, language, pages, decontamination and tokens."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import log2

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmart.llm import bpe, decontaminate, html_text, language_id, license_scan, secret_scan

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return found


def entropy_secrets(text):
    found = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text):
        own = m[0]
        if not re.search("[0-9]", own) or any(re.search(p, own) for p in secret_scan.ALLOWED):
            continue
        least = 3.0 if re.fullmatch("[0-9a-fA-F]+", own) else 3.7
        hits = [
            i
            for i in range(len(own) - 19)
            if -sum(c / 20 * log2(c / 20) for c in Counter(own[i : i + 20]).values()) >= least - 1e-9
        ]
        if hits:
            found.append((m.start() + hits[0], 3, m.start() + hits[-1] + 20))
    return found


def test_secrets_match_brute_force(spark):
    rng = random.Random(1)
    parts = ["token", "=", ":", " ", "secret", "AKIA", "ABCDEFGH01234567", "abcdef0123456789", "'", '"', "é",
             "😀", "\n", "Qx7Lp2Vn9Tz4Rk8Ws1", "password", "API_KEY", "....", "zzzz"]
    texts = [None, "", "secret=token: abcdefgh", "AKIA" + "A" * 16 + " " + "f" * 24 + "g" + "0" * 30]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanned = secret_scan.scan(df)
    got = {r["doc_id"]: r for r in secret_scan.redact(scanned).collect()}
    for i, text in enumerate(texts):
        expected = sorted(base_secrets(text or "") + entropy_secrets(text or ""))
        assert [tuple(s) for s in got[i]["secrets"]] == expected
        if text is not None:
            hidden = set()
            for a, _, b in expected:
                hidden |= set(range(a, b))
            clear = "".join(c for k, c in enumerate(text) if k not in hidden)
            assert got[i]["text"].replace("[secret]", "") == clear
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_secrets_edges(spark, edge, empty):
    assert secret_scan.redact(secret_scan.scan(edge)).drop("secrets").count() == 8
    assert secret_scan.scan(empty).count() == 0


def notices():
    return [
        (1, "Some prose here.\nReleased under the MIT License.\nmore prose"),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "Nothing to see, only a public place with a license plate nearby that rights itself."),
        (4, "Licensed under the Moonbase Sharing License, Version 7.0."),
        (5, None),
        (6, "Text.\nThis program is free software: you can redistribute it and/or modify it under the terms of"
            " the GNU General Public License as published by the Free Software Foundation, either version 3"),
        (None, "All rights reserved."),
    ] + [(100 + i, f"plain line of text number {i}\nthe house of the sea and this is a use of it") for i in range(40)]


def test_licences(spark):
    docs = spark.createDataFrame(notices(), "doc_id long, text string").withColumn("family", F.lit("x"))
    model = license_scan.train(docs)
    assert model.threshold >= 0.3 and model.weights
    got = {(r["doc_id"], r["family"]) for r in license_scan.scan(docs, model).collect()}
    assert {(1, "mit"), (2, "apache-2.0"), (6, "gpl"), (None, "proprietary"), (4, "unknown")} <= got
    assert not [x for x in got if x[0] in (3, 5) or (x[0] or 0) >= 100]
    # the words that paragraphs are chosen by lose nothing that scoring would find
    every = license_scan.paragraphs(docs).select("paragraph").distinct()
    named = license_scan.score(every, model).where("family <> 'none'")
    chosen = F.arrays_overlap(
        license_scan.words(F.col("paragraph")), F.array(*[F.lit(a) for a in model.anchors])
    )
    assert named.where(~chosen).count() == 0
    assert license_scan.scan(docs.limit(0), model).count() == 0


def test_languages(spark, edge, empty):
    words = {"en": "the house and water with thing", "de": "das haus und wasser mit ding für",
             "fr": "la maison et eau avec chose être"}
    rng, rows = random.Random(2), []
    for i in range(300):
        lang = rng.choice(sorted(words))
        rows.append((i, " ".join(rng.choices(words[lang].split(), k=12)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs.where(~language_id.held_out()))
    held = language_id.predict(docs, model).join(docs, "doc_id").where(language_id.held_out())
    assert held.count() > 40
    assert held.where("lang_pred = lang").count() / held.count() > 0.98
    labelled = language_id.label(edge, model)
    got = {(r["doc_id"], r["text"]): r for r in labelled.collect()}
    assert [got[(i, t)]["lang_pred"] for i, t in ((7, None), (8, ""), (9, " \n\t "))] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values()) and labelled.count() == 8
    assert language_id.train(empty) == {}
    assert {r["lang_pred"] for r in language_id.predict(edge, {}).collect()} == {"und"}


PAGES = [
    ("<article><h1>T</h1><p><b>One&amp;<br><p>two&nbsp;three</article><footer>f</footer>", "T One& two three"),
    ("<body><header>Site</header><article><header>By X</header><p>One <b>two</b>three.</p><aside>Ad</aside>"
     "<div class='ad-box'>buy</div><p>Four</p><section id='comments'>nice</section></article>"
     "<article class='comment'>me too</article>", "One twothree. Four"),
    ("<body><div class=ad>x<article><p>Hi.<p>You<br>there</article><footer>z", "Hi. You there"),
    ("<div id=top><a href=x>Home</a> <a href=y>News</a></div><div><h2>Title</h2><p>A long paragraph with text."
     "</p></div><div class='footer'>Copyright</div>", "Title A long paragraph with text."),
    ("<div class='cookie-notice'>We use cookies</div><main><h1>T</h1><form>Search</form><p>Body</main>", "T Body"),
    ("<article>x<script>var a='<p>no</p>';</script> a < b</article>", "x a < b"),
    (None, ""),
    ("", ""),
]


def test_pages(spark):
    rows = [(i, "u", page) for i, (page, _) in enumerate(PAGES)] + [(None, None, "<p>x</p>" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert [got[i] for i in range(len(PAGES))] == [text for _, text in PAGES]
    assert len(got[None].split()) == 100_000
    assert html_text.main_text(pages.limit(0)).count() == 0


def edit_distance_to_part(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i in range(1, len(item) + 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (item[i - 1] != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    items = [(i, "".join(rng.choice("abcd efg") for _ in range(rng.randint(10, 90)))) for i in range(12)]
    docs = []
    for i in range(40):
        text = "".join(rng.choice("abcd efg") for _ in range(150))
        own = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(own) // 12 + 2)):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], ["x"], [own[at], "y"]])
        docs.append((i, text + " " + "".join(own).upper() + "\n" + text))
    expected = set()
    for i, text in docs:
        for item_id, item in items:
            item = decontaminate.normal(item)
            n = edit_distance_to_part(item, decontaminate.normal(text))
            if n <= len(item) // 12:
                expected.add((i, item_id, n))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (50, None), (51, " ")], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.matches(frame, benchmark).collect()} == expected
    clean = {r["doc_id"] for r in decontaminate.clean(frame, benchmark).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _, _ in expected}


def test_decontamination_edges(spark, edge, empty):
    benchmark = spark.createDataFrame([(1, "repeated row of seven words")], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.matches(edge, benchmark).collect()] == [11, 11]
    assert decontaminate.clean(edge, benchmark).count() == 6
    assert decontaminate.matches(edge, benchmark.limit(0)).count() == 0
    assert decontaminate.clean(empty, benchmark).count() == 0


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_matches_the_library(spark, path):
    library, rng = Tokenizer.from_file(path), random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "é", "ß", "中", "😀", "'s", "'ll", "12", "½",
             "<|endoftext|>", "<|endof", "|>", "aaaaaaa", "!!!", "́", "\x00", "token="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    texts += ["a" * 5000, " " * 3000, "", "x1" * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i]["ids"] == ids
        assert got[i]["text"] == library.decode(ids, skip_special_tokens=False) == text


def test_bpe_edges(spark, edge, empty, path, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    done = bpe.decode(bpe.encode(edge, path), path)
    texts = {(r["doc_id"], r["text"] or "") for r in edge.collect()}
    assert {(r["doc_id"], r["text"]) for r in done.collect()} == texts and done.count() == 8
    assert bpe.encode(empty, path).count() == 0
