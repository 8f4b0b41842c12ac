"""License scans: a trained paragraph classifier names the licence family.

Method: multinomial logistic regression over sparse word n-grams (``pyspark.ml``) learns
families from notices, ``none`` from a bounded sample of the corpus and ``unknown`` from notices
of licences that do not exist. Its weights become a small table that paragraphs' n-grams
join. Everything is DataFrame operations; no Python runs on executors.

The probability is calibrated on wording the model has not seen: whole notices, licence names and
invented names are held out in turn, and a logistic curve is fitted to how often a family named
for them is right. A prediction below the probability at which naming pays, or that no template
of its family confirms, is ``unknown``.

A paragraph is a line of the text. A family can only win where an n-gram with a weight in its
favour occurs, so paragraphs without the words of such n-grams are ``none`` and not scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.joins import salted_join
from sparkmart.session import materialise, workspace

SAMPLE_DOCUMENTS = 400
VOCABULARY = 4000
CONFIRM = 0.6
FOLDS = 3
#: Documents with the same line that a single task may be given.
ROWS_PER_TASK = 1_000_000
#: A wrong name is as bad as so many licences left unknown.
WRONG_NAME_COST = 5
NONE, UNKNOWN = "none", "unknown"

#: Sentences of each family's notices.
SENTENCES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ],
    "apache-2.0": [
        "you may not use this file except in compliance with the License. You may obtain a copy"
        " of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this"
        " program.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms"
        " of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this"
        " library.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [],
    "cc-by-nc": [],
    "public-domain": [
        "This work is dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "The person who associated a work with this deed has dedicated the work to the public"
        " domain by waiving all rights to the work worldwide under copyright law",
    ],
    "proprietary": [
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary"
        " and confidential.",
        "No part of this work may be reproduced without the prior written permission of the"
        " copyright holder. All rights reserved.",
        "This document contains confidential and proprietary information. All rights reserved.",
    ],
}
#: Names and short names of each family's licences.
NAMES = {
    "mit": ["MIT License", "MIT Licence", "Expat License", "MIT/X11 License"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0"],
    "gpl": [
        "GNU General Public License, version 3",
        "GNU General Public License v2",
        "GNU GPL",
        "GPLv3",
        "GPL v2",
    ],
    "lgpl": [
        "GNU Lesser General Public License, version 2.1",
        "GNU Lesser General Public License v3",
        "GNU LGPL",
        "LGPLv3",
    ],
    "bsd": ["BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "BSD License"],
    "mpl": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"],
    "cc-by": [
        "CC BY 4.0",
        "CC BY 3.0",
        "Creative Commons Attribution 4.0 International License",
        "Creative Commons Attribution License",
    ],
    "cc-by-nc": [
        "CC BY-NC 4.0",
        "CC BY-NC 3.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
        "Creative Commons Attribution-NonCommercial License",
    ],
    "public-domain": ["CC0 1.0 Universal", "CC0 1.0", "The Unlicense"],
    "proprietary": [],
}
#: Identifiers of each family's licences.
IDENTIFIERS = {
    "mit": ["MIT"],
    "apache-2.0": ["Apache-2.0"],
    "gpl": ["GPL-2.0-only", "GPL-3.0-or-later"],
    "lgpl": ["LGPL-2.1-only", "LGPL-3.0-or-later"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "mpl": ["MPL-2.0"],
    "cc-by": ["CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "public-domain": ["CC0-1.0", "Unlicense"],
    "proprietary": [],
}
#: First words and kinds of licences that do not exist.
INVENTED_WORDS = (
    "Brandnew", "Acme Sharing", "Open Harbour", "Lighthouse", "Cooperative", "Meadow", "Northern",
    "Free Orchard", "Riverside", "Granite", "Blue Lantern", "Weaver", "Summit", "Old Mill",
    "Clearwater", "Fair Share", "Pinewood", "Copper", "Garden", "Sparrow", "Eastgate", "Data Commons",
    "Compass", "Willow",
)
INVENTED_KINDS = (
    "License", "License, Version {}.0", "Public License, version {}", "Agreement", "Licence {}.1",
    "General License v{}", "Terms of Use, version {}", "Community Charter",
)
#: Sentences with words of notices that name no licence.
NEAR_MISSES = (
    "Nobody may drive a car on a public road without a license.",
    "The fishing licence expired in May and was not renewed.",
    "All visitors have the same rights and duties in this house.",
    "The terms were agreed after long talks between both sides.",
    "Permission to build was refused by the council.",
    "The software was free to try and easy to use.",
    "Under these conditions the bridge could not be opened to the public.",
    "The source of the river lies in the north of the domain.",
    "A new version of the story was published in the journal.",
    "The copyright of the song was disputed for years.",
    "The bar lost its license and closed its doors.",
    "Their work is distributed over many rooms and reserved for members.",
)
INVENTED_IDENTIFIERS = ("Harbour-1.1", "Orchard-4.0-only", "Meadow-3.1")
#: How names are put into sentences, and how notices are framed.
SAYINGS = (
    "Released under the {}.",
    "Licensed under {}.",
    "License: {}",
    "This work is licensed under the terms of the {}.",
)
FRAMES = (
    "{}",
    "Copyright (c) 2021 The Authors. {}",
    "# {}",
    "Note: {} See the file LICENSE for details.",
    "The code of this project is as follows. {}",
    "{} Please read it with care.",
)
SPDX = "SPDX-License-Identifier: {}"
#: What confirms a family: its sentences, names and identifiers.
TEMPLATES = {
    family: [*sentences, *NAMES[family], *map(SPDX.format, IDENTIFIERS[family])]
    for family, sentences in SENTENCES.items()
}


def wordings() -> list[tuple[str, int, str]]:
    """Family (or ``unknown``), number of the notice in it, and the notice in each saying.

    All sayings of one licence name are one notice, so a held-out name is held out in all.
    """
    named = [(f, SENTENCES[f], NAMES[f], IDENTIFIERS[f]) for f in SENTENCES]
    kinds = len(INVENTED_KINDS)
    invented = [
        f"{word} {INVENTED_KINDS[(i + k) % kinds].format(i % 9 + 1)}"
        for i, word in enumerate(INVENTED_WORDS)
        for k in (0, 3)
    ]
    out = []
    for family, sentences, names, ids in [*named, (UNKNOWN, [], invented, INVENTED_IDENTIFIERS)]:
        notices = [*([s] for s in sentences), *([s.format(n) for s in SAYINGS] for n in names)]
        notices += [[SPDX.format(i)] for i in ids]
        out += [(family, i, text) for i, notice in enumerate(notices) for text in notice]
    return out


def words(text: Column) -> Column:
    """Lower-case words; digits, dots and dashes inside a word stay."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def ngrams(tokens: Column) -> Column:
    """Distinct words and pairs of neighbours."""
    n = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(F.concat(tokens, pairs))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and each non-blank line as ``paragraph``."""
    lines = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    out = docs.select(F.col("doc_id").cast("long"), lines.alias("paragraph"))
    return out.where(F.trim("paragraph") != "")


@dataclass
class Model:
    """Weights by n-gram (one column per class), intercepts, and the least probability.

    ``slope`` and ``shift`` turn the log odds of the likeliest class into calibrated ones.
    """

    classes: list[str]
    weights: list[tuple]
    intercepts: list[float]
    threshold: float = 0.0
    anchors: list[str] | None = None
    slope: float = 1.0
    shift: float = 0.0


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(k, t) for k, notices in TEMPLATES.items() for t in notices]
    return spark.createDataFrame(rows, "family string, template string")


def _likeness(left: Column, right: Column) -> Column:
    """The larger share of common n-grams: of the template, or of the paragraph."""
    common = F.size(F.array_intersect(left, right))
    short = F.least(F.size(left), F.size(right))
    return F.when((short >= 5) & (common >= 4), common / short).otherwise(
        F.when(short > 0, F.floor(common / F.size(right))).otherwise(0.0)
    )


def _sample(docs: DataFrame, most: int) -> DataFrame:
    """The ``most`` different rows (doc_id, text) with the smallest hash, null texts aside.

    Hashes below a bound are looked at first, about four times as many as are wanted, and no
    text is moved before the rows are chosen. Only those numbers reach the driver.
    """
    place = F.xxhash64(F.col("doc_id").cast("long"), "text")
    rows = docs.where("text is not null").select("doc_id", "text", place.alias("_place"))
    share = min(1.0, 4 * most / max(1, docs.count()))
    while True:
        bound = F.lit(int(share * (1 << 64)) - (1 << 63) - (share == 1.0))
        low = rows.where(F.col("_place") <= bound).select("_place").distinct()
        chosen = [r[0] for r in low.orderBy("_place").limit(most).collect()]
        if len(chosen) == most or share == 1.0:
            break
        share = min(1.0, 8 * share)
    return rows.where(F.col("_place").isin(chosen)).dropDuplicates(["_place"]).drop("_place")


def training_rows(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``label``, ``paragraph``, ``fold`` and ``grams`` of framed notices and of corpus lines."""
    spark = docs.sparkSession
    rows = [
        (family, frame.format(notice), i % FOLDS)
        for family, i, notice in wordings()
        for frame in FRAMES
    ] + [(NONE, text, i % FOLDS) for i, text in enumerate(NEAR_MISSES)]
    known = spark.createDataFrame(rows, "label string, paragraph string, fold int")
    plain = paragraphs(_sample(docs, sample_documents)).select("paragraph").distinct()
    plain = plain.withColumn("own", ngrams(words(F.col("paragraph"))))
    notices = _templates(spark).select(ngrams(words(F.col("template"))).alias("grams"))
    notices = notices.agg(F.collect_list("grams").alias("all"))
    marked = plain.crossJoin(F.broadcast(notices)).where(
        ~F.exists("all", lambda grams: _likeness(F.col("own"), grams) >= CONFIRM)
    )
    fold = F.pmod(F.xxhash64("paragraph"), F.lit(FOLDS)).cast("int")
    negative = marked.select(F.lit(NONE).alias("label"), "paragraph", fold.alias("fold"))
    rows = known.unionAll(negative).withColumn("grams", ngrams(words(F.col("paragraph"))))
    return materialise(rows, f"{workspace(spark, 'licences')}/training")


def fit(rows: DataFrame) -> Model:
    """The classifier of the given training rows, without calibration."""
    classes = [*TEMPLATES, UNKNOWN, NONE]
    # a corpus line without a known n-gram says nothing but how common such lines are
    counter = CountVectorizer(
        inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True
    ).fit(rows.where(F.col("label") != NONE))
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1
    regression = LogisticRegression(
        labelCol="y", featuresCol="features", regParam=0.0005, elasticNetParam=0.1, maxIter=40,
        family="multinomial",
    )
    data = counter.transform(rows).withColumn("y", index.cast("double"))
    fitted = regression.fit(data.coalesce(4))
    matrix = fitted.coefficientMatrix.toArray()
    weights = [
        (gram, *map(float, matrix[:, i]))
        for i, gram in enumerate(counter.vocabulary)
        if matrix[:, i].any()
    ]
    # classes up to the last one that occurs
    return Model(classes[: matrix.shape[0]], weights, [float(x) for x in fitted.interceptVector])


def held_out(rows: DataFrame) -> DataFrame:
    """``label``, ``paragraph``, ``family`` and ``probability`` of every training row that has a
    known n-gram, by a model of the other folds, to which its notice or name is new."""
    spark = rows.sparkSession
    parts = []
    for fold in range(FOLDS):
        own = rows.where(F.col("fold") == fold).select("label", "paragraph").distinct()
        model = fit(rows.where(F.col("fold") != fold))
        parts.append(score(own.select("paragraph").distinct(), model).join(own, "paragraph"))
    scored = reduce(DataFrame.unionAll, parts)
    return materialise(scored, f"{workspace(spark, 'licences')}/heldout")


def _log_odds(probability: str) -> Column:
    p = F.least(F.greatest(F.col(probability), F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def calibration(scored: DataFrame) -> tuple[float, float]:
    """Slope and shift of the logistic curve from log odds to the share of right classes.

    Taken over all notices, real and invented. Each row counts for both outcomes, the one it shows with the weight (n + 1) / (n + 2) of n
    such rows, so a clean separation gives no infinite slope.
    """
    named = scored.where(F.col("label") != NONE).select(
        _log_odds("probability").alias("odds"), (F.col("label") == F.col("family")).alias("right")
    )
    right, wrong = named.agg(F.count_if("right"), F.count_if(~F.col("right"))).first()
    if not right + wrong:
        return 1.0, 0.0
    shown = F.when(F.col("right"), (right + 1) / (right + 2)).otherwise(1 / (wrong + 2))
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), shown.alias("w")),
                             F.struct(F.lit(0.0).alias("y"), (1 - shown).alias("w"))))
    data = named.select("odds", both.alias("b")).select("odds", "b.y", "b.w")
    data = VectorAssembler(inputCols=["odds"], outputCol="features").transform(data)
    curve = LogisticRegression(labelCol="y", weightCol="w").fit(data.coalesce(4))
    return max(0.0, float(curve.coefficients[0])), float(curve.intercept)


def without_doubtful(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """Training rows but for corpus lines that a model of the other folds takes for a licence.

    The corpus is not labelled: its lines may name licences no template knows.
    """
    doubtful = scored.where(
        (F.col("label") == NONE) & (F.col("family") != NONE) & ~F.col("paragraph").isin(*NEAR_MISSES)
    ).select("label", "paragraph")
    return rows.join(F.broadcast(doubtful), ["label", "paragraph"], "left_anti")


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit on the notices and on the lines of at most ``sample_documents`` documents.

    The rows with the smallest hash are taken, so any table gives the same sample wherever its
    rows lie. The probability is calibrated on held-out notices and names, and the threshold is
    where a name is as likely to pay as not. An empty table gives a model whose only plain lines
    are ``NEAR_MISSES``.
    """
    rows = training_rows(docs, sample_documents)
    scored = held_out(rows)
    model = fit(without_doubtful(rows, scored))
    model.slope, model.shift = calibration(scored)
    model.threshold = WRONG_NAME_COST / (WRONG_NAME_COST + 1)
    tokens = rows.where(F.col("label") == NONE).select(F.explode("grams").alias("gram"))
    counts = tokens.where(F.col("gram").isin(*{w for g, *_ in model.weights for w in g.split()}))
    model.anchors = _anchors(model, dict(map(tuple, counts.groupBy("gram").count().collect())))
    return model


def _anchors(model: Model, common: dict[str, int]) -> list[str]:
    """Words one of which every paragraph has that anything but ``none`` can win.

    N-grams without such a word are left out as long as all of them together could not lift
    any class above ``none``; the words most common in plain lines are tried first.
    """
    known = sorted({w for gram, *_ in model.weights for w in gram.split()})
    if NONE not in model.classes:
        return known
    at = model.classes.index(NONE)
    lead = [model.intercepts[at] - x for i, x in enumerate(model.intercepts) if i != at]
    gains = {
        gram: [max(w - own[at], 0.0) for i, w in enumerate(own) if i != at]
        for gram, *own in model.weights
    }
    holders: dict[str, list[str]] = {}
    for gram in gains:
        for word in set(gram.split()):
            holders.setdefault(word, []).append(gram)
    anchors, total = set(known), [0.0] * len(lead)
    for word in sorted(known, key=lambda w: (-common.get(w, 0), w)):
        rest = anchors - {word}
        freed = [gram for gram in holders[word] if not rest & set(gram.split())]
        after = [t + sum(gains[g][i] for g in freed) for i, t in enumerate(total)]
        if all(t < most for t, most in zip(after, lead, strict=True)):
            anchors, total = rest, after
    return sorted(anchors)


def score(texts: DataFrame, model: Model) -> DataFrame:
    """``paragraph``, ``family`` and ``probability`` of distinct paragraphs."""
    spark = texts.sparkSession
    names = [f"w{i}" for i in range(len(model.classes))]
    schema = "gram string, " + ", ".join(f"{n} double" for n in names)
    table = F.broadcast(spark.createDataFrame(model.weights, schema))  # VOCABULARY rows at most
    grams = texts.select("paragraph", F.explode(ngrams(words(F.col("paragraph")))).alias("gram"))
    sums = grams.join(table, "gram").groupBy("paragraph").agg(*[F.sum(n).alias(n) for n in names])
    odds = F.array(*[F.col(n) + F.lit(b) for n, b in zip(names, model.intercepts, strict=True)])
    top = F.array_max("odds")
    rest = F.aggregate("odds", F.lit(-1.0), lambda total, x: total + F.exp(x - top))
    return sums.select("paragraph", odds.alias("odds")).select(
        "paragraph",
        F.get(
            F.array(*[F.lit(c) for c in model.classes]),
            (F.array_position("odds", top) - 1).cast("int"),
        ).alias("family"),
        (
            1 / (1 + F.exp(model.slope * F.log(F.greatest(rest, F.lit(1e-12))) - model.shift))
        ).alias("probability"),
    )


def scan(docs: DataFrame, model: Model | None = None, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id``, ``family``, ``n_paragraphs`` and ``probability`` per document with a licence.

    One row per document and family, ``unknown`` included; ``probability`` is the largest.
    Null and empty texts have no licence. Repeated rows add to ``n_paragraphs``, rows without
    ``doc_id`` are reported together under null. Other columns are ignored.
    """
    spark = docs.sparkSession
    model = model or train(docs)
    anchors = F.array(*[F.lit(a) for a in model.anchors])
    candidates = paragraphs(docs).where(F.arrays_overlap(words(F.col("paragraph")), anchors))
    candidates = materialise(
        candidates.groupBy("doc_id", "paragraph").agg(F.count("*").alias("times")),
        f"{workspace(spark, 'licences')}/candidates",
    )
    scored = score(candidates.select("paragraph").distinct(), model).where(F.col("family") != NONE)
    templates = _templates(spark).select(
        F.col("family").alias("of"), ngrams(words(F.col("template"))).alias("grams")
    )
    templates = templates.groupBy("of").agg(F.collect_list("grams").alias("templates"))
    likeness = F.aggregate(
        F.coalesce("templates", F.expr("cast(array() as array<array<string>>)")),
        F.lit(0.0),
        lambda most, grams: F.greatest(most, _likeness(F.col("own"), grams)),
    )
    judged = (
        scored.withColumn("own", ngrams(words(F.col("paragraph"))))
        .join(F.broadcast(templates), F.col("family") == F.col("of"), "left")
        .select(
            "paragraph",
            F.when((F.col("probability") >= model.threshold) & (likeness >= confirm), F.col("family"))
            .otherwise(UNKNOWN)
            .alias("family"),
            "probability",
        )
    )
    # A notice may stand in a third of all documents: its line is spread over tasks.
    found = salted_join(
        candidates, judged, ["paragraph"], "inner",
        left_rows=candidates.count(), rows_per_task=ROWS_PER_TASK,
    )
    return (
        found.groupBy("doc_id", "family")
        .agg(F.sum("times").alias("n_paragraphs"), F.max("probability").alias("probability"))
    )
