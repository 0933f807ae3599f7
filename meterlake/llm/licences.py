"""Licence scan: a trained paragraph classifier. DataFrame and ML functions
only, no Python on the executors.

Paragraphs are runs of lines up to a blank line (one without any word). Scored
are each line, as a notice may stand in one line of a longer paragraph, and
each paragraph of several lines as a whole, as notices are often hard-wrapped.
A whole paragraph's row is left out where one of its own lines has a row of the
same family that is confirmed, or as unconfirmed as the paragraph's. Its
``para_no`` is that of its first line, and its text keeps the line breaks.

Features are all word unigrams and bigrams (present or not) of the notice
templates. A multinomial logistic regression (Spark ML) on this sparse
vocabulary tells licence families apart, with ``unknown`` as one more class.

Every line and paragraph is scored, whatever its words: also one that shares
only common words with the templates, which no template can confirm, is named
when the classifier gives it to a family.

Training rows: each notice template of a family, whole and with words missing
at its ends, bare and inside of a corpus paragraph; and corpus paragraphs as
``unknown``, from a bounded sample (``background`` paragraphs of the
``sample_docs`` distinct texts with the smallest hash) without those that look
like a template. A third of the variants and of the background is held out and decides
the threshold of a family's probability: of those from ``floor`` on that at most
one in a thousand of the held-out background reaches, the one with the fewest
held-out errors (notices missed or given to another family, background given
to one), in the middle of its range (see ``calibrate``). Both error rates are part
of the model.

Confirmation: the paragraph holds at least ``overlap`` of the word bigrams of
one template of the predicted family, and all of that template's words with a
digit, so a notice of another version is not confirmed. Results carry both:
what the classifier names, and whether a template confirms it. The opening
sentence that BSD notices share is a family without a number of clauses.

Defined results: null and blank texts have no paragraph. Repeated rows and
null ids give their own results. If no document has a paragraph, the
classifier is trained on the templates alone. Empty input gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.scratch import checkpoint_dir

COMMON = 0.01
SAMPLE_DOCS = 400
BACKGROUND = 3000
FLOOR = 0.5
OVERLAP = 0.6
UNKNOWN = "unknown"

# FIXED VALUES: notices of licence families, as their texts recommend them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without permission."),
]
# families whose name is their SPDX identifier, and those with two of them
TEMPLATES += [
    (family, f"SPDX-License-Identifier: {family}{variant}")
    for family in sorted({f for f, _ in TEMPLATES} - {"BSD", "Proprietary"})
    for variant in (("-only", "-or-later") if "GPL" in family else ("",))
]
FALSE_SHARE = 0.001


def words(text: Column) -> Column:
    """Lower-cased words; version numbers and hyphenated names stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"), F.lit(0))


def bigrams(w: Column) -> Column:
    return F.when(F.size(w) < 2, w).otherwise(
        F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    )


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, block, para_no, whole, paragraph): the lines with a
    word, numbered from 0, and each run of several such lines as a whole, with
    the number of its first line; ``block`` is that number for its lines too."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # each line with its number before it; runs of lines end at an empty one
    numbered = F.transform(F.split(text, "\n"), lambda x, i: F.when(x.rlike(r"[\p{L}\p{N}]"), F.concat_ws("\t", i, x)).otherwise(F.lit("")))
    runs = F.split(F.btrim(F.array_join(numbered, "\n"), F.lit("\n")), "\n\n+")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.explode(runs).alias("_run"))
    rows = rows.where(F.col("_run") != "").withColumn("_lines", F.transform(F.split("_run", "\n"), lambda x: F.split(x, "\t", 2)))
    block = F.col("_lines")[0][0].cast("int")

    def unit(no: Column, whole: bool, paragraph: Column) -> Column:
        return F.struct(no.alias("para_no"), F.lit(whole).alias("whole"), paragraph.alias("paragraph"))

    single = F.transform("_lines", lambda x: unit(x[0].cast("int"), False, x[1]))
    joined = unit(block, True, F.array_join(F.transform("_lines", lambda x: x[1]), "\n"))
    units = F.when(F.size("_lines") > 1, F.concat(single, F.array(joined))).otherwise(single)
    return rows.select("doc_id", "text_hash", block.alias("block"), F.inline(units))


def _with_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("words", words(F.col("paragraph")))


def _with_features(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    # runs of words of the vocabulary: no gram over another word is in it
    known = [w for w in vocabulary if " " not in w]
    marked = F.array_join(F.transform("words", lambda w: F.when(w.isin(known), w).otherwise(F.lit(""))), " ")
    runs = F.transform(F.split(marked, "  +"), lambda run: F.split(F.btrim(run), " "))
    rows = rows.withColumn("_runs", runs)
    rows = rows.withColumn("grams", F.flatten(F.transform("_runs", lambda run: F.concat(run, bigrams(run))))).drop("_runs")
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    return counted.setBinary(True).transform(rows)


def templates(spark: SparkSession) -> DataFrame:
    """(family, paragraph, template, numbers) of the fixed notices: their bigrams
    and their words with a digit."""
    rows = spark.createDataFrame(TEMPLATES, "family string, paragraph string")
    found = words(F.col("paragraph"))
    return rows.select(
        "family",
        "paragraph",
        F.array_distinct(bigrams(found)).alias("template"),
        F.array_distinct(F.filter(found, lambda w: w.rlike("[0-9]"))).alias("numbers"),
    )


@dataclass(frozen=True)
class LicenceModel:
    model: LogisticRegressionModel
    families: list[str]
    vocabulary: list[str]
    threshold: float
    docs: DataFrame  # the corpus trained on
    missed: float = 0.0  # share of the held-out notices missed or given to another family
    false: float = 0.0  # share of the held-out background given to a family

    @cached_property
    def shares(self) -> dict[str, float]:
        """Of the corpus's lines that hold a template word, counted over all of
        them when first asked for; scoring does not need it."""
        return _shares(self.docs, self.vocabulary)


def _background(docs: DataFrame, known: list[list[str]], sample_docs: int, limit: int) -> DataFrame:
    """Corpus paragraphs that hold less than half of any template."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("_hash", F.xxhash64("text"))
    few = F.broadcast(rows.select("_hash").distinct().orderBy("_hash").limit(sample_docs))  # at most sample_docs rows
    rows = rows.join(few, "_hash", "left_semi")
    lines = paragraphs(rows.select("doc_id", "text")).select("paragraph").distinct()
    lines = lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(limit)
    lines = lines.withColumn("own", F.array_distinct(bigrams(words(F.col("paragraph")))))
    # a fixed list of templates against a bounded sample
    alike = F.lit(False)
    for t in known:
        alike = alike | (F.size(F.array_intersect("own", F.array(*[F.lit(g) for g in t]))) >= 0.5 * len(t))
    return lines.where(~alike).select(F.lit(UNKNOWN).alias("family"), "paragraph")


def _vocabulary(known: DataFrame) -> list[str]:
    """Unigrams and bigrams of the templates, a short fixed list."""
    grams = _with_words(known).select(F.explode(F.concat("words", bigrams(F.col("words")))).alias("g")).distinct()
    return sorted(r["g"] for r in grams.collect())


def _shares(docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """The share of all lines that hold each word of the templates."""
    rows = _with_words(paragraphs(docs).where(~F.col("whole")))
    known = [w for w in vocabulary if " " not in w]
    held = F.array_distinct(F.filter("words", lambda w: w.isin(known)))
    # the empty word stands for the line itself; as many groups as words
    counted = rows.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in counted.collect()}
    return {w: counts.get(w, 0) / max(counts.get("", 0), 1) for w in known}


def gate_words(shares: dict[str, float], common: float, overlap: float) -> list[str]:
    """The words of at most ``common`` of the lines and, of each template, the
    rarest until less than ``overlap`` of its bigrams are without one: a
    paragraph that can be confirmed holds one of them. No step of the scan
    leaves rows out by them."""
    gate = {w for w, share in shares.items() if share <= common}
    for _, notice in TEMPLATES:
        w = re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", notice.lower())
        pairs = set(zip(w, w[1:], strict=False))
        for word in sorted(set(w), key=lambda x: (shares[x], x)):
            if sum(gate.isdisjoint(p) for p in pairs) < overlap * len(pairs) - 1e-9:
                break
            gate.add(word)
    return sorted(gate)


def train(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, background: int = BACKGROUND, floor: float = FLOOR
) -> LicenceModel:
    """``docs``: doc_id, text."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    known = templates(spark)
    plain = _background(docs, [r["template"] for r in known.collect()], sample_docs, background)
    plain = plain.coalesce(2).checkpoint()  # a bounded sample
    vocabulary = _vocabulary(known)
    # every stretch of a notice that leaves out at most a third of its words
    w = F.split("paragraph", " ")
    cut = known.select("family", w.alias("w"), F.size(w).alias("n"))
    for name in ("skip", "drop"):
        cut = cut.withColumn(name, F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / 6).cast("int"))))
    left = F.greatest(F.col("n") - F.col("skip") - F.col("drop"), F.lit(1))
    cut = cut.select("family", F.array_join(F.slice("w", F.col("skip") + 1, left), " ").alias("paragraph"))
    # bare, and between the words of corpus paragraphs, dealt by hash
    fill = [r["paragraph"] for r in plain.orderBy(F.xxhash64("paragraph"), "paragraph").limit(40).collect()]
    around = F.array(*[F.lit(" ".join(p.split()[:12])) for p in fill]) if fill else F.array(F.lit(""))
    pick = F.element_at(around, (F.pmod(F.xxhash64("paragraph"), F.size(around)) + 1).cast("int"))
    mixed = cut.unionByName(cut.select("family", F.concat_ws(" ", pick, "paragraph", pick).alias("paragraph")))
    whole = mixed.distinct().unionByName(plain)
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    bare = F.col("paragraph").isin([t for _, t in TEMPLATES])
    held_out = (F.pmod(F.xxhash64(F.lit("held out"), "paragraph"), F.lit(3)) == 0) & ~bare
    rows = _with_words(whole.withColumn("label", label.cast("double")).withColumn("held_out", held_out))
    # an empty paragraph stands for all without a feature
    rows = rows.unionByName(spark.createDataFrame([(UNKNOWN, "", 0.0, True, [])], rows.schema))
    rows = _with_features(rows, vocabulary).select("label", "held_out", "features").coalesce(2).checkpoint()
    model = LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial").fit(rows.where(~F.col("held_out")))
    p = vector_to_array("probability")
    best = F.array_max(F.slice(p, 2, len(families)))
    right = F.element_at(p, F.col("label").cast("int") + 1) >= best
    blank = F.size(F.array_remove(vector_to_array("features"), 0.0)) == 0
    unseen = model.transform(rows.where("held_out")).select(best.alias("p"), (F.col("label") == 0).alias("unknown"), right.alias("right"), blank.alias("blank"))
    seen = unseen.collect()  # a third of a bounded sample, four numbers a row
    notices = [(r["p"], r["right"]) for r in seen if not r["unknown"] and not r["blank"]]
    nothing = max(r["p"] for r in seen if r["unknown"] and r["blank"])
    threshold, missed, false = calibrate(notices, [r["p"] for r in seen if r["unknown"]], max(floor, nothing + 1e-6))
    return LicenceModel(model, families, vocabulary, threshold, docs, missed, false)


def calibrate(notices: list[tuple[float, bool]], background: list[float], floor: float) -> tuple[float, float, float]:
    """(threshold, share of notices missed, share of background named) from the
    held-out rows: ``notices`` are (highest probability of a family, whether it
    is the notice's own). Thresholds that more than ``FALSE_SHARE`` of the
    background reaches are out, unless all are. Of equally good ones
    the middle of the widest range is taken, so it is as far from both kinds as
    they allow."""
    cuts = sorted({floor, *[p for p, _ in notices if p > floor], *[p for p in background if p > floor], 1.0})
    own, other = sorted(p for p, right in notices if right), sorted(background)
    ranges = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        middle = (low + high) / 2
        missed = 1 - (len(own) - bisect_left(own, middle)) / len(notices) if notices else 0.0
        false = (len(other) - bisect_left(other, middle)) / len(other) if other else 0.0
        ranges.append((false > FALSE_SHARE, round(missed + false, 9), low - high, middle, missed, false))
    return min(ranges)[3:] if ranges else (floor, 0.0, 0.0)


def scan(docs: DataFrame, model: LicenceModel, overlap: float = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line or paragraph that the classifier gives to a family:
    doc_id, para_no, family, probability, similarity, confirmed, paragraph."""
    rows = _with_words(paragraphs(docs, id_col, text_col))
    rows = _with_features(rows, model.vocabulary).drop("grams")
    scored = model.model.transform(rows).withColumn("p", vector_to_array("probability"))
    best = F.array_max(F.slice("p", 2, len(model.families)))
    scored = scored.withColumn("probability", best).where(F.col("probability") >= model.threshold)
    names = F.array(*[F.lit(f) for f in model.families])
    at = F.array_position(F.slice("p", 2, len(model.families)), F.col("probability")) + 1
    found = scored.select(
        "doc_id", "text_hash", "block", "para_no", "whole", "paragraph", "probability",
        F.element_at(names, at.cast("int")).alias("family"),
        F.array_distinct(bigrams(F.col("words"))).alias("own"),
        "words",
    )
    # a fixed list of notices, a few dozen rows
    known = templates(docs.sparkSession).groupBy("family").agg(F.collect_list(F.struct("template", "numbers")).alias("known"))
    shared = F.transform("known", lambda t: F.size(F.array_intersect("own", t["template"])) / F.size(t["template"]))
    named = found.join(F.broadcast(known), "family").withColumn("similarity", F.array_max(shared))
    numbered = F.filter("known", lambda t: F.size(F.array_except(t["numbers"], "words")) == 0)
    enough = F.exists(numbered, lambda t: F.size(F.array_intersect("own", t["template"])) >= overlap * F.size(t["template"]) - 1e-9)
    named = named.withColumn("confirmed", enough)
    # a text's rows come from one task; equal texts have equal rows, so they may meet or not
    named = named.withColumn("_task", F.spark_partition_id())
    of_paragraph = Window.partitionBy("_task", "doc_id", "text_hash", "block", "family")
    in_lines = F.max(F.when(~F.col("whole"), F.col("confirmed").cast("int"))).over(of_paragraph)
    named = named.withColumn("_in_lines", F.coalesce(in_lines, F.lit(-1)))
    named = named.where(~F.col("whole") | (F.col("_in_lines") < F.col("confirmed").cast("int")))
    return named.select("doc_id", "para_no", "family", "probability", "similarity", "confirmed", "paragraph")
