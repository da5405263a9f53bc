"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs become the set of their words and word pairs that stand in a template;
multinomial logistic regression over them tells the licence families and a class
for everything else. Paragraphs of equal sets are one training row with their
count, so the model and its mark come from every paragraph of the table. What the
model calls a licence is held against the family's templates: enough of a
template's five-word shingles must stand in the paragraph. Everything is a column
expression or a Spark ML model.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.session import stage

# The notices by which well-known licences are named and applied.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
    ],
    "cc-by-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0 as stated.",
    ],
    "cc-by-nc-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "proprietary": [
        "All rights reserved. No part of this work may be reproduced without written permission of the publisher.",
    ],
}
UNKNOWN = "unknown"
SHINGLE = 5
NEAR = 0.8


def words(paragraph: Column) -> Column:
    """Lower-case words; signs that join words stay inside them."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"), F.lit(0))


def grams(found: Column, size: int) -> Column:
    """Runs of ``size`` words, joined by blanks; the whole where there are fewer."""
    count = F.greatest(F.size(found) - (size - 1), F.lit(1))
    return F.when(F.size(found) == 0, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(found, k, size), " ")))


def _plain(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", text.lower())


def _examples(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    """Templates, whole and with a part missing at either end: notices are often cut or run on."""
    rows = []
    for family, texts in templates.items():
        for text in texts:
            found = text.split()
            for k in range(max(1, len(found) // 5)):
                rows += [(" ".join(found[k:]), family), (" ".join(found[: len(found) - k]), family)]
    return spark.createDataFrame(rows, "paragraph string, family string")


class Scanner:
    """A fitted classifier with its families, its calibration and its templates."""

    def __init__(
        self, model: PipelineModel, families: list[str], doubt: float, templates: dict[str, list[str]],
        trained: int = 0, marked: int = 0,
    ):
        self.model, self.families, self.doubt, self.templates = model, families, doubt, templates
        self.trained, self.marked = trained, marked  # background paragraphs behind the model and behind the mark

    def confirmed(self, found: Column, family: Column) -> Column:
        """The largest share of a template's shingles in the paragraph, over the family's templates."""
        out = F.lit(0.0)
        for name, texts in self.templates.items():
            best = F.lit(0.0)
            for text in texts:
                mine = _plain(text)
                shingles = sorted({" ".join(mine[k : k + SHINGLE]) for k in range(max(1, len(mine) - SHINGLE + 1))})
                if len(mine) >= SHINGLE:
                    share = F.size(F.array_intersect(grams(found, SHINGLE), F.array(*map(F.lit, shingles)))) / len(shingles)
                else:  # a template too short for a shingle must be there as it is
                    share = F.contains(F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" ")),
                                       F.lit(f" {shingles[0]} ")).cast("double")
                best = F.greatest(best, share)
            out = F.when(family == name, best).otherwise(out)
        return out

    def paragraphs(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``row, id, number, paragraph, family, score, similarity`` for every paragraph of every text."""
        rows = docs.select(F.col(doc_id).alias("id"), F.split(F.coalesce(F.col(text), F.lit("")), r"\n").alias("all"))
        rows = rows.withColumn("row", F.monotonically_increasing_id())  # before the paragraphs part
        rows = rows.select("row", "id", F.posexplode("all").alias("number", "paragraph"))
        scored = self.model.transform(_features(rows, self.templates)).withColumn("chances", vector_to_array("probability"))
        names = F.array(*map(F.lit, self.families))
        likely = F.get(names, F.array_position("chances", F.array_max("chances")).cast("int") - 1)
        scored = scored.withColumns({"score": F.array_max("chances"), "likely": likely})
        # below the calibrated mark the paragraph is not taken for a licence
        sure = F.when((F.col("score") >= self.doubt) & (F.size("words") > 0), F.col("likely")).otherwise(F.lit(UNKNOWN))
        scored = scored.withColumn("likely", sure)
        similarity = F.when(F.col("likely") != UNKNOWN, self.confirmed(F.col("words"), F.col("likely"))).otherwise(0.0)
        scored = scored.withColumn("similarity", similarity)
        family = F.when((F.col("likely") != UNKNOWN) & (F.col("similarity") >= NEAR), F.col("likely"))
        return scored.select("row", "id", "number", "paragraph", "likely", family.alias("family"), "score", "similarity")

    def scan(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per document: ``id, n_paragraphs, n_licences, n_unconfirmed, licences, score``.

        ``licences`` are the confirmed families, distinct and sorted, ``score``
        the model's highest chance of a confirmed one (0 without). A NULL or
        empty text is one empty paragraph, which is unknown. Rows that repeat
        an id stay apart; an empty table gives an empty one; other columns are
        not looked at.
        """
        found = self.paragraphs(docs, doc_id, text)
        out = found.groupBy("row", "id").agg(
            F.count(F.lit(1)).alias("n_paragraphs"), F.count("family").alias("n_licences"),
            F.count_if((F.col("likely") != UNKNOWN) & F.col("family").isNull()).alias("n_unconfirmed"),
            F.array_sort(F.collect_set("family")).alias("licences"),
            F.coalesce(F.max(F.when(F.col("family").isNotNull(), F.col("score"))), F.lit(0.0)).alias("score"))
        return out.drop("row")


def _features(rows: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """The ``words`` of each paragraph, and as ``grams`` those words and word pairs that stand in a template, each once."""
    plain = [_plain(text) for texts in templates.values() for text in texts]
    single = sorted({word for text in plain for word in text})
    double = sorted({" ".join(pair) for text in plain for pair in zip(text, text[1:], strict=False)})
    rows = rows.withColumn("words", words(F.col("paragraph")))
    rows = rows.withColumn("known", F.transform("words", lambda w: F.when(w.isin(single), w)))
    last = F.greatest(F.size("known") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("known", F.lit(1), last), F.slice("known", F.lit(2), last),
                       lambda a, b: F.concat(a, F.lit(" "), b))  # NULL where either is no template's word
    found = F.concat(F.array_compact("known"), F.filter(pairs, lambda pair: pair.isin(double)))
    return rows.withColumn("grams", F.array_sort(F.array_distinct(found))).drop("known")


def fit(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int | None = None, buckets: int = 1 << 14,
    strict: float = 0.999, templates: dict[str, list[str]] | None = None, balance: float = 16.0,
) -> Scanner:
    """Train on the templates and on the background: all paragraphs, or ``sample`` of them chosen by hash.

    Paragraphs that hold a template's first shingle are no background. A third
    of the background is kept from training; the mark above which a licence is
    believed lies so that the share ``strict`` of it stays unknown. The rest
    together weighs ``balance`` times as much as the templates, however large.
    """
    spark, templates = docs.sparkSession, templates or TEMPLATES
    spread = F.pmod(F.xxhash64(doc_id, F.length(text)), F.lit(1 << 30))
    rows = docs.filter(F.col(text).isNotNull()).select(spread.alias("rank"), F.col(text).alias("text"))
    rows = _features(rows.select("rank", F.explode(F.split("text", r"\n")).alias("paragraph")), templates)
    starts = sorted({" ".join(_plain(t)[:SHINGLE]) for ts in templates.values() for t in ts})
    line = F.array(F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))  # bound as a lambda variable: joined once
    named = F.exists(line, lambda x: reduce(Column.__or__, [F.contains(x, F.lit(f" {start} ")) for start in starts]))
    near = rows.select("paragraph", F.xxhash64("paragraph", "rank").alias("rank"), "grams",
                       ((F.size("words") > 0) & ~named).alias("used"))
    if sample is not None:
        near = near.filter("used").orderBy("rank", "paragraph").limit(sample)
    # counted under a condition: a filter would be moved below the words and have them found twice
    kept = F.pmod("rank", F.lit(3)) == 0
    background = stage(near.groupBy("grams").agg(
        F.count_if(F.col("used") & ~kept).alias("trained"), F.count_if(F.col("used") & kept).alias("marked")))
    trained, marked = background.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("trained", "marked")]).first()
    families = [UNKNOWN, *sorted(templates)]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    examples = _features(_examples(spark, templates), templates).select("grams", label.alias("label"), F.lit(1.0).alias("weight"))
    weight = F.col("trained") * (balance * examples.count() / max(1, trained))
    training = examples.unionByName(background.filter(F.col("trained") > 0).select(
        "grams", F.lit(0.0).alias("label"), weight.alias("weight")))
    model = Pipeline(stages=[
        HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True),
        LogisticRegression(family="multinomial", regParam=0.001, maxIter=30, weightCol="weight")]).fit(training)
    # without background of its own, the unknown class is only ever met by its bias
    chances = model.transform(background.filter(F.col("marked") > 0)).select(vector_to_array("probability").alias("p"), "marked")
    # to four digits, so that the exact percentile counts few values, whatever the table
    licence = F.round(F.array_max(F.slice("p", 2, len(families) - 1)), 4)
    mark = chances.agg(F.percentile(licence, F.lit(strict), F.col("marked"))).first()[0] if len(families) > 1 else None
    return Scanner(model, families[: model.stages[-1].numClasses], max(0.5, mark or 0.0), templates, trained, marked)
