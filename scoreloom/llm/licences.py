"""Licence notices by a trained paragraph classifier, in DataFrame functions only.

A paragraph is a line, or a run of lines without a blank one between: of every
two lines that a notice may reach from one to the other, the words between them,
so that wrapped notices are whole. Comment marks are no words. Where paragraphs
overlap, the one that a template confirms best counts, of those the shortest.

Features are the word 1- to 3-grams of the templates that
hold a word peculiar to licence texts; a sparse multinomial logistic regression
over them tells the families and "unknown" apart. It learns from every run of
words of the templates that says enough, and against them from the same words in
other orders and from a bounded sample of lines of the corpus. A second, binary
regression over rows kept aside turns the margin over "unknown" into a
probability. A prediction counts once that probability passes one half and a
template of the family confirms it: enough of the template's n-grams stand in
the paragraph.

A paragraph without any of the peculiar words has no feature, so it is unknown
whatever the weights; only the others meet the classifier.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.literals import small_table
from scoreloom.plans.staging import stage

NEGATIVES = 2_000  # lines of the corpus to learn from, those with the least hashes
MIN_PROBABILITY = 0.5
MIN_TEMPLATE_SHARE = 0.6
LEAST_RUN = 0.6  # of a template's words, for a run of it to be learned as its family
LEAST_WORDS = 3  # of such a run
TASK_PARAGRAPHS = 1 << 13  # classified by one task
UNKNOWN = "unknown"

# Notices as their licences word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Public-Domain", "This is free and unencumbered software released into the public domain."),
    ("Public-Domain", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"),
    ("Public-Domain", "For more information, please refer to <https://unlicense.org>"),
    ("Public-Domain", "SPDX-License-Identifier: Unlicense"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    ("Zlib", "Released under the zlib License."),
    ("Zlib", "SPDX-License-Identifier: Zlib"),
    ("Artistic-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0."),
    ("Artistic-2.0", "Licensed under the Artistic License, version 2.0."),
    ("Artistic-2.0", "SPDX-License-Identifier: Artistic-2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt"),
    ("BSL-1.0", "SPDX-License-Identifier: BSL-1.0"),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Proprietary", "This software is confidential and proprietary; no part may be reproduced or distributed without prior written permission."),
]
_COMMON = (
    "a above all along an and any are as associated at author be by can charge code conditions confidential deal copies copy extent file files following for form forms free "
    "general have in included international is it law list may met modify must no not notice obtain obtaining of on or part person portions possible prior "
    "program provided public received related release released section shall should source subject substantial terms that the this to under use version "
    "with without work written www you http list library domain modification compliance except foundation published binary universal identifier "
    "accompanying altered anyone appear arising available being boost commercial compile compiled damages distribute either event express fee for from held hereby "
    "https information legal made marked materials means more non original org plainly please provided publish purpose refer see sell such txt versions was were will"
).split()


def _words(text: str) -> str:
    return f"filter(split(lower({text}), '[^a-z0-9]+'), w -> w <> '')"


def _grams(words: str, vocabulary: str) -> str:
    """SQL: the distinct 1- to 3-grams of ``words`` that hold a peculiar word."""
    out = []
    for n in (1, 2, 3):
        part = f"slice({words}, i, {n})"
        out.append(f"CASE WHEN size({words}) >= {n} THEN transform(filter(sequence(1, size({words}) - {n - 1}), i -> arrays_overlap({part}, {vocabulary})), i -> concat_ws(' ', {part})) ELSE CAST(array() AS array<string>) END")
    return f"array_distinct(concat({', '.join(out)}))"


def _peculiar(spark: SparkSession) -> tuple[DataFrame, str]:
    """The templates with their words, and the peculiar words as an SQL array."""
    templates = small_table(spark, [(i, f, t) for i, (f, t) in enumerate(TEMPLATES)], "template int, family string, text string").selectExpr("template", "family", f"{_words('text')} AS words")
    common = ", ".join(f"'{w}'" for w in _COMMON)
    rows = templates.selectExpr("explode(words) AS w").where(f"NOT w RLIKE '^[0-9]+$' AND length(w) > 1 AND w NOT IN ({common})").distinct().orderBy("w").collect()  # words of the templates
    return templates, f"array({', '.join(repr(r.w) for r in rows)})"


def _paragraphs(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Lines and runs of lines with peculiar words: ``doc_id, txt, line, last, words``, lines counted from 0.

    A run starts and ends at a line with a peculiar word, and has at most
    the words of the longest template between the two; of those two lines
    it takes as many. Two words before and after it come along, as n-grams
    with a peculiar word reach that far.
    """
    most = max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in TEMPLATES)
    texts = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "xxhash64(CAST(text AS string)) AS txt", f"transform(split(CAST(text AS string), '\\n'), l -> {_words('l')}) AS lines")
    marked = texts.selectExpr("*", f"transform(lines, w -> arrays_overlap(w, {vocabulary})) AS told").where("exists(told, t -> t)")
    starts = marked.selectExpr("*", "posexplode(told) AS (line, here)").where("here").drop("here")
    # Each line of a run but the last has a word, so runs are no longer than this.
    ahead = starts.selectExpr(
        "doc_id", "txt", "line", "lines[line] AS words", "CASE WHEN line > 0 AND size(lines[line - 1]) > 0 THEN flatten(slice(lines, greatest(line - 1, 1), least(line, 2))) ELSE CAST(array() AS array<string>) END AS before",
        f"slice(lines, line + 2, {most + 4}) AS next", f"slice(told, line + 2, {most + 4}) AS told",
    )
    blank = "array_position(transform(next, w -> size(w)), 0)"
    near = ahead.selectExpr("*", f"int(CASE WHEN {blank} > 0 THEN {blank} - 1 ELSE size(next) END) AS reach")
    ends = near.selectExpr(
        "*", f"explode(concat(array(0), filter(CASE WHEN reach > 0 THEN sequence(1, reach) ELSE CAST(array() AS array<int>) END, j -> told[j - 1] AND size(flatten(slice(next, 1, j - 1))) <= {most}))) AS j"
    )
    start = f"CASE WHEN size(words) > {most} THEN slice(words, -{most}, {most}) ELSE concat(slice(reverse(slice(reverse(before), 1, 2)), 1, 2), words) END"
    end = f"CASE WHEN size(next[j - 1]) > {most} THEN slice(next[j - 1], 1, {most}) ELSE concat(next[j - 1], slice(flatten(slice(next, j + 1, greatest(least(reach - j, 2), 0))), 1, 2)) END"
    run = f"concat({start}, flatten(slice(next, 1, j - 1)), {end})"
    return ends.selectExpr("doc_id", "txt", "line", "line + j AS last", f"CASE WHEN j = 0 THEN words ELSE {run} END AS words").where(f"line = last OR arrays_overlap(words, {vocabulary})")


# Of the notices of a text the best confirmed, then the shortest, then the first; what overlaps it goes.
_BEST = """array_sort(collect_list(struct(-template_share AS behind, last - line AS length, line, last, family, probability, template_share, n)))"""
_APART = """aggregate(slice(found, 2, size(found)), slice(found, 1, 1), (taken, x) ->
  CASE WHEN exists(taken, t -> t.line <= x.last AND x.line <= t.last) THEN taken ELSE concat(taken, array(x)) END)"""


class LicenceModel:
    """What was learned: the features, the family weights and the calibration."""

    def __init__(self, spark: SparkSession, negatives: DataFrame):
        self.templates, self.peculiar = _peculiar(spark)
        grams = self.templates.selectExpr("template", "family", f"{_grams('words', self.peculiar)} AS grams")
        self.grams = grams
        listed = grams.selectExpr("explode(grams) AS g").distinct().orderBy("g").collect()  # n-grams of the templates
        self.vectorise = CountVectorizerModel.from_vocabulary([r.g for r in listed], "grams", "features").setBinary(True)
        known = f"array({', '.join(repr(r.g) for r in listed)})"
        runs = self.templates.selectExpr("template", "family", "words", "explode(sequence(1, size(words))) AS a").selectExpr("*", "explode(sequence(a, size(words))) AS b")
        says = runs.selectExpr("family", "b - a + 1 AS n", "size(words) AS whole", "slice(words, a, b - a + 1) AS words")
        positive = says.where(f"n >= {LEAST_RUN} * whole AND n >= least({LEAST_WORDS}, whole)").select("family", "words")
        # The same words backwards, and short runs, say nothing.
        backwards = self.templates.selectExpr(f"'{UNKNOWN}' AS family", "reverse(words) AS words")
        short = says.where(f"n < {LEAST_RUN / 2} * whole AND n <= 4 OR n < least({LEAST_WORDS}, whole)").selectExpr(f"'{UNKNOWN}' AS family", "words")
        sample = negatives.where("line = last").withColumn("h", F.expr("xxhash64(doc_id, line)")).withColumn("grams", F.expr(_grams("words", self.peculiar)))
        sample = sample.where(f"size(array_intersect(filter(grams, g -> g LIKE '% % %'), {known})) = 0").orderBy("h", "doc_id", "line").limit(NEGATIVES).selectExpr(f"'{UNKNOWN}' AS family", "words")
        rows = stage(positive.union(backwards).union(short).union(sample).distinct(), "licence-rows")
        families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
        self.families = families
        label = f"double(array_position(array({', '.join(map(repr, families))}), family) - 1)"
        rows = self.vectorise.transform(rows.selectExpr("*", f"{_grams('words', self.peculiar)} AS grams", f"{label} AS label", "pmod(xxhash64(words), 4) = 0 AS aside"))
        rows = rows.select("features", "label", "aside")
        self.weights = LogisticRegression(family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=60).fit(rows.where("NOT aside"))
        self._assemble = VectorAssembler(inputCols=["margin"], outputCol="margins")
        aside = self._assemble.transform(self._margin(rows.where("aside")).selectExpr("margin", "double(label > 0) AS is_licence"))
        self.calibration = LogisticRegression(featuresCol="margins", labelCol="is_licence", regParam=0.01).fit(aside)

    def _margin(self, rows: DataFrame) -> DataFrame:
        """The best family and its log odds against "unknown"."""
        scored = self.weights.transform(rows).withColumn("raw", vector_to_array("rawPrediction"))
        best = "slice(raw, 2, size(raw) - 1)"
        named = f"array({', '.join(map(repr, self.families[1:]))})"
        return scored.selectExpr("*", f"array_max({best}) - raw[0] AS margin", f"element_at({named}, int(array_position({best}, array_max({best})))) AS family")

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """``doc_id, txt, line, last, family, probability, template_share`` of paragraphs that hold a licence notice."""
        key = ["doc_id", "txt", "line", "last"]
        featured = self.vectorise.transform(paragraphs.selectExpr(*key, f"{_grams('words', self.peculiar)} AS grams"))
        scored = self._margin(featured).select(*key, "grams", "margin", "family")
        slope, offset = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
        likely = scored.selectExpr(*key, "grams", "family", f"1D / (1D + exp(-({slope!r}D * margin + {offset!r}D))) AS probability").where(f"probability >= {MIN_PROBABILITY}")
        # One row for each template: as long as the list above.
        templates = self.grams.groupBy("family").agg(F.collect_list("grams").alias("templates"))
        share = "array_max(transform(templates, t -> size(array_intersect(t, grams)) / size(t)))"
        sure = likely.join(F.broadcast(templates), "family").selectExpr(*key, "family", "probability", f"{share} AS template_share").where(f"template_share >= {MIN_TEMPLATE_SHARE}")
        # Equal rows add up first, so a group has no more rows than one text.
        each = sure.groupBy(*key, "family", "probability", "template_share").agg(F.count(F.lit(1)).alias("n"))
        apart = each.groupBy("doc_id", "txt").agg(F.expr(_BEST).alias("found")).selectExpr("doc_id", "txt", f"inline({_APART})")
        return apart.selectExpr("doc_id", "txt", "line", "last", "family", "probability", "template_share", "explode(sequence(1L, n)) AS copy").drop("copy")


def licence_notices(docs: DataFrame) -> DataFrame:
    """``doc_id, txt, line, last, family, probability, template_share`` for every licence notice in ``docs (doc_id, text)``.

    ``txt`` is the xxhash64 of the text. Lines count from 0; a notice goes from ``line`` to ``last``. A null or empty
    text has none. A null doc_id keeps its rows; equal rows give equal rows.
    Other columns are not looked at; an empty table gives none (the classifier
    then learns from templates alone).
    """
    spark = docs.sparkSession
    paragraphs = stage(_paragraphs(docs, _peculiar(spark)[1]), "paragraphs")
    # Files say little of how many paragraphs they hold, so tasks are cut by number.
    paragraphs = paragraphs.repartition(max(1, -(-paragraphs.count() // TASK_PARAGRAPHS)))
    return LicenceModel(spark, paragraphs).predict(paragraphs)


def document_licences(docs: DataFrame) -> DataFrame:
    """``doc_id, n_notices, families`` for every row of ``docs``: the notices of its own text.

    Rows that share a doc_id, or have none, are told apart by their texts.
    """
    found = licence_notices(docs).dropDuplicates(["doc_id", "txt", "line", "family"])
    per_text = found.groupBy("doc_id", "txt").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("family")).alias("families")).toDF("__id", "__txt", "n", "families")
    rows = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "xxhash64(CAST(text AS string)) AS txt")
    joined = rows.join(stage(per_text, "notices"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("txt") == F.col("__txt")), "left")
    return joined.selectExpr("doc_id", "coalesce(n, 0L) AS n_notices", "coalesce(families, CAST(array() AS array<string>)) AS families")
