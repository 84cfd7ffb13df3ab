"""Licence scan: a trained paragraph classifier, in DataFrame operations and Spark ML only.

A paragraph is a line, or a run of up to ``RUN`` lines without a blank one among them, so that wrapped wording is judged
as a whole; of the runs that are confirmed the shortest count. Paragraphs are lists of words. Features are the word n-grams of the templates below that hold
a telling word, that is, any but ``COMMON``; a multinomial logistic regression over them knows the
licence families and "unknown". It learns from the templates, parts of them, and
``OTHER``, sentences that sound alike but grant nothing. The probability from which a family
counts is calibrated on rows left out of the fit, and a prediction is confirmed
by comparing the paragraph with the templates of that family. A
paragraph without a telling word has no feature; it is unknown, and is never scored.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Short forms of public licences, by family.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file for details."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
                   "in compliance with the License."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("BSD", "Distributed under the BSD 3-Clause License."),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "Available under the Creative Commons Attribution-ShareAlike License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal."),
    ("CC0", "This is free and unencumbered software released into the public domain."),
    ("reserved", "All rights reserved."),
    ("reserved", "Copyright, all rights reserved. No part may be reproduced without written permission."),
]

# Headers and tags. A paragraph must have them by pairs of words, not by scattered ones.
HEADERS = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("GPL", "GNU General Public License"),
    ("LGPL", "GNU Lesser General Public License"),
    ("BSD", "BSD 3-Clause License"),
    ("BSD", "BSD 2-Clause License"),
    ("MPL", "Mozilla Public License Version 2.0"),
    ("CC-BY", "Creative Commons Attribution 4.0 International"),
    ("CC-BY", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-SA", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC0", "CC0 1.0 Universal"),
    ("CC0", "SPDX-License-Identifier: CC0-1.0"),
]

# Sentences of the full texts and of the notices in files.
FULL_TEXTS = [
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("MIT", "The software is provided as is, without warranty of any kind, express or implied, including but not "
            "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an as is basis, without warranties or conditions of any kind, either express or "
                   "implied."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission."),
    ("BSD", "This software is provided by the copyright holders and contributors as is and any express or implied "
            "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
            "particular purpose are disclaimed."),
    ("MPL", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]

TEMPLATES += [*HEADERS, *FULL_TEXTS]


# Sentences that share words with licences and are none.
OTHER = [
    "She is a licensed driver and keeps her license in the car.",
    "The license plate was free of dirt.",
    "Students at MIT built the software in a week.",
    "The Apache helicopter, version 64, was released in public.",
    "The general public was permitted to use the source of the river.",
    "All rights and duties were reserved for the next meeting.",
    "Permission to copy the file was granted in writing.",
    "The Mozilla browser has a public version 2.0.",
    "The work of the foundation is subject to the following conditions.",
    "Attribution of the work is a creative question.",
    "The program can modify its source code.",
    "The author has lost all copyright cases under this law.",
    "A clause of the terms was published without modification.",
    "Copyright law is a domain of public interest.",
    "The international version is distributed free of charge.",
    "He released the file under another version.",
]

# Words that tell nothing of licences.
COMMON = (
    "a an and any are as at be by can do for form forms from has have he her his if in is it its no not of on or part "
    "she so that the their them they this to under was were with without work you your all may use person 1 2 3 4 0 "
    "above agreed along applicable basis but derived either express http https included including kind limited list "
    "materials must name names neither nor notice obtain one other particular portions prior products promote purpose "
    "received reproduce required retain shall should specific substantial unless used writing"
).split()

# What names a family in lower-cased words. A paragraph may name more than one.
SIGNS = {
    "MIT": r"(^| )mit( |$)|permission is hereby granted free of charge to any person",
    "Apache-2.0": r"(^| )apache-2\.0|apache license (version )?2\.0",
    "GPL": r"gnu general public|(^| )(gpl|gplv[23]|gpl-3\.0-or-later)( |$)",
    "LGPL": r"gnu (lesser|library) general public|(^| )(lgpl|lgplv[23]|lgpl-2\.1-only)( |$)",
    "BSD": r"(^| )bsd( |$|-)|redistribution and use in source and binary forms",
    "MPL": r"mozilla public license|(^| )mpl( |$|-)",
    "CC-BY": r"creative commons attribution( (?!share|non|no)|$)|(^| )cc(-by-4\.0| by)( |$)",
    "CC-BY-SA": r"attribution[ -]share-?alike|(^| )cc[ -]by-sa",
    "CC-BY-NC": r"attribution[ -]non-?commercial|(^| )cc[ -]by-nc",
    "CC0": r"(^| )cc0( |$|-)|free and unencumbered software",
    "reserved": r"all rights reserved",
}

# SPDX ids of a family, and the one that stands for them in the templates.
SPDX = [
    (r"lgpl-[0-9][a-z0-9.+-]*", "lgpl-2.1-only"),
    (r"gpl-[0-9][a-z0-9.+-]*", "gpl-3.0-or-later"),
    (r"(?:0bsd|bsd-[0-9][a-z0-9.-]*)", "bsd-3-clause"),
    (r"mpl-[0-9][a-z0-9.-]*", "mpl-2.0"),
    (r"cc-by-nc-[a-z0-9.-]*", "cc-by-nc-4.0"),
    (r"cc-by-sa-[0-9][a-z0-9.-]*", "cc-by-sa-4.0"),
    (r"cc-by-[0-9][a-z0-9.-]*", "cc-by-4.0"),
    (r"cc0-[0-9][a-z0-9.-]*", "cc0-1.0"),
    (r"mit-(?:0|cmu|feh|modern-variant|open-group)", "mit"),
]

RUN = 16  # lines; the longest template has 36 words

LONGEST = 3
CUT = r"[^a-z0-9.+-]+"
BEFORE, AFTER = r"(?<![a-z0-9.+-])", r"(?![a-z0-9+-])"


def words_of(text: Column) -> Column:
    """Lower-cased words; marks at the end of a sentence are not part of them, an SPDX id becomes its family's."""
    lower = F.lower(text)
    spdx = functools.reduce(
        lambda rest, x: F.regexp_replace(rest, rf"{BEFORE}{x[0]}{AFTER}", x[1]), SPDX, lower
    )
    spdx = F.when(lower.rlike(f"{BEFORE}(?:{'|'.join(ids for ids, _ in SPDX)})"), spdx).otherwise(lower)
    return F.array_remove(F.split(F.regexp_replace(spdx, r"[.+-]+(\s|$)", " "), CUT), "")


def _pairs_of(words: Column) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))
    )


def _words(text: str) -> list[str]:
    words = [w for w in re.split(CUT, re.sub(r"[.+-]+(\s|$)", " ", text.lower())) if w]
    return [next((known for ids, known in SPDX if re.fullmatch(ids, w)), w) for w in words]


def telling_words() -> list[str]:
    return sorted({w for _, t in TEMPLATES for w in _words(t)} - set(COMMON))


def vocabulary() -> list[str]:
    telling, grams = set(telling_words()), set()
    for _, text in TEMPLATES:
        words = _words(text)
        for n in range(1, LONGEST + 1):
            for i in range(len(words) - n + 1):
                if telling & set(words[i : i + n]):
                    grams.add(" ".join(words[i : i + n]))
    return sorted(grams)


def _examples() -> list[tuple[str, list[str], int]]:
    """(family, words, fold): templates, their halves and all of them but one word; the others likewise."""
    rows = []
    for family, text in [*TEMPLATES, *((UNKNOWN, t) for t in OTHER)]:
        words = _words(text)
        rows.append((family, words, 0))
        rows += [(family, words[:i] + words[i + 1 :], 1 + i % 5) for i in range(len(words)) if len(words) > 4]
        if len(words) >= 12 and family != UNKNOWN:
            rows += [(family, words[: 2 * len(words) // 3], 0), (family, words[len(words) // 3 :], 0)]
    rows += [(UNKNOWN, [w], 0) for w in telling_words()]
    return rows


def _once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with ``column``, which the optimizer then doesn't copy to each place that reads it."""
    return df.select("*", F.explode(F.array(column)).alias(name))


@dataclass
class Scanner:
    features: PipelineModel
    classifier: object
    families: list[str]
    threshold: float
    against_unknown: float = 1.0

    def probabilities(self, paragraphs: DataFrame) -> DataFrame:
        """``paragraphs`` (with words) with the likeliest family, its probability, and those of all families.

        ``chances`` holds for each family its probability p and, as ``odds``, p / (p + that of "unknown").
        """
        scored = self.classifier.transform(self.features.transform(paragraphs))
        p = F.col("_p")
        none = p[self.families.index(UNKNOWN)]
        chances = F.array(
            *[
                F.struct(p[i].alias("p"), F.lit(f).alias("f"), (p[i] / (p[i] + none)).alias("odds"))
                for i, f in enumerate(self.families)
                if f != UNKNOWN
            ]
        )
        best = F.array_max(chances)
        return _once(scored, "_p", vector_to_array("probability")).select(
            *paragraphs.columns, best["f"].alias("family"), best["p"].alias("probability"), chances.alias("chances")
        )


def train(spark: SparkSession) -> Scanner:
    """Fit on the examples of folds 0 to 3, calibrate on the others."""
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    rows = [(float(families.index(f)), f, w, fold) for f, w, fold in _examples()]
    examples = spark.createDataFrame(rows, "label double, truth string, words array<string>, fold int")
    grams = [NGram(n=n, inputCol="words", outputCol=f"_grams{n}") for n in range(1, LONGEST + 1)]
    counters = [
        CountVectorizerModel.from_vocabulary(
            [g for g in vocabulary() if g.count(" ") == n - 1], inputCol=f"_grams{n}", outputCol=f"_counts{n}"
        ).setBinary(True)
        for n in range(1, LONGEST + 1)
    ]
    joined = VectorAssembler(inputCols=[f"_counts{n}" for n in range(1, LONGEST + 1)], outputCol="features")
    features = Pipeline(stages=[*grams, *counters, joined]).fit(examples)
    seen = features.transform(examples)
    fitted = LogisticRegression(family="multinomial", regParam=0.001, maxIter=100).fit(seen.filter("fold < 4"))
    scanner = Scanner(features, fitted, families, 0.5)
    left_out = scanner.probabilities(examples.filter("fold >= 4").drop("label"))
    right = F.col("family") == F.col("truth")
    odds = F.array_max(F.transform("chances", lambda x: x["odds"]))
    lowest, highest, odds_lowest, odds_highest = left_out.agg(
        F.percentile(F.when(right, F.col("probability")), F.lit(0.05)),
        F.max(F.when(F.col("truth") == UNKNOWN, F.col("probability"))),
        F.percentile(F.when(right, odds), F.lit(0.05)),
        F.max(F.when(F.col("truth") == UNKNOWN, odds)),
    ).first()
    # Above every sentence that is no licence, below nearly all that are.
    scanner.threshold = max(highest, (lowest + highest) / 2)
    scanner.against_unknown = max(odds_highest, (odds_lowest + odds_highest) / 2)
    return scanner


def _runs(docs: DataFrame, separator: str) -> DataFrame:
    """(doc_id, text) rows to telling lines and runs of lines: _row, doc_id, first, last, text.

    A run of several lines is judged by pairs of words, so its first line has one of them or its beginning, and its last line
    one or its end.
    """
    # The lists of words and pairs are as long as the templates above make them.
    gate = f"{BEFORE}(?:{_any_of(telling_words()).removeprefix(BEFORE)}|{'|'.join(ids for ids, _ in SPDX)})"
    known = sorted({p for _, t in TEMPLATES for p in _telling_pairs(t)})
    pairs, begins, ends = (
        F.array(*map(F.lit, sorted(set(x)))) for x in (known, [p.split()[0] for p in known], [p.split()[-1] for p in known])
    )

    def part(words: Column) -> Column:
        inside = F.arrays_overlap(_pairs_of(words), pairs)
        return F.struct(
            (inside | F.array_contains(begins, F.get(words, F.size(words) - 1))).alias("opens"),
            (inside | F.array_contains(ends, F.get(words, F.lit(0)))).alias("closes"),
        )

    lines = F.transform(
        F.split("text", separator),
        lambda x: F.struct(
            x.alias("text"),
            F.when(F.lower(x).rlike(gate), F.transform(F.array(words_of(x)), part)[0]).alias("part"),
            (F.trim(x) == "").alias("blank"),
        ),
    )
    marked = _once(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text"), "_lines", lines)
    starts = F.transform(
        "_lines",
        lambda x, i: F.when(
            x["part"].isNotNull(),
            F.struct(i.alias("first"), F.slice("_lines", i + 1, F.when(x["part"]["opens"], RUN).otherwise(1)).alias("near")),
        ),
    )
    begun = marked.select("_row", "doc_id", F.inline(F.filter(starts, lambda x: x.isNotNull())))
    border = F.coalesce(F.array_min(F.transform("near", lambda x, k: F.when(x["blank"], k))), F.lit(RUN))
    last = F.transform(
        "near", lambda x, k: F.when((k == 0) | (x["part"]["closes"] & (k < F.col("_border"))), k)
    )
    runs = _once(begun, "_border", border).select(
        "_row", "doc_id", "first", "near", F.explode(F.filter(last, lambda k: k.isNotNull())).alias("_more")
    )
    text = F.array_join(F.transform(F.slice("near", 1, F.col("_more") + 1), lambda x: x["text"]), "\n")
    return runs.select("_row", "doc_id", "first", (F.col("first") + F.col("_more")).alias("last"), text.alias("text"))


def scan(
    docs: DataFrame,
    scanner: Scanner,
    separator: str = "\n",
    least_similarity: float = 0.6,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, paragraph (from 0), text, family, probability, template, similarity and confirmed.

    One row for each family of a line with a telling word: the likeliest one, if its probability passes the threshold, and every
    other that the line names by one of ``SIGNS``, if it passes against "unknown". A family that is confirmed in a run of
    lines but not in a shorter part of it has a row too; ``paragraph`` is the run's first line.
    ``similarity`` is the share of the closest template that the paragraph has: of its words and n-grams up to two in a line that
    stands for itself, or of its telling word pairs; from ``least_similarity`` on the family is confirmed. Null and empty texts have no
    paragraphs that count, rows with null ids are scanned too, repeated rows are each reported, other columns are not read.
    """
    runs = _runs(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), separator)
    cut = _once(_once(runs, "words", words_of(F.col("text"))), "_pairs", _pairs_of(F.col("words")))
    scored = scanner.probabilities(cut)
    joined = F.array_join("words", " ")
    counts = F.array(*[F.struct(F.lit(f).alias("f"), joined.rlike(sign).alias("named")) for f, sign in sorted(SIGNS.items())])
    named = F.transform(F.filter(counts, lambda x: x["named"]), lambda x: x["f"])
    passed = F.filter(
        "chances",
        lambda x: ((x["f"] == F.col("family")) & (x["p"] > scanner.threshold))
        | (F.array_contains(F.col("_named"), x["f"]) & (x["odds"] > scanner.against_unknown)),
    )
    passing = _once(_once(scored, "_named", named), "_passed", passed).filter(F.size("_passed") > 0)
    options = F.array(
        *[
            F.struct(F.lit(f).alias("family"), F.lit(t).alias("text"), _grams(t).alias("grams"), F.array(*map(F.lit, _telling_pairs(t))).alias("pairs"), F.lit((f, t) in HEADERS).alias("header"))
            for f, t in TEMPLATES
        ]
    )
    def share(grams: Column) -> Column:
        return F.size(F.array_intersect(grams, F.col("_grams"))) / F.size(grams)

    def best(family: Column) -> Column:
        return F.array_max(
            F.transform(
                F.filter(options, lambda x: x["family"] == family),
                lambda x: F.struct(
                    F.when((F.col("first") < F.col("last")) | x["header"], share(x["pairs"]))
                    .otherwise(F.greatest(share(x["grams"]), share(x["pairs"])))
                    .alias("similarity"),
                    x["text"].alias("template"),
                ),
            )
        )

    found = F.transform(
        "_passed", lambda x: F.struct(x["f"].alias("family"), x["p"].alias("probability"), best(x["f"]).alias("best"))
    )
    rows = _once(passing, "_grams", F.concat("words", "_pairs")).select(
        "_row", "doc_id", "first", "last", "text", F.inline(found)
    )
    rows = rows.withColumn("confirmed", F.col("best.similarity") >= least_similarity)
    # A run counts if it is confirmed and no shorter part of it is, nor does it overlap one that counts already.
    rows = rows.filter((F.col("first") == F.col("last")) | F.col("confirmed"))
    hit = F.struct("last", (-F.col("first")).alias("first"), "text", "probability", "best", "confirmed")
    in_order = F.array_sort(F.collect_list(hit))
    none = F.array().cast(f"array<{_hit_type(rows, hit)}>")
    chosen = F.aggregate(
        "_hits",
        F.struct(F.lit(-1).alias("end"), none.alias("hits")),
        lambda done, x: F.when(
            ~x["confirmed"], F.struct(done["end"].alias("end"), F.concat(done["hits"], F.array(x)).alias("hits"))
        )
        .when(
            -x["first"] > done["end"],
            F.struct(x["last"].alias("end"), F.concat(done["hits"], F.array(x)).alias("hits")),
        )
        .otherwise(done),
        lambda done: done["hits"],
    )
    by_doc = rows.groupBy("_row", "doc_id", "family").agg(in_order.alias("_hits"))
    return by_doc.select("doc_id", "family", F.explode(chosen).alias("hit")).select(
        "doc_id",
        (-F.col("hit.first")).alias("paragraph"),
        "hit.text",
        "family",
        "hit.probability",
        "hit.best.template",
        "hit.best.similarity",
        "hit.confirmed",
    )


def _hit_type(rows: DataFrame, hit: Column) -> str:
    return rows.select(hit.alias("hit")).schema["hit"].dataType.simpleString()


def _grams(text: str) -> Column:
    words = _words(text)
    return F.array(*[F.lit(g) for g in dict.fromkeys([*words, *map(" ".join, zip(words, words[1:], strict=False))])])


def _telling_pairs(text: str) -> list[str]:
    """The word pairs that hold a telling word."""
    words, telling = _words(text), set(telling_words())
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in telling or b in telling]
    return list(dict.fromkeys(pairs or words))


def _any_of(words: list[str]) -> str:
    """A pattern that finds one of ``words`` as a whole word, with shared beginnings tried once."""
    tree: dict = {}
    for word in words:
        node = tree
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        options = [re.escape(letter) + pattern(below) for letter, below in sorted(node.items()) if letter]
        inner = options[0] if len(options) == 1 else f"(?:{'|'.join(options)})" if options else ""
        return f"(?:{inner})?" if "" in node and inner else inner

    return rf"(?<![a-z0-9.+-]){pattern(tree)}(?=[.+-]*(?:[^a-z0-9.+-]|$))"
