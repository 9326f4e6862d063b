"""License scans: a trained paragraph classifier names the family, a template comparison confirms it. Built-in functions only.

A paragraph ends at a blank line; its wrapped lines are one text, and each line of a longer one is judged by itself too, as a statement is
often one line among others. Sparse word 1- and 2-grams of the licence texts go into a multinomial logistic regression over
licence families, the class "unknown" (a licence statement of no listed family) and the class "none". Its probabilities are
calibrated by one temperature on rows kept out of the fit. What is more probably a licence than not is reported: as its family if
that is probable enough and the text holds most word pairs of one of the family's templates, else as "unknown".
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

# Names and marks of licence families, as their publishers write them.
NAMES = {
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "mit": ("MIT License", "MIT license terms", "The MIT License (MIT)"),
    "gpl": ("GNU General Public License", "GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL", "GPL-3.0-or-later"),
    "lgpl": ("GNU Lesser General Public License", "GNU LGPL version 3", "LGPL-2.1-only"),
    "agpl": ("GNU Affero General Public License", "GNU AGPL version 3", "AGPL-3.0-only"),
    "bsd": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause"),
    "mpl-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"),
    "cc0": ("CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero"),
    "isc": ("ISC License", "ISC"),
    "all-rights-reserved": ("All rights reserved", "All rights are reserved"),
}
# Characteristic paragraphs of the licence texts and of the notices that their publishers ask for.
TEXTS = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/",
        "You may convey verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice; keep intact all notices stating that this License and any non-permissive terms added in accord with section 7 apply to the code; keep intact all notices of the absence of any warranty; and give all recipients a copy of this License along with the Program.",
        "You may copy and distribute verbatim copies of the Program's source code as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice and disclaimer of warranty.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source of your version.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "cc-by": (
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
        "You are free to share and adapt the material for any purpose, even commercially, as long as you give appropriate credit, provide a link to the license, and indicate if changes were made.",
    ),
    "cc-by-sa": (
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.",
    ),
    "cc-by-nc": (
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/",
        "You may not use the material for commercial purposes.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    "all-rights-reserved": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ),
}
#: Ways to state a licence; {} is its name.
STATEMENTS = (
    "{}", "{}.", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}", "This work is licensed under {}.",
    "This work is licensed under the {}.", "This program is distributed under the terms of the {}.", "SPDX-License-Identifier: {}",
    "Published under a {}.", "You may use this file under the {}.", "See the {} for details.", "The text is available under the {}.",
)
#: Invented names: statements with them are licence statements of no family.
STRANGE = ("Northwind Public Terms", "Blue Harbour License, version 7", "Example Sharing Deed 1.3", "Open Meadow License", "Quarry Source Licence", "Lantern Content Agreement", "Deed of 1812", "own terms")
#: Sentences that speak of licences and rights without stating one.
OTHER = (
    "My driving license expired, so I went to the office.", "Her driving licence was renewed last week.", "The license plate of the car was unreadable.",
    "Copyright law is taught in the second year.", "He is a licensed electrician and works in the city.", "The restaurant lost its liquor license in May.",
    "Poetic licence allows the author to bend the facts.", "Students discuss copyright and its history in class.", "The pub was licensed until midnight.",
    "They applied for a fishing license at the town hall.", "All seats are reserved for guests of the hotel.", "The rights of the workers were reserved for a later debate.",
    "The court spoke about copyright for three hours.", "A licence fee pays for public broadcasting.", "Gnu and zebra graze on the same plain.", "The software was released in spring.",
    "Permission to leave early was granted by the teacher.", "The conditions of the road were bad, use with care.", "The program is free for children under six.", "Distribution of food began at noon.",
)
#: The fit sees plain paragraphs and lines of so many different texts at most, those with the smallest hash, and so many distinct ones of them.
TEXTS_SEEN = 2_000
SAMPLE = 5_000
SURE = 0.5
ALIKE = 0.6
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
#: Paragraphs with such words are no examples of "none", as they may well state a licence.
_STATES = r"(?i)licen[cs]|copyright|copyleft|rights\s+(are\s+)?reserved|spdx|creative\s+commons|\bgnu\b|\bcc[ -]?(by|0)\b|redistribut|hereby\s+granted|warrant|commercial\s+purposes"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, digits, dots and hyphens, without dots and hyphens at their ends."""
    return F.array_remove(F.split(F.lower(text), r"^[.\-]+|[.\-]*(?:[^\p{L}\p{N}.\-]+[.\-]*|$)"), "")


def _plain_words(text: str) -> list[str]:
    """The same for the few fixed texts."""
    words = "".join(c if c.isalnum() or c in ".-" else " " for c in text.lower()).split()
    return [w for w in (w.strip(".-") for w in words) if w]


def _grams(text: str) -> list[str]:
    words = _plain_words(text)
    return [*words, *map(" ".join, zip(words, words[1:]))]


def _blocks(text: Column) -> Column:
    """The paragraphs of a text: what blank lines part, unless it is blank itself."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    return F.filter(F.split(plain, r"\n\s*\n\s*"), lambda b: ~b.rlike(r"^\s*$"))


def paragraphs(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but ``__text``, ``paragraph`` (its number) and ``text`` of every paragraph."""
    kept = [c for c in rows.columns if c != "__text"]
    return rows.select(*kept, F.posexplode(_blocks(F.col("__text"))).alias("paragraph", "text"))


def units(blocks: DataFrame) -> DataFrame:
    """The columns of ``blocks`` but ``paragraph`` and ``text``, and ``unit`` structs ``paragraph, line, text``: every paragraph (line null) and every line of those with more than one."""
    kept = [c for c in blocks.columns if c not in ("paragraph", "text")]
    k, b = F.col("paragraph"), F.col("text")
    lines = F.transform(F.split(b, "\n"), lambda x, i: F.struct(k.alias("paragraph"), i.alias("line"), x.alias("text")))
    whole = F.array(F.struct(k.alias("paragraph"), F.lit(None).cast("int").alias("line"), b.alias("text")))
    every = F.when(b.contains("\n"), F.concat(whole, F.filter(lines, lambda x: ~x["text"].rlike(r"^\s*$")))).otherwise(whole)
    return blocks.select(*kept, F.explode(every).alias("unit"))


def _once(df: DataFrame, keep: list[str], name: str, value: Column) -> DataFrame:
    """Adds a costly value. A generated column is not merged into what refers to it, nor are filters on it pushed below, so it is computed once a row."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


class Model:
    """Fitted classifier, its temperature, its classes and its vocabulary: the words and word pairs of all licence texts."""

    def __init__(self, spark: SparkSession, plain: DataFrame):
        """``plain``: texts of the corpus (``text``). Distinct ones without any licence word stand for the class "none"."""
        self.classes = ["none", "unknown", *NAMES]
        made = [(s.format(n), float(self.classes.index(f)), k) for f, names in NAMES.items() for n in names for k, s in enumerate(STATEMENTS)]
        for f, texts in TEXTS.items():
            for t in texts:
                words = t.split()
                parts = [t, *(" ".join(words[i : i + 14]) for i in range(0, max(1, len(words) - 13), 7))]  # wrapped lines of it too
                made += [(p, float(self.classes.index(f)), 0 if p == t else k) for k, p in enumerate(parts)]
        made += [(s.format(n), 1.0, k) for n in STRANGE for k, s in enumerate(STATEMENTS)]
        self.vocabulary = sorted({g for t, _, _ in made for g in _grams(t)})
        made += [(t, 0.0, k) for k, t in enumerate(OTHER) for _ in range(20)]
        quiet = (
            plain.where(F.col("text").isNotNull() & ~F.col("text").rlike(_STATES)).select("text").distinct().orderBy(F.xxhash64("text"), "text").limit(SAMPLE)
            .select("text", F.lit(0.0).alias("label"), F.pmod(F.xxhash64("text"), F.lit(7)).cast("long").alias("k"))
        )
        rows = written(self._featured(spark.createDataFrame(made, "text string, label double, k long").unionByName(quiet), ["label", "k"]).coalesce(2))
        self.model = LogisticRegression(
            featuresCol="__features", labelCol="label", rawPredictionCol="__r", predictionCol="", probabilityCol="", regParam=1e-3, family="multinomial", maxIter=40,
        ).fit(rows.where("k % 7 <> 3").select("__features", "label"))
        # one aggregate gives the log loss of all temperatures
        loss = [F.avg(-F.log(F.greatest(F.element_at(_soft(F.col("raw"), t), F.col("label").cast("int") + 1), F.lit(1e-9)))).alias(str(k)) for k, t in enumerate(TEMPERATURES)]
        losses = self._scored(rows.where("k % 7 = 3"), ["label"]).agg(*loss).first()  # one row
        self.temperature = min(zip([x if x is not None else 0.0 for x in losses], TEMPERATURES))[1]
        words = F.explode(F.array_distinct(words_of(F.col("text"))))
        seen = quiet.select(words.alias("w")).where(F.col("w").isin(*[g for g in self.vocabulary if " " not in g]))
        self.strong = self._strong({r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()})  # words of the fixed texts

    def _strong(self, seen: dict[str, int]) -> list[str] | None:
        """Words of which a text must hold one to be a licence at all; None if there is no such bound.

        A text is reported only if the best class gains more on "none" than the difference of their constants. The words that are
        frequent in plain text are taken out as long as all grams made of them alone, together, gain less than that: so a text
        with none of the other words is none, whatever else it holds.
        """
        bias, weights = self.model.interceptVector.toArray().tolist(), self.model.coefficientMatrix.toArray().tolist()
        gain = {g: max(0.0, max(w[i] for w in weights[1:]) - weights[0][i]) for i, g in enumerate(self.vocabulary)}
        needed = bias[0] - max(bias[1:]) - self.temperature * math.log((1 - SURE) / SURE * (len(bias) - 1)) - 1e-6
        weak: set[str] = set()
        for word in sorted({w for g in gain for w in g.split(" ")}, key=lambda w: (-seen.get(w, 0), w)):
            more = sum(x for g, x in gain.items() if word in g.split(" ") and weak.issuperset(set(g.split(" ")) - {word}))
            if more <= needed:
                weak.add(word)
                needed -= more
        return sorted({w for g in gain for w in g.split(" ")} - weak) if needed >= 0 else None

    def likely(self, blocks: DataFrame) -> DataFrame:
        """The paragraphs that may state a licence, or hold a line that does: those with one of the strong words. No other can."""
        if self.strong is None:
            return blocks
        held = _once(blocks, blocks.columns, "__w", words_of(F.col("text")))
        return held.where(F.arrays_overlap("__w", F.array(*map(F.lit, self.strong)))).drop("__w")

    def _featured(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, ``__pairs`` and ``__features`` of the column ``text``: which grams of the vocabulary it holds."""
        worded = _once(df, keep, "__w", words_of(F.col("text")))
        paired = NGram(n=2, inputCol="__w", outputCol="__2").transform(worded)
        gathered = _once(paired, keep, "__pairs", F.concat("__w", "__2"))
        counted = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="__pairs", outputCol="__features").setBinary(True)
        return counted.transform(gathered)

    def _scored(self, featured: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and ``raw``, the scores of all classes."""
        return _once(self.model.transform(featured), keep, "raw", vector_to_array("__r"))

    def classify(self, units: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, ``family``, ``probability`` and ``alike`` (best share of a template's word pairs) of units that state a licence."""
        cols = [*keep, "__pairs"]
        scored = self._scored(self._featured(units, keep), cols).where(F.array_max("raw") > F.col("raw")[0] - 10)  # far off: surely none
        calm = _once(scored, cols, "p", _soft(F.col("raw"), self.temperature)).where(F.col("p")[0] < 1 - SURE)
        known = F.slice("p", 3, len(NAMES))
        place = F.array_position(known, F.array_max(known)).cast("int")
        family = F.element_at(F.array(*map(F.lit, NAMES)), place)
        held = _once(calm.withColumns({"top": F.array_max(known), "named": family}), [*keep, "p", "top", "named"], "alike", self._alike())
        sure = (F.col("top") >= SURE) & (F.col("alike") >= ALIKE)
        return held.select(
            *keep, F.when(sure, F.col("named")).otherwise("unknown").alias("family"), F.when(sure, F.col("top")).otherwise(1 - F.col("p")[0]).alias("probability"),
            F.when(sure, F.col("alike")).otherwise(F.lit(0.0)).alias("alike"),
        )

    @staticmethod
    def _alike() -> Column:
        """The best share of word pairs (of its one word, if it has no more) of a template of the named family that the unit holds."""
        best = F.lit(0.0)
        for family, names in NAMES.items():
            shares = []
            for template in (*names, *TEXTS[family]):
                words = _plain_words(template)
                pairs = sorted({*map(" ".join, zip(words, words[1:]))} or set(words))
                shares.append(F.size(F.array_intersect("__pairs", F.array(*map(F.lit, pairs)))) / float(len(pairs)))
            best = F.when(F.col("named") == family, F.greatest(*shares, F.lit(0.0))).otherwise(best)
        return best


def _soft(raw: Column, temperature: float) -> Column:
    """Probabilities from raw scores, divided by the temperature."""
    top = F.array_max(raw)
    e = F.transform(raw, lambda x: F.exp((x - top) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_paragraphs``, ``licenses`` (structs ``paragraph, line, family, probability, alike, text`` in order) and ``families``.

    ``line`` is null for a statement that a whole paragraph makes. A paragraph gives its own family, and those that its lines give beside
    it; a line without a confirmed family counts only if its paragraph has none either.

    Each row of ``docs`` gives a row. Null and empty texts have no paragraphs and no licences. Repeated rows are scanned each, null
    ids stay null. An empty table gives no rows, and no fit fails: the fixed texts are always there. Other columns are
    ignored. Whole texts are read, of any length; only the class "none" is fitted on a
    sample, of at most ``SAMPLE`` distinct paragraphs and lines of ``TEXTS_SEEN`` texts.

    Rows are numbered once, in a written table, so that their hits come back to them whatever the order of the input. Only hits and one short row for each document are shuffled, by row number, so no key is hot.
    """
    text = F.col(text_col).cast("string")
    rows = written(docs.select(F.col(id_col), text.alias("__text"), F.size(_blocks(text)).cast("long").alias("n_paragraphs"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row")))
    blocks = paragraphs(rows.select("row", "__text"))
    last = rows.select("hash").distinct().orderBy("hash").limit(TEXTS_SEEN).agg(F.max("hash")).first()[0] or 0  # one number
    model = Model(docs.sparkSession, units(paragraphs(rows.where(F.col("hash") <= last).select("__text"))).select("unit.text"))
    found = model.classify(units(model.likely(blocks)).select("row", "unit", F.col("unit.text").alias("text")), ["row", "unit"])
    hit = F.struct(
        "unit.paragraph", "unit.line", "family", F.round("probability", 6).alias("probability"), F.round("alike", 6).alias("alike"), F.col("unit.text").alias("text")
    )
    hits = found.groupBy("row").agg(F.collect_list(hit).alias("hits"))  # the statements of one text
    each = rows.select("row", id_col, "n_paragraphs").join(hits, "row", "left")
    every = F.coalesce("hits", F.array().cast(dict(hits.dtypes)["hits"]))
    out = each.select(id_col, "n_paragraphs", F.array_sort(F.filter(every, lambda h: ~_said_elsewhere(h, every))).alias("licenses"))
    return out.withColumn("families", F.array_sort(F.array_distinct(F.transform("licenses", lambda h: h["family"]))))


def _said_elsewhere(h: Column, hits: Column) -> Column:
    """Whether a hit only repeats what its paragraph or one of its lines says better."""
    whole = lambda x: x["line"].isNull()
    beside = lambda x: x["paragraph"] == h["paragraph"]
    known = lambda x: x["family"] != "unknown"
    by_line = lambda x: F.exists(hits, lambda y: (y["paragraph"] == x["paragraph"]) & ~whole(y) & ((y["family"] == x["family"]) | ~known(x)))
    by_paragraph = F.exists(hits, lambda x: beside(x) & whole(x) & known(x) & ~by_line(x))
    return F.when(whole(h), by_line(h)).otherwise(~known(h) & by_paragraph)
