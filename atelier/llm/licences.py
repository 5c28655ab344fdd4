"""Licence notices in paragraphs, with DataFrame functions alone.

A paragraph ends at a line without letters or digits, or at a line end after a full stop or the like; lines wrapped inside a
sentence belong together. A logistic regression over sparse word 1- and 2-grams tells licence families from everything else. It is
trained on the driver from the paragraphs of the texts below, their fragments, and the class `unknown`: other licences, sentences
that use licence words otherwise, and paragraphs of a bounded sample of the corpus. Its probabilities are calibrated by a
temperature from whole paragraphs that were held out. A prediction is confirmed by comparison with the family's paragraphs: enough
of one's word pairs must stand in the paragraph, or enough of the paragraph's in one. Every paragraph is judged; one without any word of the
model is unknown. Cue words only choose the sample and count paragraphs that speak of licences.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import table

UNKNOWN = "unknown"
#: Rows of the corpus whose paragraphs serve as negatives, at most.
SAMPLE_ROWS = 200
SIMILAR = 0.6
#: Word pairs of a paragraph from which it may be confirmed as a part of a template.
PART = 8
#: Buckets of the look-up of words.
BUCKETS = 4096

#: Identifiers by family.
SPDX = {
    "apache-2.0": ["Apache-2.0"], "mit": ["MIT"], "gpl": ["GPL-3.0-or-later", "GPL-2.0-only", "GPL-3.0-only", "GPL-2.0-or-later"], "lgpl": ["LGPL-2.1-or-later", "LGPL-3.0-only"], "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "bsd": ["BSD-3-Clause", "BSD-2-Clause"], "mpl-2.0": ["MPL-2.0"], "cc-by": ["CC-BY-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc0": ["CC0-1.0"], "isc": ["ISC"], "unlicense": ["Unlicense"],
}
#: The licences' own words, a paragraph a line.
TEXTS: dict[str, str] = {
    "apache-2.0": """Licensed under the Apache License, Version 2.0.
Apache License Version 2.0, January 2004
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.
This project is released under the Apache 2.0 license.""",
    "mit": """MIT License
The MIT License (MIT)
Released under the MIT License.
This software is licensed under the MIT License.
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "gpl": """GNU GENERAL PUBLIC LICENSE
This work is licensed under the GNU General Public License, version 3.
Released under the GNU GPL v2.
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program.""",
    "lgpl": """GNU LESSER GENERAL PUBLIC LICENSE
This library is licensed under the GNU Lesser General Public License, version 2.1.
This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.
You should have received a copy of the GNU Lesser General Public License along with this library""",
    "agpl": """GNU AFFERO GENERAL PUBLIC LICENSE
Licensed under the GNU Affero General Public License, version 3.
This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation
You should have received a copy of the GNU Affero General Public License along with this program.""",
    "bsd": """BSD 3-Clause License
BSD 2-Clause License
Released under the BSD 3-Clause License.
Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "mpl-2.0": """Mozilla Public License Version 2.0
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.
Licensed under the Mozilla Public License, version 2.0.""",
    "cc-by": """Licensed under CC BY 4.0.
This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "cc-by-sa": """Licensed under CC BY-SA 4.0.
This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "cc-by-nc": """Licensed under CC BY-NC 4.0.
This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.""",
    "cc0": """Released into the public domain under CC0 1.0 Universal.
To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
    "isc": """ISC License
Released under the ISC License.
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "proprietary": """All rights reserved. No part of this publication may be reproduced without prior written permission.
This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.""",
}
TEMPLATES: dict[str, list[str]] = {f: t.split("\n") + [f"SPDX-License-Identifier: {x}" for x in SPDX.get(f, [])] for f, t in TEXTS.items()}
#: Other licences and other uses of the words: the class unknown.
NEGATIVES = """This program and the accompanying materials are made available under the terms of the Eclipse Public License which is available at https://www.eclipse.org/legal/
The Eclipse Public License applies to this content.
The contents of this file are subject to the terms of the Common Development and Distribution License
You can obtain a copy of the license in the file CDDL or from the website of the owner.
This software is provided as-is, without any express or implied warranty.
In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions
The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
Licensed under the European Union Public Licence, version 1.2.
Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.
SPDX-License-Identifier: EPL-2.0
SPDX-License-Identifier: Zlib
SPDX-License-Identifier: EUPL-1.2
SPDX-License-Identifier: CDDL-1.0
He lost his driving license last summer.
The copyright debate went on in parliament for years.
She gave permission to enter the house and use the kitchen.
A two year warranty covers parts and labour.
The mit students released a new album under the bridge.
The gnu is a large antelope that lives in the public parks of Africa.
The Apache helicopter, version 2, was shown to the general public.
Common creative work is free for any person with a purpose.
Fishing licences are sold at the general store.
The licensed broker may not use this account without notice.
Distribution of food and water was permitted under the following conditions.
You should have received a copy of the letter along with the parcel.
The author waived the fee and gave all rights to the foundation.
The software is sold without support.
The licence of the restaurant was renewed by the city, and the owner was free to use the terrace.
All copies of the book were sold, and the publisher reserved the rights to the film.
Copyright (c) 2020 the authors
The program is free for members, and you can obtain a copy at the desk.""".split("\n")
CUES = """licen copyright spdx permission permitted warrant redistribut public-domain rights-reserved proprietary bsd gpl mozilla-public
creative-commons cc-by cc0 free-software general-public""".split()
_WORD = r"[a-z0-9]+"


def cued(text: Column) -> Column:
    """Whether a text holds a cue word."""
    low = F.lower(text)
    plain = [F.contains(low, F.lit(c)) for c in CUES] + [F.contains(low, F.lit(c.replace("-", " "))) for c in CUES if "-" in c]
    return reduce(Column.__or__, plain)


def grams(text: str) -> list[str]:
    w = re.findall(_WORD, text.lower())
    return [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]


@dataclass
class Model:
    families: list[str]
    weights: dict[str, list[float]]  # by gram, one a class; the words of a pair are grams, too
    bias: list[float]


def _fragments(text: str) -> list[str]:
    """The text, and its parts of at least four words: thirds overlapping by half."""
    w = text.split()
    out, size = [text], max(4, 2 * len(w) // 3)
    for i in range(0, len(w) - size + 1, max(1, size // 2)):
        if len(w) > size:
            out.append(" ".join(w[i : i + size]))
    return out


#: Where a paragraph ends: a line without letters and digits, or a line end after the end of a sentence.
_END = r"\n[^\p{L}\p{N}\n]*\n|(?<=[\p{L}\p{N})\"'][.!?;:])[ \t\r\"')]*+\n"


def corpus_lines(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[str]:
    """Distinct paragraphs without a cue of at most `rows` documents, those of the smallest hash of doc_id; of each its first 300 characters, for training only."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    every = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(F.explode(F.split("text", _END)).alias("line"))
    lines = every.where(~cued(F.col("line"))).select(F.substring("line", 1, 300).alias("line"))
    return sorted(r["line"] for r in lines.distinct().orderBy(F.xxhash64("line"), "line").limit(3 * rows).collect())


def train(lines: list[str], *, ridge: float = 1e-4, steps: int = 300, rate: float = 2.0) -> Model:
    """Multinomial logistic regression by gradient steps, then a temperature.

    The temperature is fitted on every fourth template and negative, whole, with all their fragments, by a model that never saw them.
    """
    families = [UNKNOWN, *TEMPLATES]
    samples = [(f, family, i % 4 == 3) for family, texts in TEMPLATES.items() for i, t in enumerate(texts) for f in _fragments(t)]
    samples += [(f, UNKNOWN, i % 4 == 3) for i, t in enumerate(NEGATIVES) for f in _fragments(t)]
    samples += [(a, UNKNOWN, i % 4 == 3) for i, a in enumerate(lines)]
    samples += [(f"{a} {b}", UNKNOWN, i % 4 == 3) for i, (a, b) in enumerate(zip(lines, NEGATIVES * (len(lines) // len(NEGATIVES) + 1), strict=False))]
    vocabulary = {g: i for i, g in enumerate(sorted({g for texts in [*TEMPLATES.values(), NEGATIVES] for t in texts for g in grams(t)}))}
    x = np.zeros((len(samples), len(vocabulary) + 1), np.float32)
    for i, (text, _, _) in enumerate(samples):
        x[i, [vocabulary[g] for g in set(grams(text)) if g in vocabulary]] = 1
    x[:, -1] = 1
    y = np.array([families.index(f) for _, f, _ in samples])
    weight = 1 / np.bincount(y, minlength=len(families))[y]
    weight[y == 0] *= 3  # most of what has a cue is no licence
    held = np.array([h for _, _, h in samples])

    def descend(rows: np.ndarray) -> np.ndarray:
        a, t, own = x[rows], np.eye(len(families), dtype=np.float32)[y[rows]], (weight[rows] / weight[rows].sum()).astype(np.float32)
        w = np.zeros((x.shape[1], len(families)), np.float32)
        for _ in range(steps):
            w -= rate * (a.T @ ((_softmax(a @ w) - t) * own[:, None]) + ridge * w)
        return w

    part = descend(~held)
    scales = np.linspace(0.5, 6, 56)
    loss = [-(weight[held] * np.log(_softmax(s * (x[held] @ part))[np.arange(held.sum()), y[held]] + 1e-12)).sum() for s in scales]
    w = descend(np.ones(len(y), bool)) * scales[int(np.argmin(loss))]
    return Model(families, {g: w[i].round(4).tolist() for g, i in vocabulary.items()}, w[-1].round(4).tolist())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _pairs(words: Column) -> Column:
    return F.zip_with(words, F.concat(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), F.array(F.lit("").cast("string"))), lambda a, b: F.concat_ws(" ", a, b))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """docs, all columns kept, with n_cues and licences: array<struct<paragraph, family, probability, similarity, confirmed>>.

    paragraph counts from 0; only paragraphs whose likeliest class is a family are listed. Null and empty texts
    have none; a very long paragraph is read whole; repeated rows each get their result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    buckets: list[dict[str, list[float]]] = [{} for _ in range(BUCKETS)]
    for g, w in model.weights.items():
        buckets[zlib.crc32(g.encode()) % BUCKETS][g] = w
    # constants as JSON: one literal each, folded once
    weights = F.from_json(F.lit(json.dumps(buckets)), "array<map<string, array<double>>>")
    bias, names = F.array(*map(F.lit, model.bias)), F.array(*map(F.lit, model.families))
    pairs_of = [[]] + [[sorted({g for g in grams(t) if " " in g}) for t in texts] for texts in TEMPLATES.values()]
    templates = F.from_json(F.lit(json.dumps(pairs_of)), "array<array<array<string>>>")
    every = F.transform(F.split(text, _END), lambda p, i: F.struct(i.alias("paragraph"), p.alias("text")))

    def known(g: Column) -> Column:
        return F.try_element_at(F.element_at(weights, (F.crc32(g) % BUCKETS).cast("int") + 1), g)

    # lambdas share no subexpressions: each step names what the next one reads more than once
    def worded(p: Column) -> Column:
        return F.struct(p["paragraph"].alias("paragraph"), F.regexp_extract_all(F.lower(p["text"]), F.lit(_WORD), F.lit(0)).alias("words"))

    def alone(p: Column) -> Column:
        return F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), F.transform(p["words"], lambda w: F.when(known(w).isNotNull(), w)).alias("known"))

    def terms(p: Column) -> Column:
        # a pair is known only if both of its words are: no other is joined and looked up
        pairs = F.filter(_pairs(p["known"]), lambda x: F.contains(x, F.lit(" ")))
        found = F.array_compact(F.transform(F.array_distinct(F.concat(F.array_compact(p["known"]), pairs)), known))
        return F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), found.alias("terms"))

    def logits(p: Column) -> Column:
        total = F.aggregate(p["terms"], bias, lambda a, t: F.zip_with(a, t, lambda x, y: x + y))
        return F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), total.alias("z"))

    def topped(p: Column) -> Column:
        return F.struct(p["paragraph"].alias("paragraph"), p["words"].alias("words"), p["z"].alias("z"), F.array_max(p["z"]).alias("top"))

    def best(p: Column) -> Column:
        return F.struct(
            p["paragraph"].alias("paragraph"),
            (F.array_position(p["z"], p["top"]).cast("int")).alias("class"),
            (1 / F.aggregate(p["z"], F.lit(0.0), lambda a, z: a + F.exp(z - p["top"]))).alias("probability"),
            p["words"].alias("words"),
        )

    def paired(p: Column) -> Column:
        return p.withField("pairs", F.filter(F.array_distinct(_pairs(p["words"])), lambda x: F.contains(x, F.lit(" "))))

    def near(p: Column) -> Column:
        size = F.size(p["pairs"])
        shared = lambda t: F.size(F.array_intersect(t, p["pairs"]))
        most = F.array_max(F.transform(F.element_at(templates, p["class"]), lambda t: F.greatest(shared(t) / F.size(t), F.when(size >= PART, shared(t) / size).otherwise(0.0))))
        return p.withField("similarity", most)

    def compared(p: Column) -> Column:
        return F.struct(
            p["paragraph"].alias("paragraph"),
            F.element_at(names, p["class"]).alias("family"),
            p["probability"].alias("probability"),
            p["similarity"].alias("similarity"),
            ((p["probability"] >= 0.5) & (p["similarity"] >= SIMILAR)).alias("confirmed"),
        )

    known_words = F.filter(reduce(F.transform, [worded, alone, terms], every), lambda p: F.size(p["terms"]) > 0)
    judged = F.filter(reduce(F.transform, [logits, topped, best], known_words), lambda p: p["class"] > 1)
    listed = reduce(F.transform, [paired, near, compared], F.col("_judged"))
    cues = F.when(cued(text), F.size(F.filter(F.split(text, _END), cued))).otherwise(0)
    return docs.withColumns({"n_cues": cues, "_judged": judged}).withColumn("licences", listed).drop("_judged")


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(corpus_lines(docs)))
    sure = F.filter("licences", lambda x: x["confirmed"])
    listed = F.array_join(F.transform(sure, lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",")
    return found.select(
        "doc_id", F.col("n_cues").cast("long").alias("n_cues"), F.size("licences").cast("long").alias("n_predicted"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"), listed.alias("licences"),
    )


QUERIES = {"op10_license_scans": op10_license_scans}
ORACLE: dict[str, str] = {}
