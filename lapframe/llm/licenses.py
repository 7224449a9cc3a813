"""License scans: headers and license files by TF-IDF cosine to templates, then inheritance from the nearest directory.

A file with a cue word gives passages: its sentences with a cue, blocks of lines around each line with
one (so wrapped headers are met whole), and the whole file. Each is compared with every template:
sentences as they are used in notices, the usual headers, short license texts and SPDX lines. Weights
of template terms come from the files with a cue; any other term weighs as if no file had it, so text
around a notice lowers its cosine. Templates are a fixed, small table that every task has; a file is compared
where it is read, so no terms are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.llm.common import stored, text_chunks

# Usual notices, headers and short texts of public licenses, and their SPDX lines.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
        THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
        THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright, CC0 1.0 public domain dedication",
        """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
        work. This work is published from""",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/.""",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.""",
        "SPDX-License-Identifier: ISC",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)
        any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public
        License for more details.""",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Proprietary": ("Copyright, all rights reserved",),
}
# Only files with such a word are compared, and only around it; every template has one.
CUE = r"(?i)licen[sc]e|copyright|redistribut|rights reserved|public domain|permission"
# Lines before and after a line with a cue that make up a block.
AROUND = (2, 6, 12)
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
SENTENCE = r"(?<=[.!?;])[\x20\x09-\x0D]+|\n"
# Least cosine of a notice, and least share of a text that makes the file its directory's license.
LEAST_COSINE = 0.6
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*$"


_CUE, _SENTENCE = re.compile(CUE), re.compile(SENTENCE)


def _terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


@dataclass(frozen=True)
class Weights:
    """Weights of template terms and of any other, and the templates as unit vectors by term."""

    idf: dict[str, float]
    other: float
    units: dict[str, list[tuple[str, int, float]]]

    def best(self, counts: Counter[str]) -> list[tuple[str, float]]:
        """Each license near enough to a passage with its cosine: that of the best of its templates."""
        norm, dots = 0.0, Counter()
        for term, k in counts.items():
            weight = k * self.idf.get(term, self.other)
            norm += weight * weight
            for name, variant, unit in self.units.get(term, ()):
                dots[name, variant] += weight * unit
        top: dict[str, float] = {}
        for (name, _), dot in dots.items():
            top[name] = max(top.get(name, 0.0), dot / math.sqrt(norm))
        return [(name, cosine) for name, cosine in top.items() if cosine >= LEAST_COSINE]


def corpus_weights(files: DataFrame) -> Weights:
    """Weights from the numbers of files with a cue that have each template term: one grouped count."""
    texts = [(name, i, Counter(_terms(text))) for name, variants in TEMPLATES.items() for i, text in enumerate(variants)]
    vocabulary = sorted({t for _, _, words in texts for t in words})
    found = F.array_intersect(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)), F.lit(vocabulary))
    # one row for all files and at most one per template term
    counted = files.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    df = {r.term: r.n for r in counted}
    n = df.get("", 0)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    units: dict[str, list[tuple[str, int, float]]] = defaultdict(list)
    for name, variant, words in texts:
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in words.items()))
        for t, k in words.items():
            units[t].append((name, variant, k * idf[t] / norm))
    return Weights(idf, math.log(1 + n) + 1, dict(units))


def notices(text: str, weights: Weights) -> list[tuple[float, float, int, str]]:
    """``cosine, share, -at, license`` of every passage that is near a template.

    Passages are sentences with a cue, the lines around each line with one, and the whole text. Terms
    are counted once per line; a block adds the counts of its few lines.
    """
    out = []

    def judge(counts: Counter[str], chars: int, at: int) -> None:
        out.extend((round(cosine, 9), chars / len(text), -at, name) for name, cosine in weights.best(counts))

    for at, sentence in enumerate(x for x in _SENTENCE.split(text) if _CUE.search(x)):
        judge(Counter(_terms(sentence)), len(sentence), at)
    lines = text.split("\n")
    counts = [Counter(_terms(line)) for line in lines]
    for at, line in enumerate(lines):
        if _CUE.search(line):
            for around in AROUND:
                low, high = max(0, at - around), at + around + 1
                block: Counter[str] = Counter()
                for part in counts[low:high]:
                    block.update(part)
                judge(block, sum(map(len, lines[low:high])), at)
    whole: Counter[str] = Counter()
    for part in counts:
        whole.update(part)
    judge(whole, sum(map(len, lines)), 0)
    return out


def own_licenses(files: DataFrame) -> DataFrame:
    """``path, license, cosine, is_file``: the best notice of each file that has one.

    ``is_file``: the file's name or the notice's share of its text makes it a license file.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    some = files.filter(text.rlike(CUE)).select("path", text.alias("text"))
    # repeated rows are one file; a path's different texts are several
    weights = corpus_weights(some.dropDuplicates(["path", "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            best = [max(notices(x, weights), default=None) for x in texts]
            at = [i for i, b in enumerate(best) if b is not None]
            columns = list(zip(*(best[i] for i in at), strict=True)) or [[]] * 4
            kinds = (pa.float64(), pa.float64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["path", "cosine", "share", "early", "license"],
            )

    found = some.mapInArrow(run, "path string, cosine double, share double, early bigint, license string")
    top = found.groupBy("path").agg(F.max(F.struct("cosine", "share", "early", "license")).alias("top"))
    return top.select(
        "path", F.col("top.license").alias("license"), F.col("top.cosine").alias("cosine"),
        ((F.col("top.share") >= FILE_SHARE) | F.col("path").rlike(FILE_NAME)).alias("is_file"),
    )


def directories(path: Column) -> Column:
    """``depth, dir`` of all directories above a path, the root (depth 0, empty) included."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("dir"))
    )


def scan(files: DataFrame) -> DataFrame:
    """``path, own_license, cosine, license, from_dir``, one row per distinct path.

    A file without a notice takes the license of the nearest directory above it that has a license
    file; of several in a directory the first path counts. NULL texts have no notice; NULL paths are
    left out; of files that share a path all notices count. An empty table gives an empty result. Only
    ``path`` and ``text`` are read.
    """
    named = files.filter("path IS NOT NULL")
    own = stored(own_licenses(named), "license-own")
    placed = own.filter("is_file").withColumn("dir", F.element_at(directories(F.col("path")), -1)["dir"])
    by_dir = stored(placed.groupBy("dir").agg(F.min(F.struct("path", "license")).alias("first")).select("dir", F.col("first.license").alias("dir_license")), "license-dirs")
    paths = named.select("path").distinct()
    bare = paths.join(own, "path", "left_anti").select("path", F.explode(directories(F.col("path"))).alias("up"))
    inherited = (
        bare.select("path", F.col("up.depth").alias("depth"), F.col("up.dir").alias("dir"))
        .join(by_dir, "dir")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "dir", "dir_license")).alias("near"))
    )
    return paths.join(own, "path", "left").join(inherited, "path", "left").select(
        "path",
        F.col("license").alias("own_license"),
        "cosine",
        F.coalesce("license", "near.dir_license").alias("license"),
        F.col("near.dir").alias("from_dir"),
    )
