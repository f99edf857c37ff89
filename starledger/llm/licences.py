"""Operator 1: licence scan by sparse TF-IDF cosine, with inheritance from the
nearest ancestor directory.

Notices: every line of a file, the whole text of a licence file (a file named
LICENSE, COPYING or the like), and windows of consecutive lines are compared
with the templates.  For a template of n terms a window starts at every line that
holds one of its terms (lines without any term, such as bare comment marks, don't
count) and goes on until it has n terms; where that isn't at a line's end it is
also tried without its last line.  So a header that is wrapped, indented or
commented is found wherever it stands, and a long licence text by its opening.
Weights are term frequency times 1000 * (ln((1 + files) / (1 + files with the term)) + 1),
rounded, with the term counts taken over all files; a term that no template has
counts as the rarest.  A file's own licence is that of its best notice of
cosine ``LEAST`` or more.

Inheritance: a licence file gives its directory its licence; a file without one
of its own takes that of the nearest directory above it, found by joining the
distinct directories' ancestor paths with the licensed directories.

Only notices that can reach ``LEAST`` are scored.  By Cauchy-Schwarz a notice's
cosine is at most the share of the template's norm that lies on terms of both.
So a notice that holds none of a template's anchors (what is left when its most
common terms are taken away, up to ``LEAST`` of its norm) stays below, and so
does a window whose lines together cover too little; neither is built.

DataFrame functions only; what the driver holds are the templates' terms.  Lines
and windows meet by stretches of ``STRETCH`` terms of one text, so a long text's
windows are many small groups.
Cases: a null text has no notice; a null path is a file at the root; repeated
rows of one path count as one file with all their notices; ties go to the
licence first in code-point order; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import written

LEAST = 0.75
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: lines are joined into windows by stretches of so many terms; no template is longer
STRETCH = 512
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-._][^/]*)?$"

# The customary notices, headers and texts of public licences, and
# the openings of those whose whole text is longer.
_WARRANTY = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for more details. You "
             "should have received a copy of the {0} along with this program. If not, see <https://www.gnu.org/licenses/>.")
_FREE = ("This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by "
         "the Free Software Foundation, either version {1} of the License, or (at your option) any later version.")
_LIBRARY = ("This library is free software; you can redistribute it and/or modify it under the terms of the {0} as published "
            "by the Free Software Foundation; either version {1} of the License, or (at your option) any later version.")
_VERBATIM = ("{0} Version {1} Copyright (C) {2} Free Software Foundation, Inc. Everyone is permitted to copy and distribute "
             "verbatim copies of this license document, but changing it is not allowed.")
_GPL, _LGPL, _AGPL = ("GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. ")
_MIT_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
              "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
              "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
              "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
              "DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: ")
_BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
            "conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. ")
_BSD_THREE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
              "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
              "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
              "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
              "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
              "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
              "DAMAGE.")
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", _FREE.format(_AGPL, 3)),
    ("AGPL-3.0", _FREE.format(_AGPL, 3) + " " + _WARRANTY.format(_AGPL)),
    ("AGPL-3.0", _VERBATIM.format(_AGPL, "3, 19 November 2007", 2007)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                   "REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD + _BSD_TWO + _BSD_AS_IS),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD),
    ("BSD-3-Clause", _BSD + _BSD_TWO + _BSD_THREE + _BSD_AS_IS),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _FREE.format(_GPL, 2)),
    ("GPL-2.0", _FREE.format(_GPL, 2) + " " + _WARRANTY.format(_GPL)),
    ("GPL-2.0", _VERBATIM.format(_GPL, "2, June 1991", "1989, 1991")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _FREE.format(_GPL, 3)),
    ("GPL-3.0", _FREE.format(_GPL, 3) + " " + _WARRANTY.format(_GPL)),
    ("GPL-3.0", _VERBATIM.format(_GPL, "3, 29 June 2007", 2007)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", _LIBRARY.format(_LGPL, 2.1)),
    ("LGPL-2.1", _VERBATIM.format(_LGPL, "2.1, February 1999", "1991, 1999")),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", _LIBRARY.format(_LGPL, 3)),
    ("LGPL-3.0", _FREE.format(_LGPL, 3)),
    ("LGPL-3.0", _VERBATIM.format(_LGPL, "3, 29 June 2007", 2007)),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction."),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_AS_IS),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
             "subject to the following restrictions:"),
]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def weight(files: int, holding: int) -> int:
    return math.floor(1000 * (math.log((1 + files) / (1 + holding)) + 1) + 0.5)


def anchors(vector: dict[str, int], least: float = LEAST, weights: dict[str, int] | None = None) -> set[str]:
    """The rarest terms (by ``weights``, else by their parts), one of which any
    notice of cosine ``least`` holds."""
    whole, left = sum(w * w for w in vector.values()), 0
    for i, t in enumerate(common := sorted(vector, key=lambda t: ((weights or vector)[t], t))):
        left += vector[t] * vector[t]
        if left >= least * least * whole * 0.999999:
            return set(common[i:])
    return set(vector)


def _windows(texts: DataFrame, vectors: list[tuple[int, str, dict[str, int]]], sizes: list[int], rare: list[set[str]],
             least: float) -> DataFrame:
    """texts (path, text) -> path, template, text: the windows that can be the
    template's notice."""
    spark = texts.sparkSession
    known = F.array(*[F.struct(F.lit(i).alias("template"), F.array(*map(F.lit, sorted(r))).alias("rare"))
                      for i, r in enumerate(rare)])
    found = F.filter(known, lambda k: F.arrays_overlap(k["rare"], F.col("all")))
    lines = (texts.distinct().withColumn("all", F.array_distinct(terms(F.col("text"))))
             .withColumn("possible", F.transform(found, lambda k: k["template"])).where(F.size("possible") > 0)
             .select("path", F.md5("text").alias("piece"), "possible", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .withColumn("terms", terms(F.col("line"))).withColumn("size", F.size("terms").cast("long")).where("size > 0"))
    before = Window.partitionBy("path", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    lines = written(lines.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))), "licence-lines")
    parts = spark.createDataFrame(
        [(i, sizes[i], sum(w * w for w in v.values()), t, w * w) for i, _, v in vectors for t, w in v.items()],
        "template int, n long, square long, term string, part long")
    covered = (lines.select("path", "piece", "at", "possible", F.explode(F.array_distinct("terms")).alias("term"))
               .join(F.broadcast(parts), "term").where(F.array_contains("possible", F.col("template")))
               .groupBy("path", "piece", "at", "template", "n", "square").agg(F.sum("part").alias("part")))
    # places in millionths of the template's length, so that one frame fits all: a little too much counts, never too little
    reach = (Window.partitionBy("path", "piece", "template").orderBy(F.expr("at * 1000000 div n"))
             .rangeBetween(Window.currentRow, 1_000_000))
    starts = (covered.withColumn("most", F.sum("part").over(reach))
              .where(F.col("most") >= F.lit(least * least * 0.999999) * F.col("square"))
              .select("path", "piece", "template", "n", F.col("at").alias("start"),
                      F.explode(F.expr(f"array(at div {STRETCH}, at div {STRETCH} + 1)")).alias("stretch")))
    meant = lines.select("path", "piece", "line", "at", (F.col("at") + F.col("size")).alias("end"),
                         F.expr(f"at div {STRETCH}").alias("stretch"))
    row = F.struct("at", "line")
    inside = F.when((F.col("end") <= F.col("start") + F.col("n")) | (F.col("at") == F.col("start")), row)
    both = (starts.join(meant, ["path", "piece", "stretch"]).where("at >= start AND at < start + n")
            .groupBy("path", "piece", "template", "start")
            .agg(F.collect_list(row).alias("until"), F.collect_list(inside).alias("within")))   # n lines at most
    texts_of = [F.array_join(F.transform(F.array_sort(c), lambda x: x["line"]), " ") for c in ("until", "within")]
    return both.select("path", "template", F.explode(F.array_distinct(F.array(*texts_of))).alias("text"))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, *, path_col: str = "path",
         text_col: str = "text", least: float = LEAST) -> DataFrame:
    """path, own_license, own_score, license, licensed_by (the directory that
    gave it), levels_up; one row per path."""
    spark = files.sparkSession
    files = files.select(F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.col(text_col).alias("text"))
    counted = [(name, Counter(re.findall(TERM, text.lower()))) for name, text in templates]
    vocabulary = sorted({t for _, c in counted for t in c})
    held = F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, vocabulary)))
    stats = (files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(held, F.array().cast("array<string>")))).alias("term"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect())  # a row per term of the templates
    holding = {r["term"]: r["n"] for r in stats}
    n = holding.get("", 0)
    weights = {t: weight(n, holding.get(t, 0)) for t in vocabulary}
    vectors = [(i, name, {t: tf * weights[t] for t, tf in c.items()}) for i, (name, c) in enumerate(counted)]
    sizes = [sum(c.values()) for _, c in counted]
    if max(sizes, default=0) > STRETCH:
        raise ValueError(f"a template has more than {STRETCH} terms")
    rare = [anchors(v, least, weights) for _, _, v in vectors]
    heavy = F.array(*map(F.lit, sorted(set().union(*rare))))

    text = F.col("text")
    licence_file = F.col("path").rlike(LICENCE_NAME)
    hopeful = files.where(F.arrays_overlap(terms(text), heavy))
    plain = hopeful.select("path", F.lit(-1).alias("of"), F.explode(F.concat(F.split(text, "\n"), F.when(
        licence_file, F.array(text)).otherwise(F.array().cast("array<string>")))).alias("text"))
    windows = _windows(hopeful, vectors, sizes, rare, least).withColumnRenamed("template", "of")
    # a notice goes on under its digest: its terms must not each carry (or hash) the text; a window is for its own template
    units = (plain.unionByName(windows).select("path", "of", "text", F.md5("text").alias("notice")).distinct()
             .withColumn("terms", terms(F.col("text"))).where(F.arrays_overlap("terms", heavy)))
    unit = ["path", "of", "notice"]
    counts = units.select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("tf"))
    known = spark.createDataFrame(list(weights.items()), "term string, weight long")
    # the terms of the notices that can be licences; read twice below
    weighed = written(counts.join(F.broadcast(known), "term", "left")
                      .withColumn("w", F.col("tf") * F.coalesce("weight", F.lit(weight(n, 0)))), "licence-terms")
    template = spark.createDataFrame(
        [(i, name, sum(w * w for w in v.values()), t, w) for i, name, v in vectors for t, w in v.items()],
        "template int, license string, square long, term string, part long")
    norms = weighed.groupBy(*unit).agg(F.sum(F.col("w") * F.col("w")).alias("own_square"))
    dots = (weighed.join(F.broadcast(template), "term").where("of IN (-1, template)")
            .groupBy(*unit, "template", "license", "square").agg(F.sum(F.col("w") * F.col("part")).alias("dot")))
    score = F.col("dot").cast("double") / (F.sqrt(F.col("own_square").cast("double")) * F.sqrt(F.col("square").cast("double")))
    own = written(
        dots.join(norms, unit).withColumn("own_score", score).where(F.col("own_score") >= least)
        .groupBy("path").agg(F.min(F.struct((-F.col("own_score")).alias("s"), "license")).alias("best"))
        .select("path", F.col("best.license").alias("own_license"), (-F.col("best.s")).alias("own_score")), "licence-own")

    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    given = (own.where(licence_file).withColumn("dir", folder).groupBy("dir")
             .agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own_license").alias("license"))).alias("best"))
             .select(F.col("dir").alias("licensed_by"), F.col("best.license").alias("dir_license")))
    paths = files.select("path").distinct().withColumn("dir", folder)
    steps = F.split(F.col("dir"), "/")
    above = F.concat(F.array(F.lit("")), F.when(F.col("dir") != "", F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).otherwise(
            F.array().cast("array<string>")))
    nearest = (paths.select("dir").distinct().withColumn("above", above)
               .select("dir", F.posexplode("above").alias("depth", "licensed_by"), (F.size("above") - 1).alias("deep"))
               .join(given, "licensed_by").groupBy("dir")
               .agg(F.max(F.struct("depth", "licensed_by", "dir_license", "deep")).alias("g"))
               .select("dir", "g.licensed_by", "g.dir_license", (F.col("g.deep") - F.col("g.depth")).alias("up")))
    inherits = F.col("own_license").isNull()
    return (paths.join(own, "path", "left").join(nearest, "dir", "left")
            .select("path", "own_license", "own_score", F.coalesce("own_license", "dir_license").alias("license"),
                    F.when(inherits, F.col("licensed_by")).alias("licensed_by"),
                    F.when(inherits, F.col("up")).alias("levels_up")))
