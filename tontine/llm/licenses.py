"""License scans: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance.

Everything is DataFrame expressions. Comment marks are taken off the lines, and blank lines part
the text into paragraphs. Of every paragraph that mentions a licence the units compared are: its
lines that do, its sentences that do (over line breaks, so a wrapped notice is one unit), and the
paragraph; of a file with a licence file's name also the whole text. Equal units are scored
once. A unit is the sparse vector of its terms, weighted (1 + ln tf) * idf, with
idf = ln((1 + n) / (1 + df)) + 1 over the ``n`` templates alone, so a notice scores the same however
often the corpus has it; terms of no template count with df 0. A unit names the template with the
largest cosine, if that reaches ``threshold``; a file takes the licence of its weightiest unit, by
score times the root of its number of distinct terms, so a full text outweighs a line in it.

A licence file, by name or because one unit is half of its text or more, speaks for its
directory (the licence most of its licence files name). Files without a licence of their own take
that of the nearest directory above that has one: every directory is joined to its ancestors
by path, so the join is as large as the directory tree, not the files.

Defined results: null text or path: empty; no licence: nulls; ties go to the smaller template id;
rows are judged one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm.common import materialize

THRESHOLD, SHARE = 0.5, 0.5
MENTIONS = (r"(?i)licen[cs]e|copyright|copyleft|spdx|permission is hereby granted|permission to use|redistribution and use|redistributions of source"
            r"|free software|public domain|creative commons|all rights reserved")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)[^/]*$"
#: What stands around the words of a line: blanks and the marks of comments.
MARKS = r"\A[ \t\r\f/*#;%<!>-]+|[ \t\r\f/*>-]+\z"
PARAGRAPH, SENTENCE = "\n\n+", "[.;!?]+ +"

_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
          "permission. ")
_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
               "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
               "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
               "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
               "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.")
_GPL = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
#: Licence texts and notices as their licences word them (fixed values), by SPDX id; several rows may share an id.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("BSD-2-Clause", _BSD + _DISCLAIMER),
    ("BSD-3-Clause", _BSD + _NAMES + _DISCLAIMER),
    ("BSD-3-Clause", _NAMES),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 public domain dedication"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2"),
    ("GPL-2.0", "This program is free software; " + _GPL.format("", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: " + _GPL.format("", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", _ISC),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "This library is free software; " + _GPL.format("Lesser ", "2.1")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Released under the MIT License"),
    ("MIT", _MIT),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without permission"),
    ("Proprietary", "All rights reserved"),
    ("PSF-2.0", "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Identifiers as SPDX lines have them (fixed values), with the licence that they name.
SPDX_IDS = (
    ("0BSD", "0BSD"), ("Apache-2.0", "Apache-2.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"),
    ("CC0-1.0", "CC0-1.0"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"), ("ISC", "ISC"),
    ("LGPL-2.1", "LGPL-2.1-only"), ("LGPL-2.1", "LGPL-2.1-or-later"), ("LGPL-3.0", "LGPL-3.0-only"), ("LGPL-3.0", "LGPL-3.0-or-later"), ("MIT", "MIT"), ("MPL-2.0", "MPL-2.0"),
    ("PSF-2.0", "PSF-2.0"), ("Unlicense", "Unlicense"), ("Zlib", "Zlib"),
)
TEMPLATES = TEMPLATES + tuple((licence, f"SPDX-License-Identifier: {name}") for licence, name in SPDX_IDS)


def terms_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def directory(path: Column) -> Column:
    """The directory of a file; the root is the empty string."""
    return F.regexp_extract(path, "(?s)^(.*)/[^/]*$", 1)


def ancestors(path: Column) -> Column:
    """A directory and all above it, as an array of (depth, dir)."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("dir")))
    return F.when(path == "", F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("dir")))).otherwise(
        F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("dir"))), F.filter(above, lambda a: a["dir"] != "")))


def template_frame(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(templates)], "template int, license string, body string")


def units_of(text: Column) -> Column:
    """The units of a text: what its paragraphs that mention a licence hold, distinct."""
    clean = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, MARKS, "")), "\n")
    marked = lambda xs: F.filter(xs, lambda x: x.rlike(MENTIONS))
    flat = lambda p: F.translate(p, "\n", " ")

    def of(paragraphs: Column) -> Column:
        lines = F.flatten(F.transform(paragraphs, lambda p: marked(F.split(p, "\n"))))
        sentences = F.flatten(F.transform(paragraphs, lambda p: marked(F.split(flat(p), SENTENCE))))
        return F.array_distinct(F.concat(lines, sentences, F.transform(paragraphs, flat)))
    # a list of one, so that the paragraphs are found once; most texts mention nothing and are not split
    found = F.transform(F.array(marked_paragraphs(clean)), of)
    return F.when(text.rlike(MENTIONS), F.get(found, F.lit(0))).otherwise(F.array().cast("array<string>"))


def marked_paragraphs(clean: Column) -> Column:
    return F.filter(F.split(clean, PARAGRAPH), lambda p: F.translate(p, "\n", " ").rlike(MENTIONS))


def score_units(units: DataFrame, templates: DataFrame) -> DataFrame:
    """``(unit, body)``, distinct units -> ``(unit, license, score, mass)``: the best template of every
    unit, and the score times the root of the unit's number of distinct terms."""
    tf = materialize(units.select("unit", F.explode(terms_of(F.col("body"))).alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf")), "terms")
    ttf = templates.select("template", "license", F.explode(terms_of(F.col("body"))).alias("term")).groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))
    n = templates.agg(F.count(F.lit(1)).alias("n"))
    df = ttf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = materialize(df.crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")), "idf")
    rarest = n.select((F.log((1 + F.col("n")) / F.lit(1)) + 1).alias("rarest"))  # one row: terms of no template
    weight = (1 + F.log("tf")) * F.col("idf")
    t = ttf.join(idf, "term").select("template", "license", "term", weight.alias("tw"))
    t = t.join(t.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm")), "template")
    # the templates and their terms are a short fixed list
    w = tf.join(F.broadcast(idf), "term", "left").crossJoin(F.broadcast(rarest)).select("unit", "term", ((1 + F.log("tf")) * F.coalesce("idf", "rarest")).alias("w"))
    norm = w.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.count(F.lit(1)).alias("terms"))
    dot = w.join(F.broadcast(t), "term").groupBy("unit", "template", "license", "tnorm").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cos = dot.join(norm, "unit").select("unit", "template", "license", "terms", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 6).alias("score"))
    best = cos.groupBy("unit").agg(F.max(F.struct("score", (-F.col("template")).alias("o"), "license", "terms")).alias("b"))
    return best.select("unit", "b.license", "b.score", F.round(F.col("b.score") * F.sqrt("b.terms"), 6).alias("mass"))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = (), templates=TEMPLATES,
         threshold: float = THRESHOLD, share: float = SHARE) -> DataFrame:
    """Per row of ``files``: the ``keep`` columns, ``path``, ``own_license``, ``own_score`` (the
    licence its units name), ``license`` (own or inherited) and ``inherited_from`` (a directory)."""
    spark = files.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    named = path.rlike(LICENCE_FILE)
    units = units_of(text)
    src = files.select(F.monotonically_increasing_id().alias("__row"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
                       path.alias("path"), F.length(text).alias("chars"), named.alias("named"),
                       F.when(named & (text != ""), F.array_distinct(F.concat(units, F.array(text)))).otherwise(units).alias("units"))
    rows = materialize(src, "files")
    each = rows.where(F.size("units") > 0).select("__row", F.explode("units").alias("body")).withColumn("unit", F.md5("body"))
    scored = materialize(score_units(each.groupBy("unit").agg(F.min("body").alias("body")), template_frame(spark, templates))
                         .where(F.col("score") >= threshold), "units")
    own = (each.select("__row", "unit", F.length("body").alias("len")).join(scored, "unit").groupBy("__row")
           .agg(F.max_by(F.struct("license", "score"), F.struct("mass", "score", "unit")).alias("b"), F.max("len").alias("covered")))
    got = materialize(rows.drop("units").join(own, "__row", "left").select(
        "__row", *[f"__k{i}" for i in range(len(keep))], "path", directory(F.col("path")).alias("dir"), F.col("b.license").alias("own_license"), F.col("b.score").alias("own_score"),
        (F.col("b").isNotNull() & (F.col("named") | (F.col("covered") >= share * F.col("chars")))).alias("speaks")), "own")
    speak = (got.where("speaks").groupBy("dir", "own_license").count().groupBy("dir")
             .agg(F.max_by("own_license", F.struct("count", "own_license")).alias("license")))
    up = got.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select(F.col("dir").alias("below"), "a.depth", "a.dir")
    near = up.join(speak, "dir").groupBy("below").agg(F.max(F.struct("depth", "dir", "license")).alias("b"))
    near = near.select(F.col("below").alias("dir"), F.col("b.license").alias("from_license"), F.col("b.dir").alias("from_dir"))
    return got.join(near, "dir", "left").select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "path", "own_license", "own_score",
        F.coalesce("own_license", "from_license").alias("license"), F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("inherited_from"))
