"""Licence scans with DataFrame functions only: TF-IDF cosine to templates, then inheritance along paths.

Passages of a file are its lines that hold a term by which licences are told (of a licence file, the whole text) and its
paragraphs that hold one (of a licence file, the first of these, which is the title of a long text); CUE lists these terms:
every form has one, but for the bare words MIT and ISC, which mean other things where nothing else speaks of a licence. Equal passages are scored once;
a digest stands for their text in all joins. A passage and a form of a licence are sparse vectors of (1 + ln tf) * idf,
where idf = 1 + ln((1 + n) / (1 + df)) counts all distinct passages of the corpus. Each licence has several FORMS
(names, SPDX identifiers, headers, the short texts in full), of which the best counts; a passage takes the licence
of the largest cosine if that reaches LEAST, ties going to the smaller name. Years and holders of copyright notices
and the SPDX tag aren't compared. A file's own licence is that of its best passage, where `Proprietary` gives way to
any other, as notices of all kinds reserve rights. A licence file is one named so, or one of whose text the lines
with a cue make up half or more. A directory's licence is what most of its licence files have. A file without a
licence takes that of the nearest directory above it.

Defined cases: null or empty texts have no passage and can only inherit; a null path is the root; repeated
paths each count; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

#: Short forms by which licences are declared.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style 3-Clause license.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "EPL-2.0": "Made available under the terms of the Eclipse Public License 2.0.",
    "EUPL-1.2": "Licensed under the EUPL, Version 1.2.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "Copyright. All rights reserved. Unauthorized copying is prohibited.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "Released under the zlib License.",
}
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS"
_AS_IS_END = "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Copyright Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"


def _short(*names: str) -> tuple[str, ...]:
    """One-line declarations by a short name."""
    return tuple(form for n in names for form in (n, f"Released under {n}.", f"This code is under {n}.", f"License: {n}"))


def _gnu(name: str, short: str, version: int, date: str) -> tuple[str, ...]:
    spdx = f"{short}-{version}.0"
    terms = f"under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    return (
        f"GNU {name} Version {version}, {date}", f"GNU {name}, version {version}", f"GNU {name} v{version}.0", *_short(f"{short}v{version}", spdx), f"Licensed under the {short}v{version}", f"{spdx}-only", f"{spdx}-or-later", f"{spdx}+",
        f"it {terms}", f"This program is free software: you can redistribute it and/or modify it {terms}",
    )


def _cc(kind: str, name: str) -> tuple[str, ...]:
    return (*_short(f"CC-{kind}-4.0"), f"CC {kind} 4.0", f"Licensed under CC {kind} 4.0.", f"This work is licensed under a Creative Commons {name} 4.0 International License.", f"Creative Commons {name} 4.0 International Public License", f"{name} 4.0 International")


#: Other forms of the same licences; with their template, all that is compared.
FORMS = {
    k: (TEMPLATES[k], *more)
    for k, more in {
        "AGPL-3.0": _gnu("Affero General Public License", "AGPL", 3, "19 November 2007"),
        "Apache-2.0": (
            *_short("Apache-2.0"), "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "Apache License 2.0", "Apache License, Version 2.0", "Licensed under the Apache License 2.0",
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ),
        "BSD-2-Clause": (*_short("BSD-2-Clause"), "BSD 2-Clause License", f"{_BSD} {_BSD_END}"),
        "BSD-3-Clause": (*_short("BSD-3-Clause"), "BSD 3-Clause License", f"{_BSD} {_BSD_NAME} {_BSD_END}", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
        "BSL-1.0": (
            *_short("BSL-1.0"), "Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0",
            "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
        ),
        "CC-BY-4.0": _cc("BY", "Attribution"),
        "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial"),
        "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike"),
        "CC0-1.0": (*_short("CC0-1.0"), "CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal", "Creative Commons Legal Code"),
        "EPL-2.0": (*_short("EPL-2.0"), "Eclipse Public License - v 2.0", "Eclipse Public License 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
        "EUPL-1.2": (*_short("EUPL-1.2"), "European Union Public Licence v. 1.2", "EUROPEAN UNION PUBLIC LICENCE v. 1.2 EUPL © the European Union 2007, 2016", "Licensed under the EUPL", "Licensed under the EUPL, Version 1.2 or later"),
        "GPL-2.0": _gnu("General Public License", "GPL", 2, "June 1991"),
        "GPL-3.0": _gnu("General Public License", "GPL", 3, "29 June 2007"),
        "ISC": (
            "ISC", "ISC License",
            _ISC, f"Copyright {_ISC} THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ),
        "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", 3, "29 June 2007"),
        "MIT": (
            "MIT", "MIT License", "The MIT License (MIT)", "Licensed under the MIT License.",
            _MIT,
            f"MIT License Copyright {_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
            f"{_AS_IS} OR COPYRIGHT HOLDERS {_AS_IS_END}",
        ),
        "MPL-2.0": (*_short("MPL-2.0"), "Mozilla Public License Version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
        "Proprietary": ("All rights reserved.", "Copyright All rights reserved."),
        "Unlicense": (
            "Unlicense", "The Unlicense",
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
            f"{_AS_IS} {_AS_IS_END} For more information, please refer to <https://unlicense.org>",
        ),
        "Zlib": (*_short("Zlib"), "zlib License", "The zlib/libpng License", _ZLIB, f"{_ZLIB} 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    }.items()
}
#: The terms of the forms by which licences are told from other text: words of any place, and names that stand as words.
CUE = (
    r"(?i)licen[cs]|copyright|spdx|rights reserved|public domain|creative commons|permission (?:is|to)|redistribut|merchantab|noninfring|mozilla public|attribution[a-z-]* 4"
    r"|(?:^|[^\p{L}\p{N}])(?:cc[ -]by|cc0|[al]?gpl(?:v?[0-9][.0-9]*)?|gnu|apache|bsd|mpl|epl|eupl|bsl-1|zlib)(?:[^\p{L}\p{N}]|$)"
)
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"
TERM = "[a-z0-9]+(?:[.-][a-z0-9]+)*"
LEAST = 0.6
#: Directories with a licence, or distinct passages with one, up to which they are broadcast; more are joined by key.
BROADCAST_ROWS = 50_000
#: What isn't compared: the holder and years of a notice, the tag before an SPDX identifier.
_NOTICE = r"(?i)copyright\b(?:[^\n]*?(all rights reserved)|\s*(?:\(c\)|©|[12]\d{3})[^\n]*)"
_SPDX = r"(?i)spdx-license-identifier\s*:"
_PARAGRAPH = r"\n[^\p{L}\p{N}\n]*\n"


def _terms(text):
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _compared(passage):
    return F.regexp_replace(F.regexp_replace(passage, _NOTICE, "Copyright $1"), _SPDX, "")


def _weights(vectors: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """key, term, weight / norm."""
    tf = vectors.groupBy(key, "term").agg(F.count("*").alias("tf"))
    w = tf.join(idf, "term").withColumn("w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    return w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))).select(key, "term", "w")


def matches(passages: DataFrame) -> DataFrame:
    """passage_key, licence and score of the distinct passages (passage_key, passage) that reach LEAST by some form."""
    spark = passages.sparkSession
    distinct = staged(passages.groupBy("passage_key").agg(F.first("passage").alias("passage")), "passages")
    n = distinct.count()
    # The forms are constants of this module: some thousand rows.
    forms = [((k, i), t) for k, texts in sorted(FORMS.items()) for i, t in enumerate(texts)]
    templates = spark.createDataFrame(forms, "form struct<licence: string, k: int>, text string").select("form", F.explode(_terms(F.col("text"))).alias("term"))
    known = F.broadcast(templates.select("term").distinct())
    terms = distinct.select("passage_key", F.explode(_terms(F.col("passage"))).alias("term"))
    df = terms.distinct().groupBy("term").agg(F.count("*").alias("df"))
    value = 1 + F.log((1.0 + n) / (1.0 + F.coalesce(F.col("df"), F.lit(0))))
    idf_all = df.select("term", value.alias("idf"))
    idf_known = known.join(df, "term", "left").select("term", value.alias("idf"))
    ours = _weights(terms, "passage_key", idf_all)
    theirs = F.broadcast(_weights(templates, "form", idf_known).withColumnRenamed("w", "v"))
    cosine = ours.join(theirs, "term").groupBy("passage_key", "form").agg(F.round(F.sum(F.col("w") * F.col("v")), 6).alias("score"))
    best = cosine.groupBy("passage_key").agg(F.min(F.struct((-F.col("score")).alias("less"), F.col("form.licence").alias("licence"))).alias("best"))
    return best.select("passage_key", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score")).where(F.col("score") >= LEAST)


def _few(df: DataFrame, name: str) -> DataFrame:
    """df, written once, and broadcast in joins if it has few rows."""
    df = staged(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def scan(files: DataFrame) -> DataFrame:
    """file_id, path, licence, score, source (`own`, `inherited` or `none`) and found_in of every file; files has file_id, path and text."""
    rows = files.select("file_id", F.coalesce("path", F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    named = F.col("path").rlike(LICENCE_FILE)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(CUE))
    passages = F.transform(F.when(named, F.array("text")).otherwise(lines), lambda x: F.trim(x))
    mostly = F.aggregate("plain", F.lit(0), lambda n, x: n + F.length(x)) * 2 >= F.length("text")
    none = F.array().cast("array<string>")
    plain = F.coalesce(F.filter(passages, lambda x: F.length(x) > 0), none)
    dir_of = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    rows = rows.withColumn("named", named).withColumn("plain", plain)
    blocks = F.filter(F.split("text", _PARAGRAPH), lambda x: x.rlike(CUE))
    blocks = F.coalesce(F.when(F.col("named"), F.slice(blocks, 1, 1)).otherwise(blocks), none)
    compared = F.filter(F.array_distinct(F.transform(F.concat("plain", blocks), lambda x: F.trim(_compared(x)))), lambda x: F.length(x) > 0)
    # Texts without a cue have neither lines nor paragraphs: one search settles most of them.
    rows = rows.withColumn("passages", F.when(F.col("named") | F.col("text").rlike(CUE), compared).otherwise(none))
    is_file = F.col("named") | (F.size("plain") > 0) & mostly
    read = staged(rows.select("file_id", "path", dir_of.alias("dir"), is_file.alias("is_file"), "passages"), "licence-lines")

    each = read.select("file_id", "path", "dir", "is_file", F.explode("passages").alias("passage")).withColumn("passage_key", F.unhex(F.sha2("passage", 256)))
    found = each.drop("passage").join(_few(matches(each), "matches"), "passage_key")
    weak = F.col("licence") == "Proprietary"
    found = found.groupBy("file_id", "path", "dir", "is_file").agg(F.min(F.struct(weak.alias("weak"), (-F.col("score")).alias("less"), "licence")).alias("best"))
    own = staged(found.select("file_id", "path", "dir", "is_file", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("score")), "own-licences")

    votes = own.where("is_file").groupBy("dir", "licence").agg(F.count("*").alias("n"))
    of_dir = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("less"), "licence")).alias("best")).select("dir", F.col("best.licence").alias("dir_licence"))
    of_dir = _few(of_dir.withColumnRenamed("dir", "up"), "directory-licences")
    # Paths are resolved once for each directory, whatever the number of files in it.
    dirs = read.select("dir").distinct()
    parts = F.split("dir", "/")
    levels = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("up")))
    above = dirs.select("dir", F.explode(levels).alias("at")).select("dir", "at.depth", "at.up").dropDuplicates(["dir", "up"])
    nearest = above.join(of_dir, "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "dir_licence")).alias("near"))
    nearest = nearest.select("dir", F.col("near.up").alias("near_dir"), F.col("near.dir_licence").alias("near_licence"))

    all_files = read.select("file_id", "path", "dir").join(own.select("file_id", "path", "licence", "score"), ["file_id", "path"], "left").join(nearest, "dir", "left")
    source = F.when(F.col("licence").isNotNull(), "own").when(F.col("near_licence").isNotNull(), "inherited").otherwise("none")
    return all_files.select(
        "file_id", "path", F.coalesce("licence", "near_licence").alias("licence"), "score", source.alias("source"), F.when(source == "inherited", F.col("near_dir")).alias("found_in")
    )


def as_files(documents: DataFrame) -> DataFrame:
    """The documents as files of a tree: source / thousands of doc_id / doc_id."""
    k = F.col("doc_id").cast("long")
    path = F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("")), F.floor(k / 1000).cast("string"), F.concat(k.cast("string"), F.lit(".txt")))
    return documents.select(k.alias("file_id"), path.alias("path"), F.col("text"))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(as_files(table(spark, sf_dir, "documents"))).withColumnRenamed("file_id", "doc_id")
