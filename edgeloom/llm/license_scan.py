"""License scans: templates found in overlapping windows of whole texts.

A text is a sequence of words (letters and digits, lower case), five words make a
shingle. Templates are partitioned by shingle count into classes with an upper bound
``U``, and a window of a class holds ``U + U/4`` shingles, one window starting every
``U/4``, so whatever stretch of ``U`` shingles a template fills lies inside a window.
MinHash bands of a window retrieve templates; a template found is verified by exact
containment of its shingles in the text.

Windows without a single shingle of any template have similarity 0 to all of them, and
no band value of theirs could agree; they are left out before bands are computed. All of
it is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import free_name, without, written

WORDS = 5
CONTAINMENT = 0.8
#: A window misses a template of its class with at most this probability.
MISS = 0.001
#: Shingles over all templates, which every task holds (8 bytes each).
MAX_SHINGLES = 100_000

# --- Fixed values: wording of common licenses and license notices. ---
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
_GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
_GNU_HOPE = (
    " This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details."
)
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                         "this file except in compliance with the License.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                         "this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                         "to in writing, software distributed under the License is distributed on an \"AS IS\" "
                         "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
                         "License for the specific language governing permissions and limitations under the License.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the Software "
                 "without restriction",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                "furnished to do so, subject to the following conditions: The above copyright notice and this "
                "permission notice shall be included in all copies or substantial portions of the Software. "
                + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
                "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
                "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
                "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
                "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
                "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
                "PERFORMANCE OF THIS SOFTWARE.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: " + _GNU.format("General Public License"),
    "gpl-2.0-header": "This program is free software; " + _GNU.format("General Public License")
                      + "; either version 2 of the License, or (at your option) any later version."
                      + _GNU_HOPE.format("program", "General Public License"),
    "gpl-3.0-header": "This program is free software: " + _GNU.format("General Public License")
                      + ", either version 3 of the License, or (at your option) any later version."
                      + _GNU_HOPE.format("program", "General Public License"),
    "lgpl-2.1-header": "This library is free software; " + _GNU.format("Lesser General Public License")
                       + "; either version 2.1 of the License, or (at your option) any later version."
                       + _GNU_HOPE.format("library", "Lesser General Public License"),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": "This program is free software: " + _GNU.format("Affero General Public License")
                       + ", either version 3 of the License, or (at your option) any later version."
                       + _GNU_HOPE.format("program", "Affero General Public License"),
    "gfdl-1.3": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU "
                "Free Documentation License, Version 1.3 or any later version published by the Free Software "
                "Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "bsd-2-clause-text": _BSD + _BSD_DISCLAIMER,
    "bsd-3-clause-text": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may "
                         "be used to endorse or promote products derived from this software without specific prior "
                         "written permission. " + _BSD_DISCLAIMER,
    "bsd-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                      "of the MPL was not distributed with this file, You can obtain one at "
                      "http://mozilla.org/MPL/2.0/.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
               "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the "
                 "authors be held liable for any damages arising from the use of this software. Permission is granted "
                 "to anyone to use this software for any purpose, including commercial applications, and to alter it "
                 "and redistribute it freely, subject to the following restrictions: 1. The origin of this software "
                 "must not be misrepresented; you must not claim that you wrote the original software. If you use "
                 "this software in a product, an acknowledgment in the product documentation would be appreciated but "
                 "is not required. 2. Altered source versions must be plainly marked as such, and must not be "
                 "misrepresented as being the original software. 3. This notice may not be removed or altered from "
                 "any source distribution.",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to "
                      "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
                      "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring "
               "rights to this software to the public domain worldwide. This software is distributed without any "
               "warranty.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                         "License.",
    "cc-by-nc-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                         "License.",
    "cc-by-nd-4.0-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
                         "License.",
    "wtfpl-2": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, "
               "and changing it is allowed as long as the name is changed.",
    "artistic-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the "
                    "Artistic License 2.0.",
    "psf-2.0": "Licensed to PSF under a Contributor Agreement.",
    "all-rights": "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    "proprietary": "This software is the confidential and proprietary information of its owner. You shall not "
                   "disclose such confidential information and shall use it only in accordance with the terms of "
                   "the license agreement you entered into",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl-2.0": "SPDX-License-Identifier: GPL-2.0-only",
}
# --------------------------------------------------------


def _words(text: Column) -> Column:
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)
    )


def _shingles(words: str) -> Column:
    """One hash per run of five words; null for fewer words."""
    last = F.size(words) - WORDS
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(WORDS)]
    )))


def bands_for(shingles: int, width: int, containment: float = CONTAINMENT) -> int:
    """Bands of one row that make a miss as rare as ``MISS``.

    The least Jaccard similarity of a template of ``shingles`` and a window of ``width``
    that holds ``containment`` of it.
    """
    shared = ceil(containment * shingles)
    similarity = shared / (width + shingles - shared)
    return 1 if similarity >= 1 else ceil(log(MISS) / log(1 - similarity))


def _classes(sizes: list[int]) -> dict[int, tuple[int, int, int]]:
    """Width, stride and bands of each class; a class is the exponent of its upper bound."""
    found: dict[int, tuple[int, int, int]] = {}
    for size in sizes:
        level = (size - 1).bit_length()
        upper = 1 << level
        stride = max(upper // 4, 1)
        # Up to four shingles a window starts everywhere and need not be wider.
        width = upper if stride == 1 else upper + stride
        bands = max(bands_for(size, width), found.get(level, (0, 0, 0))[2])
        found[level] = (width, stride, bands)
    return found


def _minima(shingles: Column, bands: int) -> Column:
    """The least of the shingles' hashes under each of ``bands`` functions."""
    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda x: F.xxhash64(F.lit(seed), x)))

    return F.array(*[least(k) for k in range(bands)])


def scan_templates(docs: DataFrame, templates: Mapping[str, str], text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``template``, ``n_shingles``, ``n_found``, ``containment``.

    One row per row of ``docs`` and template of which it holds ``CONTAINMENT`` of the
    distinct shingles. Null, empty and short texts hold none; a template of fewer than
    five words has no shingle and raises. Repeated rows give repeated results.
    Columns of ``docs`` with the names above are replaced.

    ``templates`` are bounded by ``MAX_SHINGLES`` and become literals of the plan.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame(list(templates.items()), "template string, text string")
    known = {
        r["template"]: sorted(r["shingles"])
        for r in given.select("template", _words(F.col("text")).alias("words"))
        .select("template", F.array_distinct(_shingles("words")).alias("shingles"), "words")
        .where("shingles IS NOT NULL").collect()
    }
    if missing := set(templates) - set(known):
        raise ValueError(f"fewer than {WORDS} words: {sorted(missing)}")
    vocabulary = sorted({x for own in known.values() for x in own})
    if len(vocabulary) > MAX_SHINGLES:
        raise ValueError(f"{len(vocabulary)} shingles in templates; at most {MAX_SHINGLES}")
    out = ("template", "n_shingles", "n_found", "containment")
    keep = without(docs, text, *out)
    words, runs, at = (free_name(n, docs.columns) for n in ("words", "runs", "at"))

    # Texts with a shingle of a template, and where they have it. The generator of one row
    # keeps the filter above the shingles; pushed below, it would hold their expression.
    row = free_name("row", docs.columns)
    sketched = docs.select(*keep, _words(F.col(text)).alias(words)).select(
        *keep, F.inline(F.array(F.struct(_shingles(words).alias(runs))))
    )
    place = F.filter(
        F.transform(runs, lambda x, i: F.when(x.isin(vocabulary), i)), lambda i: i.isNotNull()
    )
    marked = written(
        sketched.where(F.arrays_overlap(runs, F.array(*[F.lit(x) for x in vocabulary])))
        .select(*keep, runs, place.alias(at), F.monotonically_increasing_id().alias(row)),
        "license-marked",
    )
    classes = _classes([len(own) for own in known.values()])
    probes = [_probes(marked, runs, at, row, level, *shape) for level, shape in classes.items()]
    keys = _template_bands(docs, known, classes)
    candidates = _union(probes).join(F.broadcast(keys), ["level", "band", "value"]).select(
        F.col("row").alias(row), "template"
    ).distinct()
    exact = spark.createDataFrame(
        [(name, own) for name, own in known.items()], "template string, own array<bigint>"
    )
    found = F.size(F.array_intersect("own", runs))
    return (
        marked.join(candidates, row).join(F.broadcast(exact), "template")
        .withColumn("n_shingles", F.size("own").cast("long"))
        .withColumn("n_found", found.cast("long"))
        .where(F.col("n_found") >= CONTAINMENT * F.col("n_shingles"))
        .select(*keep, "template", "n_shingles", "n_found",
                (F.col("n_found") / F.col("n_shingles")).alias("containment"))
    )


def _probes(marked, runs, at, row, level: int, width: int, stride: int, bands: int) -> DataFrame:
    """``(row, level, band, value)`` of the windows that hold a shingle of a template."""
    back = (width - 1) // stride
    first = F.array_distinct(F.flatten(F.transform(at, lambda p: F.transform(
        F.sequence(F.floor(p / stride) - back, F.floor(p / stride)),
        lambda w: F.greatest(w, F.lit(0)).cast("int"),
    ))))
    windows = marked.select(row, runs, F.explode(first).alias("window")).select(
        F.col(row).alias("row"),
        F.slice(runs, F.col("window") * stride + 1, F.lit(width)).alias("inside"),
    )
    return windows.select(
        "row", F.lit(level).alias("level"),
        F.posexplode(_minima(F.col("inside"), bands)).alias("band", "value"),
    )


def _template_bands(docs: DataFrame, known: Mapping[str, list[int]], classes: Mapping) -> DataFrame:
    """``(level, band, value, template)``: as many rows as templates have bands."""
    rows = [(name, (len(own) - 1).bit_length(), own) for name, own in known.items()]
    given = docs.sparkSession.createDataFrame(rows, "template string, level int, own array<bigint>")
    return _union([
        given.where(F.col("level") == level).select(
            "level", "template",
            F.posexplode(_minima(F.col("own"), shape[2])).alias("band", "value"),
        )
        for level, shape in classes.items()
    ])


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def license_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``license``, ``n_shingles``, ``n_found``, ``containment`` for every notice found."""
    return scan_templates(docs.select("doc_id", "text"), NOTICES).withColumnRenamed(
        "template", "license"
    )
