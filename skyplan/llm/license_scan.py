"""Licence scan: TF-IDF cosine to templates, then inheritance by directory
(operator 2).

Terms are runs of digits, letters (A-Z lower-cased) and bytes over 0x7F. The
units of a file are
  - its header: the lines before the first one without a term, but for those
    that begin with "copyright",
  - the file as a whole, if it has a licence file's name,
  - its notices: every run of as many terms as a template has (the whole
    text, if it is shorter), wherever it stands.
A unit is compared with every template by the cosine of their TF-IDF vectors,
sparse over the templates' terms; terms that no template has count in the
unit's length. Document frequencies of the template terms are counted over
all files. A unit matches if its cosine is at least min_score, it holds all
terms that the template requires (a licence's name or number, where licences
differ in nothing else), and it and its surroundings hold none that rules the
template out (a neighbour's name, a further clause) and all that must be near.
Of the matches whose cosine is within `margin` of the best one, that of the
longest unit is the file's own licence, so that a whole text or a grant counts
for more than a phrase in it; ties go to the better cosine, the first
template, then header, file, notice, then the earliest notice. "All rights
reserved" is a licence only where nothing else matches and no word of a grant
follows.

No unit is skipped that could match: a cosine is at most the norm of the part
of the template whose terms the text holds, and at most the product divided
by the norm that a run without repeated terms has; runs of which these bounds
reach min_score are scored one by one.

A licence file is one with a licence file's name, or one of which the matched
unit holds at least half of the terms. Its licence holds for its directory
(several: best score, then least path), and files without an own licence
inherit from the nearest ancestor directory that has one. Ancestors are made
from the distinct directories, not from the files, so the join of paths is
small and no directory's files meet in one task.

Defined results: null text has no unit; null path is the root directory's
unnamed file; files that repeat count as many; no template, or an empty table,
gives no licence; other columns pass through untouched, but for the text.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, slices, utf8, words_of, written

#: SPDX ids, the names that notices use, the terms that such a
#: notice must hold, and terms that rule it out, for they name a neighbour.
_NOT_GPL, _NOT_CC = "lesser library affero", "sa sharealike nc noncommercial nd noderivatives"
NAMES = {
    "MIT": (("MIT License", "MIT license agreement"), "mit", ""),
    "Apache-2.0": (("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"), "apache 2", ""),
    "GPL-2.0": (("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2"), "2|v2|gplv2", _NOT_GPL),
    "GPL-3.0": (("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3"), "3|v3|gplv3", _NOT_GPL),
    "LGPL-2.1": (("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"), "lesser|lgplv2 1", ""),
    "LGPL-3.0": (("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"), "lesser|lgplv3 3|v3|lgplv3", ""),
    "AGPL-3.0": (("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"), "affero|agplv3 3|v3|agplv3", ""),
    "BSD-2-Clause": (("BSD 2-Clause License", "Simplified BSD License"), "bsd 2|simplified", ""),
    "BSD-3-Clause": (("BSD 3-Clause License", "New BSD License"), "bsd 3|new", ""),
    "0BSD": (("BSD Zero Clause License", "Zero-Clause BSD License"), "bsd zero", ""),
    "MPL-2.0": (("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"), "mozilla 2", ""),
    "EPL-2.0": (("Eclipse Public License, version 2.0", "Eclipse Public License 2.0"), "eclipse 2", ""),
    "BSL-1.0": (("Boost Software License, Version 1.0", "Boost Software License 1.0"), "boost", ""),
    "Zlib": (("zlib License", "zlib/libpng License"), "zlib", ""),
    "ISC": (("ISC License",), "isc", ""),
    "CC0-1.0": (("Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal license"), "cc0", ""),
    "CC-BY-4.0": (("Creative Commons Attribution 4.0 International License", "CC BY 4.0"), "by|attribution 4", _NOT_CC),
    "CC-BY-SA-4.0": (("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"), "sa|sharealike 4", "nc noncommercial nd noderivatives"),
    "CC-BY-NC-4.0": (("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"), "nc|noncommercial 4", "sa sharealike nd noderivatives"),
    "CC-BY-ND-4.0": (("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"), "nd|noderivatives 4", "nc noncommercial"),
    "CC-BY-NC-SA-4.0": (("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"), "nc|noncommercial sa|sharealike 4", ""),
    "CC-BY-NC-ND-4.0": (("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0"), "nc|noncommercial nd|noderivatives 4", ""),
}
#: Sentences that name a licence.
SENTENCES = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "This project is licensed under the terms of the {}.")
#: Parts of licence texts.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
_MIT_RIGHTS = _MIT_GRANT + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
_MIT_TEXT = _MIT_RIGHTS + (
    ": The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = _BSD_GRANT + (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THREE = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TERMS = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GNU = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
    "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
)
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_UNLICENSE_TEXT = _UNLICENSE + " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
#: Grants, notices, whole texts of the short licences and the openings of the
#: long ones: licence, text, terms that it must hold, terms that rule it out
#: where it stands, terms that must stand there, and how many terms after it
#: are looked at for those.
GRANTS = (
    ("MIT", _MIT_GRANT, "", "", "", 0),
    ("MIT", _MIT_RIGHTS, "", "", "", 0),
    ("MIT", _MIT_TEXT, "", "", "", 0),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2", "", "", 0),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "apache 2", "", "", 0),
    ("GPL-3.0", _GNU.format("program", ":", "General Public License", ",", "3"), "3", _NOT_GPL, "", 0),
    ("GPL-2.0", _GNU.format("program", ";", "General Public License", ";", "2"), "2", _NOT_GPL, "", 0),
    ("LGPL-3.0", _GNU.format("library", ";", "Lesser General Public License", ";", "3"), "lesser 3", "", "", 0),
    ("LGPL-2.1", _GNU.format("library", ";", "Lesser General Public License", ";", "2.1"), "lesser 2 1", "", "", 0),
    ("AGPL-3.0", _GNU.format("program", ":", "Affero General Public License", ",", "3"), "affero 3", "", "", 0),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "3 2007", _NOT_GPL, "", 0),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "2 1991", _NOT_GPL, "", 0),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "lesser 3 2007", "", "", 0),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "lesser 2 1999", "", "", 0),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "affero 3 2007", "", "", 0),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla", "", "", 0),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "eclipse 2", "", "", 0),
    ("BSD-2-Clause", _BSD_GRANT, "", "endorse promote", "", 200),
    ("BSD-2-Clause", _BSD_TWO, "", "endorse promote", "", 120),
    ("BSD-2-Clause", _BSD_TWO + _BSD_DISCLAIMER, "", "endorse promote", "", 20),
    ("BSD-3-Clause", _BSD_GRANT, "", "", "endorse promote", 200),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THREE, "endorse", "", "", 0),
    ("BSD-3-Clause", _BSD_TWO + _BSD_THREE + _BSD_DISCLAIMER, "endorse", "", "", 0),
    ("ISC", _ISC_GRANT + _ISC_TERMS, "provided appear", "", "", 0),
    ("ISC", _ISC_GRANT + _ISC_TERMS + _ISC_DISCLAIMER, "appear", "", "", 0),
    ("0BSD", _ISC_GRANT + ".", "", "appear copies", "", 20),
    ("0BSD", _ISC_GRANT + "." + _ISC_DISCLAIMER, "", "appear copies", "", 0),
    ("Zlib", _ZLIB, "restrictions", "", "", 0),
    ("BSL-1.0", _BOOST, "organization transmit", "", "", 0),
    ("Unlicense", _UNLICENSE, "unencumbered", "", "", 0),
    ("Unlicense", _UNLICENSE_TEXT, "unencumbered", "", "", 0),
    ("LicenseRef-AllRightsReserved", "All rights reserved.", "rights reserved", "permission permitted redistribution granted licensed license licence", "", 200),
)
#: No licence of a file that matches another.
WEAK = {"LicenseRef-AllRightsReserved"}
#: How many terms before and after a unit are its surroundings, at least.
AROUND = 3


@dataclass(frozen=True)
class Template:
    licence: str
    text: str
    #: Terms that a match must hold; of a|b either one.
    required: str = ""
    #: Terms of which a match and its surroundings must hold none.
    never: str = ""
    #: Terms of which a match and its surroundings must hold all.
    near: str = ""
    #: How many terms after a match its surroundings are.
    beyond: int = 0


def templates_of(names: dict[str, tuple[tuple[str, ...], str, str]] = NAMES, grants: tuple[tuple, ...] = GRANTS) -> tuple[Template, ...]:
    """A tag and the sentences for each name of each licence, then the grants."""
    out = []
    for licence, (spoken, required, never) in names.items():
        own = " ".join(w.decode() for w in words_of(licence.encode()))
        out.append(Template(licence, f"SPDX-License-Identifier: {licence}", f"spdx {own}", never))
        out += [Template(licence, sentence.format(name), required, never) for name in spoken for sentence in SENTENCES]
    return tuple(out) + tuple(Template(*g) for g in grants)


TEMPLATES = templates_of()
UNITS = ("header", "file", "notice")
_NAME = r"^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
_OWN_SQL = "struct<licence:string,score:double,unit:string,matched:long,words:long>"
_OWN = pa.struct([("licence", pa.string()), ("score", pa.float64()), ("unit", pa.string()), ("matched", pa.int64()), ("words", pa.int64())])


class Scanner:
    """Templates as unit vectors over their terms."""

    def __init__(self, templates: tuple[Template, ...], n_files: int, frequency: dict[bytes, int], min_score: float, margin: float = 0.1):
        self.min_score, self.margin, self.templates = min_score, margin, templates
        texts = [words_of(t.text.encode()) for t in templates]
        self.sizes = [len(t) for t in texts]
        self.vocab = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t), 1)}
        rare = float(np.log(1.0 + n_files) + 1)
        #: Of each term; at 0 that of a term that no template has.
        self.idf = np.array([rare] + [float(np.log((1 + n_files) / (1 + frequency.get(w, 0))) + 1) for w in self.vocab])
        self.table = np.zeros((len(texts), len(self.idf)))
        for k, t in enumerate(texts):
            for w in t:
                self.table[k, self.vocab[w]] += 1
            self.table[k] *= self.idf
            self.table[k] /= np.linalg.norm(self.table[k])
        self.required = [[[self.vocab.get(x.encode(), 0) for x in any_of.split("|")] for any_of in t.required.split()] for t in templates]
        self.never = [{x.encode() for x in t.never.split()} for t in templates]
        self.near = [{x.encode() for x in t.near.split()} for t in templates]

    def score(self, k: int, words: list[bytes]) -> float:
        """The cosine of a unit and a template, 0 without a required term."""
        vector, square = np.zeros(len(self.idf)), 0.0
        for w, n in Counter(words).items():
            i = self.vocab.get(w, 0)
            square += (n * self.idf[i]) ** 2
            if i:
                vector[i] = n * self.idf[i]
        if not square or any(not any(i and vector[i] for i in any_of) for any_of in self.required[k]):
            return 0.0
        return round(float(self.table[k] @ vector / np.sqrt(square)), 9)

    def fits(self, k: int, words: list[bytes], at: int, size: int) -> bool:
        """Whether the surroundings of a unit allow the template."""
        if not self.never[k] and not self.near[k]:
            return True
        around = set(words[max(0, at - AROUND) : at + size + max(AROUND, self.templates[k].beyond)])
        return not around & self.never[k] and self.near[k] <= around

    def scan(self, data: bytes, named: bool) -> tuple[str | None, float, str | None, int, int]:
        """Licence, score, unit and terms of the best unit, terms of the file."""
        words = words_of(data)
        n, least = len(words), self.min_score - 1e-6
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, n)
        held = np.bincount(ids, minlength=len(self.idf)) > 0
        held[0] = False
        may = np.flatnonzero((self.table * self.table) @ held >= least * least)
        found: list[tuple[int, float, int, int, int]] = []  # terms, score, -template, -unit, -place
        if n and len(may):
            header = words_of(header_of(data))
            square = np.concatenate(([0.0], np.cumsum(self.idf[ids] ** 2)))

            def consider(k: int, unit: int, place: int, own: list[bytes]) -> None:
                score = self.score(k, own)
                if score >= self.min_score and self.fits(k, words, place, len(own)):
                    found.append((len(own), score, -k, -unit, -place))

            for k in may.tolist():
                if header:
                    consider(k, 0, 0, header)
                if named:
                    consider(k, 1, 0, words)
                size = min(self.sizes[k], n)
                product = np.concatenate(([0.0], np.cumsum(self.table[k][ids] * self.idf[ids])))
                bound = (product[size:] - product[:-size]) / np.sqrt(square[size:] - square[:-size])
                for at in np.flatnonzero(bound >= least).tolist():
                    consider(k, 2, at, words[at : at + size])
        strong = [x for x in found if self.templates[-x[2]].licence not in WEAK] or found
        if not strong:
            return None, 0.0, None, 0, n
        top = max(x[1] for x in strong)
        best = max(x for x in strong if x[1] >= round(top - self.margin, 9))
        return self.templates[-best[2]].licence, best[1], UNITS[-best[3]], best[0], n


def header_of(data: bytes) -> bytes:
    """The lines before the first one without a term (blank lines at the very
    top don't count), without those that begin with the term copyright."""
    lines, began = [], False
    for line in data.split(b"\n"):
        words = words_of(line)
        if words and words[0] != b"copyright":
            lines.append(line)
        elif not words and began:
            break
        began = began or bool(words)
    return b"\n".join(lines)


def document_frequency(files: DataFrame, text_col: str, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """How many files there are, and how many hold each template term; the
    answer has a row per template term, whatever the number of files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = Counter(), 0
        for batch in slices(batches):
            for data in batch.column(0).to_pylist():
                n += 1
                found.update(vocabulary.intersection(words_of(data)))
        yield pa.RecordBatch.from_pydict({"term": [b"", *found], "n": [n, *found.values()]}, schema=pa.schema([("term", pa.binary()), ("n", pa.int64())]))

    rows = files.select(utf8(text_col).alias("t")).mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {bytes(r.term): r.n for r in rows}
    return found.pop(b"", 0), found


_SCANNERS: dict[str, Scanner] = {}


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, min_score: float = 0.8) -> DataFrame:
    """Columns `row` (the input row without its text), `path`, `own` (licence,
    score, unit, matched, words), `licence` and `origin` (the path of the file
    or of the directory that gives it, null without licence)."""
    vocabulary = {w for t in templates for w in words_of(t.text.encode())}
    n_files, frequency = document_frequency(files, text_col, vocabulary)
    key = uuid.uuid4().hex

    def own(texts: pa.Array, named: pa.Array) -> pa.Array:
        if key not in _SCANNERS:  # one for the life of a worker
            _SCANNERS.clear()
            _SCANNERS[key] = Scanner(templates, n_files, frequency, min_score)
        found = [_SCANNERS[key].scan(x.as_py() or b"", y.as_py()) for x, y in zip(texts, named)]
        return pa.StructArray.from_arrays([pa.array([x[k] for x in found], f.type) for k, f in enumerate(_OWN)], fields=list(_OWN))

    rows = packed(files).select("row", F.coalesce(F.col("row")[path_col].cast("string"), F.lit("")).alias("path"))
    bare = F.col("row").dropFields(f"`{text_col}`") if len(files.columns) > 1 else F.struct(F.lit(None).cast("string").alias("none"))
    scanned = rows.select(bare.alias("row"), "path", F.regexp_replace("path", "/?[^/]*$", "").alias("dir"), F.arrow_udf(own, _OWN_SQL)(utf8(F.col("row")[text_col]), licence_named("path")).alias("own"))
    scanned = written(scanned, "licences")
    near = written(inherited(scanned), "inherited")  # a plain table, so that the join with one crowded directory can be split
    met = scanned.join(near, F.col("dir") == F.col("below"), "left")
    has = F.col("own.licence").isNotNull()
    return met.select("row", "path", "own", F.coalesce("own.licence", "near.licence").alias("licence"), F.when(has, F.col("path")).otherwise(F.col("near.ancestor")).alias("origin"))


def licence_named(path: str) -> Column:
    return F.lower(F.regexp_extract(path, "([^/]*)$", 1)).rlike(_NAME)


def inherited(scanned: DataFrame) -> DataFrame:
    """(below, near struct(depth, ancestor, licence)) for the directories that a
    licence file of theirs or of an ancestor covers."""
    declares = scanned.where(F.col("own.licence").isNotNull() & (licence_named("path") | (2 * F.col("own.matched") >= F.col("own.words"))))
    of_dir = declares.groupBy("dir").agg(F.min(F.struct((-F.col("own.score")).alias("s"), "path", F.col("own.licence").alias("licence"))).alias("m"))
    of_dir = of_dir.select(F.col("dir").alias("ancestor"), "m.licence")
    parts = F.split("dir", "/")
    up = scanned.select("dir").distinct().select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts"))
    up = up.select("dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("ancestor"))
    return up.join(of_dir, "ancestor").groupBy(F.col("dir").alias("below")).agg(F.max(F.struct("depth", "ancestor", "licence")).alias("near"))
