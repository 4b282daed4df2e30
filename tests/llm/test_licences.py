"""Licence scan: the whole query against plain cosines over every unit, and
directories looked up one by one."""

import math
import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)


def slow_scan(files, templates, min_score=0.8):
    """files: (path, text) -> (own licence, score, unit, licence, origin)."""
    split = [terms(t or "") for _, t in files]
    known = {w for t in templates for w in terms(t.text)}
    df = Counter(w for t in split for w in set(t))
    idf = lambda w: math.log((1 + len(files)) / (1 + (df[w] if w in known else 0))) + 1

    def vector(words):
        return {w: n * idf(w) for w, n in Counter(words).items()}

    units_of_templates = [(t, terms(t.text), vector(terms(t.text))) for t in templates]

    def cosine(words, t, other):
        if not words or any(not any(x in words for x in any_of.split("|")) for any_of in t.required.split()):
            return 0.0
        own = vector(words)
        return round(sum(v * other.get(w, 0) for w, v in own.items()) / math.sqrt(sum(v * v for v in own.values())) / math.sqrt(sum(v * v for v in other.values())), 9)

    found = []
    for (path, text), words in zip(files, split):
        name = (path or "").rpartition("/")[2].lower()
        named = re.match(r"(licen[cs]e|copying|notice|unlicense)([._-].*)?$", name) is not None
        lines = [terms(x) for x in (text or "").split("\n")]
        while lines and not lines[0]:
            lines.pop(0)
        header = [w for x in lines[: lines.index([]) if [] in lines else None] if x[0] != "copyright" for w in x]
        matches = []
        for k, (t, own, other) in enumerate(units_of_templates):
            units = [(0, 0, header)] + ([(1, 0, words)] if named else [])
            size = min(len(own), len(words))
            units += [(2, i, words[i : i + size]) for i in range(len(words) - size + 1)] if size else []
            for kind, at, unit in units:
                if set(unit) & set(own):
                    score = cosine(unit, t, other)
                    around = words[max(0, at - 3) : at + len(unit) + max(3, t.beyond)]
                    if score >= min_score and not set(t.never.split()) & set(around) and set(t.near.split()) <= set(around):
                        matches.append((len(unit), score, -k, -kind, -at, t.licence))
        strong = [m for m in matches if "Reserved" not in m[5]] or matches
        best = max([m for m in strong if m[1] >= round(max(x[1] for x in strong) - 0.1, 9)], default=None)
        found.append((best[5], best[1], ("header", "file", "notice")[-best[3]], named or 2 * best[0] >= len(words)) if best else (None, 0.0, None, named))
    of_dir = {}
    for (path, _), (licence, score, _, declares) in zip(files, found):
        if licence and declares:
            where = (path or "").rpartition("/")[0]
            of_dir[where] = min(of_dir.get(where, (0, "~", "")), (-score, path or "", licence))
    out = []
    for (path, _), (licence, score, unit, _) in zip(files, found):
        where, origin, near = (path or "").rpartition("/")[0], None, None
        while near is None:
            if where in of_dir:
                near, origin = of_dir[where][2], where
            elif "/" in where:
                where = where.rpartition("/")[0]
            elif where:
                where = ""
            else:
                break
        out.append((licence, round(score, 6), unit, licence or near, (path or "") if licence else origin))
    return out


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
FILES = [
    ("/p/LICENSE", "The project's licence\n\n" + MIT + ", and so on with other words that follow"), ("/p/a/x.py", "import os\nprint(os.name)\n"), ("/p/a/b/c/d/y.py", "x = 1"),
    ("/p/b/COPYING.txt", "SPDX-License-Identifier: GPL-3.0\n"), ("/p/b/c/d/y.py", "x = 1"), ("/p/b/c/own.py", "# Released under the MIT License\n\nx = 2\n" + "y = 3\n" * 50),
    ("/p/b/c/own2.py", "x = 2\n" + "y = 3\n" * 50 + "Licensed under the Apache License, Version 2.0 and nothing else"), ("/q/z.py", "nothing"), ("/q/z.py", "nothing"), ("rootless", "Licensed under CC BY-SA 4.0"),
    ("dir/rootless", "some text"), (None, None), (None, "All rights reserved."), ("/", ""), ("/q/r/s/LICENSE", "The terms are secret"), ("/q/r/s/t", "text"), ("/tie/LICENSE", "Released under the MIT License"),
    ("/tie/LICENCE", "Licensed under the ISC License"), ("/tie/u/v.c", "int x;"), ("/p/b/c/e/f.js", "/* (c) 2024 */\n\nlicensed under the the the GNU General Public License version 2"), ("/é/LICENSE", "CC0 1.0 Universal license"), ("/é/ü/x", "中文"),
]


def test_files_as_by_plain_cosines(spark):
    from skyplan.llm.license_scan import TEMPLATES, scan_licenses

    df = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(FILES)], "n int, path string, text string, licence string")
    got = {r.n: tuple(r)[1:] for r in scan_licenses(df).select("row.n", "own.licence", "own.score", "own.unit", "licence", "origin").collect()}
    for i, want in enumerate(slow_scan(FILES, TEMPLATES)):
        assert (got[i][0], round(got[i][1], 6), *got[i][2:]) == want, FILES[i]


def test_query_as_by_plain_cosines(spark, tmp_path):
    from skyplan.llm.license_scan import TEMPLATES
    from skyplan.llm.queries import op2_license_scan

    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.n_chars < 700 or "icense" in r.text][:60]
    rows = [(r.doc_id, r.source, r.lang, r.text) for r in docs]
    rows += [(100, "src0", "en", "Released under the MIT License."), (150, "src1", "en", MIT), (200, "src1", None, "no licence"), (None, None, None, None), (7, None, "en", "x"), (50, "src0", "fr", "SPDX-License-Identifier: ISC")]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def path(i, source, lang):
        s, tail = source or "-", lang or "-"
        if i is None:
            return f"/{s}/{tail}/-/-"
        return f"/{s}/LICENSE" if i % 100 == 0 else f"/{s}/{tail}/COPYING" if i % 100 == 50 else f"/{s}/{tail}/{i % 8}/{i}"

    files = [(path(i, s, x), t) for i, s, x, t in rows]
    want = [(i, p, *found) for (i, _, _, _), (p, _), found in zip(rows, files, slow_scan(files, TEMPLATES))]
    got = [tuple(r) for r in op2_license_scan(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(r[2] is None and r[5] and r[6].count("/") == 1 for r in got) and any(r[2] for r in got)


def test_variants_and_confusions():
    from skyplan.llm.license_scan import TEMPLATES, Scanner

    s = Scanner(TEMPLATES, 10**6, {b"the": 900_000, b"of": 800_000, b"a": 900_000, b"this": 500_000, b"is": 600_000, b"by": 500_000, b"to": 700_000, b"and": 700_000, b"or": 500_000, b"license": 3000}, 0.8)

    def licence(text):
        return s.scan(text.encode(), False)[0]

    assert licence("Licensed under the MIT License.") == "MIT" and licence("SPDX-License-Identifier: MIT") == "MIT" and licence("SPDX-License-Identifier: Own-1.0") is None
    assert licence("x\n// SPDX-License-Identifier: GPL-2.0-only\n") == "GPL-2.0" and licence("so it was licensed under the GNU General Public License, version 3. And more") == "GPL-3.0"
    assert licence("Copyright (c) 2024 Jane Doe. All rights reserved.") == "LicenseRef-AllRightsReserved" and licence("Licensed under CC BY-NC 4.0.") == "CC-BY-NC-4.0"
    assert licence("prose " * 300 + MIT + " prose" * 300) == "MIT" and licence("all of the rights of the person are by the law") is None and licence("") is None


GNU = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
BSD = """Copyright (c) 2024, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
REWORDED = """Copyright 2024 Some Company. All rights reserved.
Permission is granted hereby, free of any charge, to each person that obtains a copy of this software and its associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and sell copies of the Software"""


@pytest.mark.parametrize("frequency", ["none", "even", "prose"])
def test_neighbours(frequency):
    """Licences whose texts differ in a name, a number or a clause."""
    from skyplan.llm.license_scan import TEMPLATES, Scanner, words_of

    vocabulary = {w for t in TEMPLATES for w in words_of(t.text.encode())}
    common = {b"the", b"of", b"a", b"this", b"is", b"by", b"to", b"and", b"or", b"in", b"that"}
    of = {"none": dict.fromkeys(vocabulary, 0), "even": dict.fromkeys(vocabulary, 500), "prose": {w: 900_000 if w in common else 2000 for w in vocabulary}}
    s = Scanner(TEMPLATES, 1000 if frequency != "prose" else 10**6, of[frequency], 0.8)

    def licence(text, named=False):
        return s.scan(text.encode(), named)[:3:2] if named else s.scan(text.encode(), False)[0]

    assert licence(BSD.format("")) == "BSD-2-Clause" and licence(BSD.format(THIRD)) == "BSD-3-Clause"
    grant = BSD.split("\n")[3]
    assert licence(grant) == "BSD-2-Clause" and licence(f"{grant}\n{THIRD}") == "BSD-3-Clause"
    assert licence(GNU.format("library", "Lesser", "2.1")) == "LGPL-2.1" and licence(GNU.format("library", "Lesser", "3")) == "LGPL-3.0"
    assert licence(GNU.format("program", "Affero", "3")) == "AGPL-3.0" and licence(GNU.format("program", "", "2")) == "GPL-2.0" and licence(GNU.format("program", "", "3")) == "GPL-3.0"
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        assert licence(f"Licensed under CC {kind} 4.0.") == f"CC-{kind}-4.0"
        assert licence(f"prose and SPDX-License-Identifier: CC-{kind}-4.0") == f"CC-{kind}-4.0"
    assert licence("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.") == "CC-BY-NC-SA-4.0"
    assert licence(REWORDED) in ("MIT", None) and licence("Copyright 2024 A. All rights reserved.\n\n" + MIT.replace("hereby granted", "granted")) == "MIT"
    assert licence("All rights reserved.") == "LicenseRef-AllRightsReserved"
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    assert licence(isc + ".") == "0BSD" and licence(isc + ", provided that the above copyright notice and this permission notice appear in all copies.") == "ISC"
    assert licence("Licensed under the BSD 2-Clause License") == "BSD-2-Clause" and licence("Licensed under the BSD 3-Clause License") == "BSD-3-Clause"
    assert licence("Distributed under the Boost Software License, Version 1.0.") == "BSL-1.0" and licence("Released under the zlib License") == "Zlib"
    assert licence("made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/ this program and the accompanying materials are") == "EPL-2.0"


def test_units_that_win(spark):
    """A whole text under a licence file's name is the unit `file`, a comment
    block at the top `header`, a sentence in prose `notice`; directories take
    them on."""
    from skyplan.llm.license_scan import GRANTS, scan_licenses

    whole = {g[0]: g[1] for g in GRANTS}  # the longest text of each comes last
    head = "# Copyright (c) 2024 Jane Doe\n# {}\n\nx = 1\n" + "y = 2\n" * 100
    files = [
        ("/m/LICENSE", "Copyright (c) 2024 Jane Doe\n\n" + whole["MIT"]), ("/m/src/x.py", "x"), ("/b/COPYING", "Copyright 2020 A and B\n\n" + whole["BSD-3-Clause"]), ("/b/y/z/x.py", "x"),
        ("/m/own.py", head.format("SPDX-License-Identifier: ISC")), ("/m/own2.py", head.format("Licensed under the Apache License, Version 2.0")), ("/n/x.txt", "word " * 60 + "Released under the MIT License. " + "word " * 60),
        ("/i/LICENSE", whole["ISC"]), ("/z/LICENSE", whole["0BSD"]), ("/u/UNLICENSE", whole["Unlicense"]),
    ]
    got = {r.path: (r.licence, r.unit, r.origin) for r in scan_licenses(spark.createDataFrame(files, "path string, text string")).select("path", "licence", "own.unit", "origin").collect()}
    assert got == {
        "/m/LICENSE": ("MIT", "file", "/m/LICENSE"), "/m/src/x.py": ("MIT", None, "/m"), "/b/COPYING": ("BSD-3-Clause", "file", "/b/COPYING"), "/b/y/z/x.py": ("BSD-3-Clause", None, "/b"),
        "/m/own.py": ("ISC", "header", "/m/own.py"), "/m/own2.py": ("Apache-2.0", "header", "/m/own2.py"), "/n/x.txt": ("MIT", "notice", "/n/x.txt"),
        "/i/LICENSE": ("ISC", "header", "/i/LICENSE"), "/z/LICENSE": ("0BSD", "header", "/z/LICENSE"), "/u/UNLICENSE": ("Unlicense", "header", "/u/UNLICENSE"),
    }


@pytest.mark.parametrize("text", ["", "\n\n", "one\ntwo\n\nthree", "\n \n--\none\n--\ntwo", "Copyright A\n\none", "# copyright A\none\n\ntwo"])
def test_header(text):
    from skyplan.llm.license_scan import header_of

    want = {"": b"", "\n\n": b"", "one\ntwo\n\nthree": b"one\ntwo", "\n \n--\none\n--\ntwo": b"one", "Copyright A\n\none": b"", "# copyright A\none\n\ntwo": b"one"}
    assert header_of(text.encode()) == want[text]


def test_long_and_empty_tables(spark):
    from skyplan.llm.license_scan import scan_licenses

    df = spark.createDataFrame([("/a/x", "word " * 400_000 + "Released under the MIT License. " + "word " * 1000), ("/a/y", "the license " * 50_000)], "path string, text string")
    assert [r.licence for r in scan_licenses(df).orderBy("path").collect()] == ["MIT", None]
    assert scan_licenses(df, templates=()).where("licence is not null").count() == 0 and scan_licenses(df.limit(0)).count() == 0
