import math
import re
from collections import Counter

from tidemark.llm import licenses


def test_headers_files_and_inheritance(spark):
    mit = licenses.TEMPLATES[1][1]
    rows = [
        (1, "src/a.py", "import x\n# Licensed under the Apache License, Version 2.0.\ncode here"),
        (2, "LICENSE", "Released under the MIT License."),
        (3, "src/b.py", "nothing stated"),
        (4, "src/lib/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (5, "src/lib/deep/er/c.py", None),
        (6, "src/libx/d.py", ""),
        (7, "other.txt", mit),
        (8, None, "nothing"),
        (9, "src/lib/NOTICE", "This work is licensed under the GNU General Public License, version 3."),
        (9, "src/b.py", "nothing stated"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "file_id long, path string, text string, directory string, license string")
    got = {(r.file_id, r.path): r for r in licenses.scan(df).collect()}
    want = {1: ("Apache-2.0", "header", None), 2: ("MIT", "file", None), 3: ("MIT", "inherited", ""), 4: ("GPL-3.0", "file", None), 5: ("GPL-3.0", "inherited", "src/lib"), 6: ("MIT", "inherited", ""), 7: ("MIT", "file", None), 8: (None, "none", None)}
    assert {k: (r.license, r.evidence, r.from_directory) for (k, _), r in got.items() if k in want} == want
    assert got[(1, "src/a.py")].line == 1 and len(got) == len(rows)
    assert licenses.scan(df.limit(0)).collect() == []


def test_cosine_against_brute_force(spark):
    texts = ["the License of\nLicensed under the Apache License, Version 2.0.", "Released\nReleased under the MIT license", None, "free software free of charge\n\nof the"]
    got = {r.file_id: r for r in licenses.scan(spark.createDataFrame([(k, f"f{k}", t) for k, t in enumerate(texts)], "file_id long, path string, text string"), least=0.01).collect()}
    split = lambda t: re.findall(r"[0-9a-z]+", t.lower())
    templates = [(n, Counter(split(t))) for n, t in licenses.TEMPLATES]
    vocabulary = set().union(*(t for _, t in templates))
    lines = [split(x) for t in texts if t for x in t.split("\n") if split(x)]
    df = Counter(w for x in lines for w in set(x))
    idf = lambda w: math.log((1 + len(lines)) / (1 + df[w])) + 1

    def cosine(words, template):
        c = Counter(words)
        norm = sum((n * idf(w)) ** 2 for w, n in c.items() if w in vocabulary) + sum(n for w, n in c.items() if w not in vocabulary) * (math.log(1 + len(lines)) + 1) ** 2
        other = sum((n * idf(w)) ** 2 for w, n in template.items())
        return sum(n * idf(w) ** 2 * template[w] for w, n in c.items() if w in template) / math.sqrt(norm * other) if norm else 0.0

    for k, text in enumerate(texts):
        best = max([cosine(split(x), t) for x in (text or "").split("\n") + [text or ""] for _, t in templates])
        assert math.isclose(got[k].cosine or 0.0, best if best >= 0.01 else 0.0, abs_tol=1e-6)


def test_documents_as_files(documents, no_documents):
    got = licenses.scan(licenses.of_documents(documents)).collect()
    assert len(got) == documents.count() and [r.path for r in got if r.file_id is None] == [None]
    assert licenses.scan(licenses.of_documents(no_documents)).collect() == []


def test_wrapped_headers_and_full_licence_files(spark):
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    bsd = ["Copyright 2019 The Chess Authors. All rights reserved.", "Use of this source code is governed by a BSD-style license that can be", "found in the LICENSE file."]
    code = "\n".join(f"def knight_{k}(board, square{k}):\n    return board.moves[square{k}] ^ mask_{k}\n" for k in range(60))
    comment = lambda lines, sign: "\n".join(f"{sign} {x}" for x in lines)
    mit = licenses._text("MIT").replace("<year> <copyright holders>", "2021 Ada Jones")
    rows = [
        (1, "a/x.py", "#!/usr/bin/env python\n#\n" + comment(gpl, "#") + "\n\n" + code),
        (2, "a/y.go", comment(bsd, "//") + "\n\n" + code),
        (3, "b/LICENSE", mit),
        (4, "b/z.py", code),
        (5, "c/COPYING", licenses._text("GPL-3.0")),
        (6, "c/z.py", code),
        (7, "d/z.py", code),
        (8, "e/head.py", code + "// Use of this source code is governed by a BSD-style"),
        (9, "f/tail.py", "// license that can be found in the LICENSE file.\n" + code),  # not joined to the file before it
    ]
    got = {r.file_id: r for r in licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string").coalesce(1)).collect()}
    want = {1: ("GPL-3.0", "header"), 2: ("BSD-3-Clause", "header"), 3: ("MIT", "header"), 4: ("MIT", "inherited"), 5: ("GPL-3.0", "file"), 6: ("GPL-3.0", "inherited"), 7: (None, "none"), 8: (None, "none"), 9: (None, "none")}  # 3: without its copyright line
    assert {k: (got[k].license, got[k].evidence) for k in want} == want
    assert got[1].line == 2 and got[2].line == 1
