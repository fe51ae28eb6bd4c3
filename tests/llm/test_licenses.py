import math
import re
import textwrap
from collections import Counter
from importlib import resources

import pytest

from adflow.llm import licenses as lc
from adflow.llm.notices import notices

FILES = "path string, text string"


def brute(rows, least=lc.LEAST):
    """Best template per file by dictionaries."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    vocabulary = {w for _, t in [*lc.TEMPLATES, *notices()] for w in split(t)}
    n, files = len(rows), Counter()
    for _, text in rows:
        files.update(set(split(text)) & vocabulary)
    idf = lambda w: math.log((1 + n) / (1 + files[w])) + 1 if w in vocabulary else math.log(1 + n) + 1

    def cosine(a, b):
        norm = lambda s: math.sqrt(sum(idf(w) ** 2 for w in s))
        return sum(idf(w) ** 2 for w in a & b) / (norm(a) * norm(b)) if a and b else 0.0

    out = {}
    for path, text in rows:
        parts = [set(split(x)) for x in (text or "").split("\n")]
        if re.match(lc.NAMES, (path or "").split("/")[-1]):
            parts.append(set(split(text)))
        best = max(((cosine(p, set(split(t))), -k) for p in parts for k, (_, t) in enumerate(lc.TEMPLATES)), default=(0, 0))
        out[path] = lc.TEMPLATES[-best[1]][0] if best[0] >= least else None
    return out


@pytest.fixture()
def files(spark):
    return lambda rows: spark.createDataFrame(rows, FILES).repartition(3) if rows else spark.createDataFrame([], FILES)


TREE = [
    ("LICENSE", "Copyright someone\nReleased under the MIT License."),
    ("a/LICENSE.txt", "This work is licensed under the GNU General Public License,\nversion 3."),
    ("a/b/code.py", "# no licence here\nx = 1"),
    ("a/b/c/code.py", "# Licensed under the Apache License, Version 2.0.\nx = 1"),
    ("a/x.py", "x = 1"), ("top.py", "y"), ("d/e/f/g.py", "z"), ("d/COPYING", "Licensed under CC BY-NC 4.0."),
    ("d/e/notes.txt", "Licensed under CC BY 4.0."), ("d/e/license", "nothing of the kind"),
    ("h/LICENSE-MIT", "Released under the MIT License."), ("h/LICENSE-2", "Licensed under the Apache License, Version 2.0."),
    ("h/i.py", "q"), ("long.txt", "some words of a text " * 3000 + "\n  (Released under the MIT license!)\n" + "more " * 3000),
    (None, "Released under the MIT License."), ("null.txt", None), ("empty.txt", ""),
]


def test_matches_equal_brute_force(files):
    df = files(TREE).selectExpr("path AS k", "path AS p", "text AS t", f"split_part(coalesce(path, ''), '/', -1) rlike '{lc.NAMES}' AS whole")
    got = {r["k"]: r["license"] for r in lc.scan(df, ["k"]).collect()}
    assert got == brute(TREE)
    assert got["long.txt"] == "MIT" and got["d/e/notes.txt"] == "CC-BY-4.0" and got["d/COPYING"] == "CC-BY-NC-4.0"


def test_inheritance_from_the_nearest_folder(files):
    got = {r["path"]: (r["license"], r["origin"], r["origin_path"]) for r in lc.licenses(files(TREE)).collect()}
    assert len(got) == len(TREE)
    assert got["a/b/code.py"] == ("GPL-3.0", "inherited", "a/LICENSE.txt") == got["a/x.py"]
    assert got["a/b/c/code.py"] == ("Apache-2.0", "own", "a/b/c/code.py")
    assert got["top.py"] == ("MIT", "inherited", "LICENSE") == got["null.txt"] == got["empty.txt"]
    assert got["d/e/f/g.py"] == ("CC-BY-NC-4.0", "inherited", "d/COPYING")
    # The better match of two, then the smaller path.
    assert got["h/i.py"][1] == "inherited" and got["h/i.py"][2] in ("h/LICENSE-2", "h/LICENSE-MIT")
    assert got[None] == ("MIT", "own", None)


def test_no_licence_anywhere_and_clashing_names(files):
    df = files([("a/b.py", "x"), ("a/b.py", "x"), ("c.py", None)]).selectExpr("*", "1 AS k", "2 AS p", "3 AS t", "4 AS whole", "5 AS license")
    got = lc.licenses(df).collect()
    assert len(got) == 3 and {(r["license"], r["origin"]) for r in got} == {(None, "none")}
    assert lc.licenses(files([])).count() == 0


GPL = """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version.
"""


def full(name):
    return (resources.files("adflow.llm") / "license_texts" / f"{name}.txt").read_text("utf-8")


def test_wrapped_headers_and_full_texts(files):
    code = "import os\n\n\ndef run(x):\n    return os.path.join(x, 'y')\n" * 40
    rows = [
        ("v2.py", "# This work is licensed under the GNU General Public License,\n# version 2.\n" + code),
        ("v3.py", code + "# This work is licensed under the GNU General Public License,\n# version 3.\n" + code),
        ("said.py", "# This work is licensed under the GNU General Public License,\n# version 3, as found beside.\n" + code),
        ("gpl2.py", "#!/bin/sh\n# Copyright someone\n#\n" + GPL.format(2) + "#\n" + code), ("gpl3.py", GPL.format(3) + code),
        ("apache.c", "/* Licensed under the Apache License, Version 2.0 (the\n * \"License\"); you may not use this file except in\n"
                     " * compliance with the License. You may obtain a copy of\n * the License at\n */\n" + code),
        ("mit.txt", "\n".join(textwrap.wrap(notices()[1][1], 50))), ("none.py", code),
        *((f"{n}/COPYING", full(n)) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")),
        ("GPL-3.0/deep/code.py", "x = 1"),
    ]
    got = {r["path"]: (r["license"], r["origin"]) for r in lc.licenses(files(rows)).collect()}
    want = {"v2.py": "GPL-2.0", "v3.py": "GPL-3.0", "said.py": "GPL-3.0", "gpl2.py": "GPL-2.0", "gpl3.py": "GPL-3.0",
            "apache.c": "Apache-2.0", "mit.txt": "MIT", "none.py": None}
    assert {k: got[k][0] for k in want} == want
    assert all(got[p] == (p.split("/")[0], "own") for p, _ in rows if p.endswith("COPYING"))
    assert got["GPL-3.0/deep/code.py"] == ("GPL-3.0", "inherited")


def test_spdx_lines_need_the_whole_identifier(files):
    code = "import os\nx = os.path.join(a, b)\n" * 20
    want = {
        "MIT": "MIT", "GPL-3.0-or-later": "GPL-3.0", "GPL-2.0-only": "GPL-2.0", "GPL-2.0": "GPL-2.0", "LGPL-2.1-or-later": "LGPL-2.1",
        "AGPL-3.0-only": "AGPL-3.0", "Apache-2.0": "Apache-2.0", "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause",
        "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC-BY-4.0": "CC-BY-4.0", "CC0-1.0": "CC0-1.0", "ISC": "ISC",
        "Zlib": None, "Foo-2.0": None, "EPL-2.0": None, "EPL-2.0-or-later": None}
    rows = [(f"{k}.py", f"#!/usr/bin/env python\n# SPDX-License-Identifier: {k}\n{code}") for k in want]
    got = {r["path"][:-3]: r["license"] for r in lc.licenses(files(rows)).collect()}
    assert got == want


def test_words_of_all_templates_are_counted(files):
    """A word that every file has weighs least, also if only a full text has it."""
    rows = [(f"{k}.txt", f"notwithstanding {k}") for k in range(20)]
    every = lc.Templates([*lc.TEMPLATES, *notices()])
    df = files(rows).selectExpr("text AS t")
    count, n = lc.frequencies(df, every)
    word = lc.Texts.of(lc.pa.array(["notwithstanding"]), lower=True).words(lc.NOT_ALNUM).hashes()
    assert n == 20 and count[every.place(word)[0]] == 20
