import os
import re
from collections import Counter
from math import isclose, log, sqrt

import pytest

from eodlake.llm import licenses
from tests.llm.fixtures import SCHEMA

WORDS = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def tokens(line):
    return WORDS.findall("".join(c.lower() if c < "\x80" else c for c in line))


def brute(files):
    lines = [tokens(x) for _, _, t in files for x in (t or "").split("\n")]
    vocabulary = {w for _, t in licenses.TEMPLATES for w in tokens(t)}
    df = Counter(w for x in lines for w in set(x) if w in vocabulary)
    n = len(lines)
    weight = lambda w: log((n + 1) / (df[w] + 1)) + 1 if w in vocabulary else log(n + 1) + 1
    vector = lambda ws: {w: k * weight(w) for w, k in Counter(ws).items()}

    def cosine(a, b):
        return sum(v * b.get(w, 0) for w, v in a.items()) / sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())) if a else 0.0

    templates = [(name, tokens(t), vector(tokens(t))) for name, t in licenses.TEMPLATES]
    places = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: licenses.terms([w.encode()])[0][0]))}

    def anchors(ws, v):
        """The rarest terms, until what is left has too little weight."""
        ranked, size, left = sorted(v, key=lambda w: (-weight(w), places[w])), sum(x * x for x in v.values()), 1.0
        for i, w in enumerate(ranked):
            if sqrt(max(left, 0)) < licenses.CLOSE:
                return set(ranked[:i])
            left -= v[w] ** 2 / size
        return set(ranked)

    marks = [anchors(ws, v) for _, ws, v in templates]
    own, spoken = [], {}
    for d, path, t in files:
        ws, spans, at = [], [], 0
        for x in (t or "").split("\n"):
            ws += tokens(x)
            spans += [(at, len(ws), k) for k in range(len(templates))]
            at = len(ws)
        runs = {(max(i - j, 0), min(i - j + len(tw), len(ws)), k) for k, (_, tw, _) in enumerate(templates) if len(tw) >= licenses.LONG for j, w in enumerate(tw) if w in marks[k] for i, x in enumerate(ws) if x == w}
        best, stated = (-1, 0.0, 0), set()
        lines = {}
        says = lambda a, z, k: licenses.holds(k, " ".join(ws[a:z]), " ".join(ws[max(a - 3, 0) : a]))
        for a, z, k in spans:  # a line counts for its closest template of those whose license it names
            s = cosine(vector(ws[a:z]), templates[k][2])
            if s >= licenses.CLOSE - 1e-12 and says(a, z, k):
                lines[a, z] = max(lines.get((a, z), (0.0, 0)), (s, -k))
        for a, z, k in {(a, z, -k) for (a, z), (_, k) in lines.items()} | runs:
            s = cosine(vector(ws[a:z]), templates[k][2])
            if s >= licenses.CLOSE - 1e-12 and says(a, z, k):
                stated |= set(range(a, z))
                best = max(best, (round(len(templates[k][1]) * (s - licenses.CLOSE), 9), s, -k))
        best = (templates[-best[2]][0], best[1]) if best[1] else (None, 0.0)
        own.append((d, path, *best))
        if best[0] and (len(stated) >= 0.5 * len(ws) or licenses.NAMED.search(path or "")) and path is not None:
            here = path.rsplit("/", 1)[0] if "/" in path else ""
            spoken[here] = max(spoken.get(here, (0, 0, "")), (best[1], -d, best[0]))
    out = []
    for d, path, name, s in own:
        source = None
        if not name and path is not None:
            here = path.rsplit("/", 1)[0] if "/" in path else ""
            while True:
                if here in spoken:
                    name, source = spoken[here][2], here
                    break
                if not here:
                    break
                here = here.rsplit("/", 1)[0] if "/" in here else ""
        out.append((d, path, name, round(s, 9), source is None and name is not None, source))
    return out


def test_files(spark):
    prose = "Some words of prose that state nothing at all about rights\nand a second line"
    files = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/x.py", prose),
        (3, "a/b/c/y.py", prose),
        (4, "a/b/LICENSE", "Licensed under the Apache License, Version 2.0.\nApache License, Version 2.0"),
        (5, "a/b/z.py", f"{prose}\nLicensed under CC BY-NC 4.0.\n{prose}"),
        (6, "q/w.py", prose),
        (7, "top.py", ""),
        (8, None, prose),
        (9, "a/b/n.py", None),
        (10, "a/b/c", "über den"),
        (11, "q/v/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (11, "q/v/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (12, "q/v/u/t/s.py", prose * 300),
    ]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = [(r.doc_id, r.path, r.license, round(r.score, 9), r.own, r.from_dir) for r in licenses.license_scan(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(files)))


def wrapped(text, mark="# ", width=60):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(mark + line.strip())
            line = ""
        line += " " + w
    return "\n".join([*out, mark + line.strip()])


def test_wrapped_headers_and_whole_licences(spark):
    texts = {}
    for name, text in licenses.TEMPLATES:
        if len(tokens(text)) >= licenses.LONG:
            texts.setdefault(name, text)
            if len(text) > len(texts[name]):
                texts[name] = text
    assert {"GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC", "Unlicense", "Apache-2.0"} <= set(texts)
    prose = "Some words of prose that state nothing at all\n" * 40
    files = [(k, f"src{k}/x.py", f"# Copyright 2020 someone\n{wrapped(t)}\n{prose}") for k, t in enumerate(texts.values())]
    files += [(100 + k, f"lib{k}/LICENSE", f"Copyright (c) 2020 someone. All rights reserved.\n\n{wrapped(t, '')}") for k, t in enumerate(texts.values())]
    files += [(200 + k, f"lib{k}/deep/er/x.py", prose) for k in range(len(texts))]
    got = {r.doc_id: (r.license, r.own) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    for k, name in enumerate(texts):
        assert got[k] == (name, True) and got[100 + k] == (name, True) and got[200 + k] == (name, False), name


TEXTS = "/usr/share/common-licenses"
NAMES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not os.path.isdir(TEXTS), reason="needs the license texts of a Debian system")
def test_full_texts_by_name_and_their_directories(spark):
    files, want = [], {}
    for k, (file, name) in enumerate((f, n) for f, n in NAMES.items() if os.path.exists(f"{TEXTS}/{f}")):
        text = open(f"{TEXTS}/{file}", encoding="utf-8").read()
        files += [(2 * k, f"{file}/LICENSE", text), (2 * k + 1, f"{file}/src/x.py", "Some words of prose that state nothing")]
        want |= {2 * k: (name, True), 2 * k + 1: (name, False)}
    got = {r.doc_id: (r.license, r.own) for r in licenses.license_scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == want


def test_versions_and_denials(spark):
    gnu = licenses._GNU
    cases = [
        (gnu.format(name="General Public License", version=1), "GPL-1.0"),
        (gnu.format(name="General Public License", version=2), "GPL-2.0"),
        (gnu.format(name="General Public License", version=4), None),
        (gnu.format(name="Lesser General Public License", version="2.1"), "LGPL-2.1"),
        (gnu.format(name="Library General Public License", version=2), "LGPL-2.0"),
        ("Licensed under the Apache License, Version 2.0", "Apache-2.0"),
        ("Licensed under the Apache License, Version 1.1", None),
        ("Not licensed under the Apache License, Version 2.0", None),
        ("This file is not\nlicensed under the Apache License, Version 2.0", None),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under CC BY-NC-SA 4.0", None),
        ("SPDX-License-Identifier: MPL-1.1", "MPL-1.1"),
        ("SPDX-License-Identifier: BSD-4-Clause", None),
        ("SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1-only"),
    ]
    df = spark.createDataFrame([(k, f"d{k}/x.py", f"# {t}\n{'some words of prose that say nothing' * 3}") for k, (t, _) in enumerate(cases)], "doc_id long, path string, text string")
    got = {r.doc_id: r.license for r in licenses.license_scan(df).collect()}
    assert [(t, got[k]) for k, (t, _) in enumerate(cases)] == cases


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    files = [(r.doc_id, f"{r.source}/{r.lang}/{r.doc_id}", r.text) for r in docs.collect()]
    got = {r.doc_id: (r.license, r.score, r.own, r.from_dir) for r in licenses.op9_license_scan(spark, "/root/testdata/sf0.001").collect()}
    for d, _, name, s, own, source in brute(files):
        assert got[d][0] == name and got[d][2:] == (own, source) and isclose(got[d][1], s, abs_tol=1e-6)
    assert sum(1 for x in got.values() if x[2]) > 0


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA).selectExpr("doc_id", "source as path", "text")
    assert licenses.license_scan(df).collect() == []
