"""License scan: sparse TF-IDF cosine of lines, headers and licence files to templates, and inheritance along directories."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import chunks, joined, saved, table, words

# How licenses are usually stated in a line, in the header of a file (as one text, however it is wrapped),
# and in full where they are short.
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_FIRST = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_LAST = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_TITLE = "{name} Version {version} Copyright (C) {years} Free Software Foundation, Inc."
_GFDL = "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version {version} or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."
_SPDX = ("Apache-2.0", "MIT", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "MPL-1.1", "MPL-2.0", "CC0-1.0")
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", _MIT),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", _GNU.format(name="General Public License", version=3)),
    ("GPL-2.0", _GNU.format(name="General Public License", version=2)),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", _GNU.format(name="Lesser General Public License", version=3)),
    ("LGPL-2.1", _GNU.format(name="Lesser General Public License", version="2.1")),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", _GNU.format(name="Affero General Public License", version=3)),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", " ".join([_BSD_FIRST, _BSD_THIRD, _BSD_LAST])),
    ("BSD-2-Clause", " ".join([_BSD_FIRST, _BSD_LAST])),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "To the extent possible under law, all copyright and related rights are waived: CC0 1.0 Universal"),
    ("LicenseRef-Proprietary", "All rights reserved"),
    ("GPL-1.0", _GNU.format(name="General Public License", version=1)),
    ("LGPL-2.0", _GNU.format(name="Library General Public License", version=2)),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations under the License."),
    *[(f"GFDL-{x}", _GFDL.format(version=x)) for x in ("1.1", "1.2", "1.3")],
    # how the full texts begin
    ("GPL-1.0", _TITLE.format(name="GNU GENERAL PUBLIC LICENSE", version="1, February 1989", years="1989")),
    ("GPL-2.0", _TITLE.format(name="GNU GENERAL PUBLIC LICENSE", version="2, June 1991", years="1989, 1991")),
    ("GPL-3.0", _TITLE.format(name="GNU GENERAL PUBLIC LICENSE", version="3, 29 June 2007", years="2007")),
    ("LGPL-2.0", _TITLE.format(name="GNU LIBRARY GENERAL PUBLIC LICENSE", version="2, June 1991", years="1991")),
    ("LGPL-2.1", _TITLE.format(name="GNU LESSER GENERAL PUBLIC LICENSE", version="2.1, February 1999", years="1991, 1999")),
    ("LGPL-3.0", _TITLE.format(name="GNU LESSER GENERAL PUBLIC LICENSE", version="3, 29 June 2007", years="2007")),
    ("AGPL-3.0", _TITLE.format(name="GNU AFFERO GENERAL PUBLIC LICENSE", version="3, 19 November 2007", years="2007")),
    ("GFDL-1.1", _TITLE.format(name="GNU Free Documentation License", version="1.1, March 2000", years="2000")),
    ("GFDL-1.2", _TITLE.format(name="GNU Free Documentation License", version="1.2, November 2002", years="2000, 2001, 2002")),
    ("GFDL-1.3", _TITLE.format(name="GNU Free Documentation License", version="1.3, 3 November 2008", years="2000, 2001, 2002, 2007, 2008")),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions. 1.0.1. \"Commercial Use\" means distribution or otherwise making the Covered Code available to a third party."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."),
    ("Artistic-1.0", "The \"Artistic License\" Preamble The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package"),
    *[(x, f"SPDX-License-Identifier: {x}") for x in _SPDX],
]


def _version(v: str) -> str:
    """A version and no other one: 2 also as 2.0, but not the 2 of 2.1. Texts are words, lower-cased, joined by one space."""
    return rf"\b(version |v ?){v.replace('.', ' ')}{'' if '.' in v else '( 0)?'}\b(?! \d\b)"


# What a unit has to say, all of it, to name a license (a version is one word of many and hardly moves a cosine), and must not say.
SAYS = {
    "Apache-2.0": [r"\bapache license\b", _version("2")],
    "MIT": [r"\bmit license\b|\bpermission is hereby granted free of charge"],
    **{f"{n}-{v}": [rf"\bgnu {name} licen[sc]e\b", _version(v.removesuffix(".0"))] for n, v, name in [
        ("GPL", "1.0", "general public"), ("GPL", "2.0", "general public"), ("GPL", "3.0", "general public"), ("LGPL", "2.0", "(lesser|library) general public"), ("LGPL", "2.1", "lesser general public"),
        ("LGPL", "3.0", "lesser general public"), ("AGPL", "3.0", "affero general public"), ("GFDL", "1.1", "free documentation"), ("GFDL", "1.2", "free documentation"), ("GFDL", "1.3", "free documentation")]},
    "BSD-3-Clause": [r"\bbsd 3 clause\b|\bneither the name\b"],
    "BSD-2-Clause": [r"\bredistribution and use\b"],
    "ISC": [r"\bpermission to use copy modify\b"],
    "Unlicense": [r"\breleased into the public domain\b"],
    **{f"MPL-{v}": [r"\bmozilla public license\b", _version(v)] for v in ("1.1", "2.0")},
    **{f"CC-{x}-4.0": [rf"\bcc {x.replace('-', ' ').lower()} 4 0\b"] for x in ("BY", "BY-SA", "BY-NC")},
    "CC0-1.0": [r"\bcc0 1 0\b"],
    "Artistic-1.0": [r"\bartistic license\b"],
    "LicenseRef-Proprietary": [r"\ball rights reserved\b"],
}
NOR = {"BSD-2-Clause": r"\bneither the name\b|\badvertising materials\b|\bbsd [34] clause\b", "BSD-3-Clause": r"\badvertising materials\b"}
DENIED = r"\b(not|never|no longer)( \w+)? (licensed|released) under\b"
#: What each template's units have to say, and must not say, as patterns.
CONDITIONS = [
    ([re.compile(rf"\bidentifier {re.escape(name.lower()).replace(re.escape('-'), ' ').replace(re.escape('.'), ' ')}$")] if text.startswith("SPDX") else [re.compile(x) for x in SAYS[name]], re.compile(DENIED + (f"|{NOR[name]}" if name in NOR and not text.startswith("SPDX") else "")))
    for name, text in TEMPLATES
]
#: Words before a unit that are looked at for a denial.
BEFORE = 3


def holds(template: int, text: str, before: str = "") -> bool:
    """Whether a unit's words (joined by one space), after ``before``, say what the template's license needs and nothing that rules it out."""
    says, nor = CONDITIONS[template]
    return all(x.search(text) for x in says) and not nor.search(f"{before} {text}")


#: Least cosine of a line or a run of words to a template, and least share of a file's words in such ones for it to count as a licence file.
CLOSE, MOSTLY = 0.8, 0.5
#: Templates of at least so many words are looked for in runs of words over lines, and names of files that speak for their directory.
LONG, NAMED = 12, re.compile(r"(^|/)(un)?(licen[cs]e|copying|copyright|notice)[^/]*$", re.IGNORECASE)
#: Runs of words that are compared at once, and directories whose licenses are broadcast at most.
AT_ONCE, FEW_DIRECTORIES = 1000, 100_000
_PLAIN = bytes(c if (chr(c).isalnum() and c < 128) or c >= 128 or c == 0x0A else 0x20 for c in range(256)).lower()
_PLAIN = bytes(ord(chr(c).lower()) if c < 128 else c for c in _PLAIN)


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased alphanumeric words of all texts, the line of each, the text of each line, lines' ends, the bytes, and where words start and end in them."""
    b, at = joined([t.translate(_PLAIN) for t in texts])
    h, start, end = words(b)
    ends = np.union1d(np.flatnonzero(b == 0x0A), at[1:] - 1)  # a line ends at its newline or at the end of its text
    return h, np.searchsorted(ends, start), np.searchsorted(at, ends, "right") - 1, ends, b, np.column_stack([start, end])


VOCABULARY = np.unique(np.concatenate([terms([t.encode()])[0] for _, t in TEMPLATES]))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(len(VOCABULARY), np.int64), 0
    for (texts,) in chunks(batches, ["text"], "text", 1 << 20):
        h, line, _, ends, _, _ = terms(texts)
        n += len(ends)
        k = np.minimum(np.searchsorted(VOCABULARY, h), len(VOCABULARY) - 1)
        hit = VOCABULARY[k] == h
        pairs = np.unique(line[hit] * len(VOCABULARY) + k[hit])
        df += np.bincount(pairs % len(VOCABULARY), minlength=len(VOCABULARY))
    yield pa.RecordBatch.from_arrays([pa.array([*range(len(df)), -1]), pa.array([*df.tolist(), n])], names=["term", "df"])


class Matcher:
    """Cosines of lines and of runs of words to the templates. Words outside the templates weigh as much as the rarest inside."""

    def __init__(self, df: np.ndarray, n: int, close: float = CLOSE):
        self.idf = np.log((n + 1) / (df + 1)) + 1
        self.rest = float(np.log(n + 1) + 1)
        self.close = close
        self.words = [np.searchsorted(VOCABULARY, terms([t.encode()])[0]) for _, t in TEMPLATES]
        m = np.array([np.bincount(w, minlength=len(VOCABULARY)) for w in self.words]) * self.idf
        self.m = m / np.linalg.norm(m, axis=1, keepdims=True)
        # a unit without any anchor of a template has a cosine below the bound with it, whatever else is in it
        order = np.argsort(-self.idf, kind="stable")
        self.anchors = []
        for row in self.m:
            left = np.sqrt(np.cumsum(row[order][::-1] ** 2)[::-1])
            self.anchors.append(order[: int((left >= close).sum())][row[order[: int((left >= close).sum())]] > 0])
        self.keys = np.zeros(len(VOCABULARY), bool)
        self.keys[np.concatenate(self.anchors)] = True
        spots = [(int(w), t, j) for t, ws in enumerate(self.words) if len(ws) >= LONG for j, w in enumerate(ws) if w in set(self.anchors[t].tolist())]
        self.spots = np.array(sorted(spots), np.int64).reshape(-1, 3)

    def best(self, texts: list[bytes]) -> list[tuple]:
        """For each text: license, cosine, and whether it is mostly license statements; (None, 0, False) without a close unit.

        Units are lines, and runs of as many words as a long template has, laid so that one of its anchors falls on the
        same word of the text. A unit is close if its cosine is and it says what the license needs (``holds``); a line counts for its closest such template. Of
        the close units the one counts whose template's words times the cosine above the bound are most.
        """
        h, line, owner, ends, b, spot_of = terms(texts)
        k = np.minimum(np.searchsorted(VOCABULARY, h), len(VOCABULARY) - 1)
        known = VOCABULARY[k] == h
        hit = np.flatnonzero(known & self.keys[k])
        out: list[tuple] = [(None, 0.0, False)] * len(texts)
        if not len(hit):
            return out
        doc = owner[line]
        lines = np.unique(line[hit])
        units = [np.column_stack([np.searchsorted(line, lines), np.searchsorted(line, lines, "right"), np.full(len(lines), -1)])]
        a, z = np.searchsorted(self.spots[:, 0], k[hit]), np.searchsorted(self.spots[:, 0], k[hit], "right")
        at, spot = np.repeat(hit, z - a), ragged(a, z - a)
        t, start = self.spots[spot, 1], at - self.spots[spot, 2]
        size = np.array([len(w) for w in self.words])
        first, last = np.searchsorted(doc, doc[at]), np.searchsorted(doc, doc[at], "right")
        units.append(np.unique(np.column_stack([np.maximum(start, first), np.minimum(start + size[t], last), t]), axis=0))
        said = lambda i, j: " ".join(b[spot_of[i, 0] : spot_of[j - 1, 1]].tobytes().decode("utf-8", "replace").split()) if i < j else ""
        found: list[tuple] = []
        for u in units:
            for i in range(0, len(u), AT_ONCE):
                done = None
                for s, e, t, cosine, line_ in self._close(u[i : i + AT_ONCE], h, k, known):
                    if line_ and done == (s, e):
                        continue
                    if holds(t, said(s, e), said(max(s - BEFORE, int(np.searchsorted(doc, doc[s]))), s)):
                        found.append((s, e, t, cosine))
                        done = (s, e)
        stated = np.zeros(len(h), bool)
        rank: dict[int, tuple] = {}
        for s, e, t, cosine in found:
            stated[s:e] = True
            d = int(doc[s])
            rank[d] = max(rank.get(d, (-1.0, 0.0, 0)), (round(float(size[t]) * (cosine - self.close), 9), cosine, -t))
        total, of_these = np.bincount(doc, minlength=len(texts)), np.bincount(doc, stated, len(texts))
        for d, (_, cosine, t) in rank.items():
            out[d] = (TEMPLATES[-t][0], cosine, bool(of_these[d] >= MOSTLY * total[d]))
        return out

    def _close(self, u: np.ndarray, h: np.ndarray, k: np.ndarray, known: np.ndarray) -> list[tuple[int, int, int, float, bool]]:
        """(start, end, template, cosine, is a line) of the units (start, end, template or -1 for any) that are close to a template, a unit's closest first."""
        size = u[:, 1] - u[:, 0]
        row, at = np.repeat(np.arange(len(u)), size), ragged(u[:, 0], size)
        v = np.zeros((len(u), len(VOCABULARY)))
        i = known[at]
        np.add.at(v, (row[i], k[at[i]]), 1)
        v *= self.idf
        other = self._others(h[at[~i]], row[~i], len(u))
        cosine = (v @ self.m.T) / np.sqrt(np.maximum((v**2).sum(axis=1) + other, 1e-30))[:, None]
        cosine[(cosine < self.close) | ((u[:, 2:] >= 0) & (u[:, 2:] != np.arange(len(TEMPLATES))))] = 0
        unit, pick = np.nonzero(cosine)
        score = cosine[unit, pick]
        o = np.lexsort((pick, -score, unit))
        return [*zip(*(x[o].tolist() for x in (u[unit, 0], u[unit, 1], pick, score, u[unit, 2] < 0)))]

    def _others(self, h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Squared weights of a unit's words outside the templates."""
        if not len(h):
            return np.zeros(n)
        o = np.lexsort((h, row))
        h, row = h[o], row[o]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]))
        return np.bincount(row[first], (np.diff(first, append=len(h)) * self.rest) ** 2, n)


def ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0].. start[0]+n[0], start[1].. and so on."""
    end = np.cumsum(n)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - n), n)


def license_scan(files: DataFrame) -> DataFrame:
    """One row per file of (doc_id, path, text): doc_id, path, license, score, own (by its own text), from_dir.

    A file's own license is that of the template that most of its words state: a line, or a run of words over lines (a
    wrapped header, a whole licence text), is close to it, and the more words it has and the closer the better; the whole text is looked at. Inverse document frequencies of the template terms
    are counted over all lines of all files. Files that are mostly statements, or have an own license and the name of a
    licence file, speak for their directory (the closest, then the smallest id), and files without an own license
    take that of their nearest ancestor directory. Ancestors are joined for each distinct directory, not for each file. A null
    text has no license; a null path has no directory; an empty table gives no rows.
    """
    rows = files.select("doc_id", "path", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.select("text").mapInArrow(_document_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()  # a row a template term
    df = np.zeros(len(VOCABULARY))
    n = 0
    for r in found:
        if r.term < 0:
            n = r.df
        else:
            df[r.term] = r.df
    matcher = Matcher(df, n)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, path, texts in chunks(batches, ["doc_id", "path", "text"], "text", 1 << 20):
            license_, score, speaks = zip(*matcher.best(texts))
            speaks = [s or bool(x and p and NAMED.search(p)) for s, x, p in zip(speaks, license_, path)]
            yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(path, pa.string()), pa.array(license_, pa.string()), pa.array(score, pa.float64()), pa.array(speaks, pa.bool_())], names=["doc_id", "path", "own_license", "score", "speaks"])

    own = saved(rows.mapInArrow(match, "doc_id long, path string, own_license string, score double, speaks boolean"), "licenses")
    own = own.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), ""))
    spoken = own.where("speaks").groupBy("dir").agg(F.max_by("own_license", F.struct("score", -F.col("doc_id"))).alias("dir_license")).withColumnRenamed("dir", "ancestor")
    up = F.transform(F.sequence(F.lit(1), F.size(F.split("dir", "/"))), lambda i: F.array_join(F.slice(F.split("dir", "/"), 1, i), "/"))
    dirs = own.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.array_union(F.array(F.lit("")), up)).alias("ancestor"))
    nearest = dirs.join(spoken, "ancestor").groupBy("dir").agg(F.max_by("dir_license", F.length("ancestor")).alias("dir_license"), F.max_by("ancestor", F.length("ancestor")).alias("from_dir"))
    nearest = saved(nearest, "nearest")
    if nearest.limit(FEW_DIRECTORIES + 1).count() <= FEW_DIRECTORIES:
        nearest = F.broadcast(nearest)
    return own.join(nearest, "dir", "left").select(
        "doc_id", "path", F.coalesce("own_license", "dir_license").alias("license"), "score", F.col("own_license").isNotNull().alias("own"), F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("from_dir")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as files of a tree: source / language / id."""
    docs = table(spark, sf_dir, "documents")
    return license_scan(docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"))
