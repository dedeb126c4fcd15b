import functools
import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from eodlake.llm import imatch
from tests.llm.fixtures import SCHEMA, WORD, frame, key, rows


def lowered(text):
    return text.encode().lower()


def edits(data):
    """(id, text, edited text) of each row."""
    docs = sorted(((d, t or "") for d, t, *_ in data), key=lambda x: (key(x[0]), x[1]))
    return [(d, t, t[: len(t) - len(t) // 4] + docs[(i + 1) % len(docs)][1][: len(t) // 4]) for i, (d, t) in enumerate(docs)]


def expected(data):
    docs = sorted(((d, t or "") for d, t, *_ in data), key=lambda x: (key(x[0]), x[1]))
    out = []
    for i, (d, t) in enumerate(docs):
        f, n = docs[(i + 1) % len(docs)][1], len(t)
        out.append((d, n, hashlib.sha256((t[: n - n // 4] + f[: n // 4]).encode()).hexdigest()))
    return out


def by(x):
    return sorted(x, key=lambda r: (key(r[0]), r[1:]))


def test_edited_texts(spark):
    got = imatch.imatch(frame(spark)).collect()
    assert by((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == by(expected(rows()))
    text = {}
    for d, t, *_ in rows():
        text.setdefault((d, len(t or "")), t or "")
    prints = {}
    for r in got:
        prints.setdefault(text[r.doc_id, r.n_chars], set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(p) == 1 for p in prints.values())


def test_small(spark):
    assert imatch.imatch(spark.createDataFrame([], SCHEMA)).collect() == []
    (r,) = imatch.imatch(spark.createDataFrame([(1, "one two three", "en", "s", 13)], SCHEMA)).collect()
    assert r.near_next == 1


def test_likeness_tells_edits_from_neighbours(spark):
    got = imatch.imatch(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    big = got[got.n_chars > 400]
    assert big.near_edited.mean() > 0.4
    assert big.near_next.median() < 0.05
    assert (big.near_edited > big.near_next).mean() > 0.97


@functools.cache
def hashed(word):
    return int(imatch.words_of([word], lower=True)[0][0])


def plain_print(text, n, df):
    """The fingerprint of ``imatch.written``, lexicon by lexicon over the text's own words."""
    terms = set(WORD.findall(lowered(text)))
    band = {w for w in terms if n * math.exp(-imatch.HIGH) <= df[w] <= n * math.exp(-imatch.LOW)} or terms
    if not terms:
        return ""
    mask, out = 2**64 - 1, []
    mixed = lambda a, b: int(imatch.mix(np.array([a & mask], np.uint64), np.array([b & mask], np.uint64))[0])
    value = {w: mixed(hashed(w), hashed(w)) | 1 for w in band}
    out.append(f"{mixed(sum(value.values()), len(band)) | 1:016x}")
    digits = imatch._DIGITS.tobytes().decode()
    for k in range(1, imatch.DENSITIES + 1):
        level = ""
        for i in range(imatch.LEXICONS):
            total, some = 0, False
            for w in band:
                c = ((hashed(w) >> 32) ^ int(imatch._XOR[i, 0])) * int(imatch._ODD[i, 0]) % 2**32
                c = (c ^ (c >> 15)) * 0x2C1B3C6D % 2**32
                c ^= c >> 13
                if c < 4.0**-k * 2**32:
                    total, some = total + value[w], True
            code = mixed(total, total)
            level += digits[(code >> 58) + 1] + digits[((code >> 52) & 63) + 1] if some else "--"
        if set(level) == {"-"}:
            break
        out.append(level)
    return "|".join(out)


def test_fingerprints_as_plainly_built(spark):
    data = [r for r in rows() if len(r[1] or "") < 900]
    df = Counter(w for r in data for w in set(WORD.findall(lowered(r[1] or ""))))
    want = {}
    for r in data:
        want[r[1] or ""] = want.get(r[1] or "") or plain_print(r[1] or "", len(data), df)
    text = {(d, hashlib.sha256(e.encode()).hexdigest()): t for d, t, e in edits(data)}
    got = imatch.imatch(frame(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.fingerprint == want[text[r.doc_id, r.edited_sha256]]


def test_likeness():
    def plain(a, b):
        if a == b:
            return 1.0
        if not a or not b:
            return 0.0
        pairs = lambda p: [p[i : i + 2] for i in range(0, len(p), 2)]
        one, two = [pairs(p) for p in a.split("|")[1:]], [pairs(p) for p in b.split("|")[1:]]
        none = ["--"] * imatch.LEXICONS
        for k in reversed(range(max(len(one), len(two)))):
            both = [(x, y) for x, y in zip(one[k] if k < len(one) else none, two[k] if k < len(two) else none) if {x, y} != {"--"}]
            if k == 0 or 2 * len(both) >= imatch.LEXICONS:
                return sum(x == y for x, y in both) / len(both)
        return 0.0

    r = np.random.default_rng(3)
    terms = r.integers(0, 2**64, 40000, dtype=np.uint64)
    pieces = [terms[a:b] for a, b in [(0, 0), (0, 1), (0, 3), (1, 4), (0, 90), (10, 100), (0, 40000), (2000, 40000)]]
    codes = imatch.lexicon_codes(np.concatenate(pieces), np.cumsum([0, *map(len, pieces)]), terms[:0])
    prints = imatch.written(*codes)
    for i, a in enumerate(prints):
        for j, b in enumerate(prints):
            one, two = (tuple(x[k : k + 1] for x in codes) for k in (i, j))
            assert imatch.likeness(one, two)[0] == pytest.approx(plain(a, b))


def test_ranges_only_divide_the_work(spark, monkeypatch):
    whole = imatch.imatch(frame(spark)).collect()
    monkeypatch.setattr(imatch, "RANGE", 500)
    assert sorted(map(str, imatch.imatch(frame(spark)).collect())) == sorted(map(str, whole))
