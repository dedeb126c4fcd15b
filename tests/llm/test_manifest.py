"""The Merkle manifest against a plain tree."""

import zlib
from hashlib import sha256

import pytest

from eodlake.llm import manifest as M
from tests.compare import connect, same
from tests.llm.fixtures import SCHEMA, frame, rows


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n, text)])


def up(level):
    """All levels of a tree, leaves first."""
    out = [level]
    while len(level) > 1:
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        out.append(level)
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 16 * 16
        out.append((level[run:i], level[i + 1 : run + 16]))
        i //= 16
    return out


def plain(data):
    groups = {}
    for r in data:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(*r)))
        trees[s] = up([leaf(*r) for r in groups[s]])
    top = up([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            d = leaf(r[0], text, *r[2:])
            for a, b in path:
                d = h(*a, d, *b)
            root = top[-1][0]
            out.append((r[0], leaf(*r), trees[s][-1][0], root, h(*[x for a, b in path for x in (*a, *b)]), d, d == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    return [tuple(r) for r in df.select(COLUMNS).collect()]


@pytest.mark.parametrize("case", ["awkward", "deep", "many sources", "one", "equal rows"])
def test_against_a_plain_tree(spark, case):
    data = {
        "awkward": rows(),
        "deep": [(i, f"Text {i}", "en", "a" if i % 5 else "b", i) for i in range(700)],
        "many sources": [(i, "T", "en", f"s{i % 41}é" if i % 41 else None, i) for i in range(120)],
        "one": [(5, "Only", None, None, None)],
        "equal rows": [(3, "Same", "en", "a", 4)] * 300 + [(i, "Other", "en", "b", 5) for i in range(20)],
    }[case]
    got = found(M.manifest(frame(spark, data)))
    assert sorted(map(repr, got)) == sorted(map(repr, plain(data)))
    if case == "deep":
        assert 0 < sum(not r[-1] for r in got) < len(got)


def test_some_requests_only(spark):
    data = [(i, f"Text {i}", "en", "a", i) for i in range(600)]
    df = spark.createDataFrame([(0, i, leaf(*r)) for i, r in enumerate(data)], "t int, rank long, digest string")
    sizes = df.groupBy("t").count().withColumnRenamed("count", "n")
    trees = M.Trees(df.join(sizes, "t"), sizes, "t")
    asked = df.where("rank in (0, 17, 255, 256, 599)")
    top = trees.tops.selectExpr("t", "digest", "height", "cast(array() as array<struct<before: string, after: string>>) as above")
    levels = up([leaf(*r) for r in data])
    got = trees.descend(asked, top).collect()
    assert len(got) == 5
    for r in got:
        assert r.found == r.digest
        assert [(s.before, s.after) for s in r.path] == [("".join(a), "".join(b)) for a, b in siblings(levels, r["rank"])]


def test_empty(spark):
    df = M.manifest(spark.createDataFrame([], SCHEMA))
    assert df.columns and df.count() == 0


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    same(M.op13_merkle(spark, folder), connect(folder), M.SQL)
