"""Hard negatives against a plain search."""

import math
import random

import pytest
from pyspark.sql import functions as F

from eodlake.llm import negatives as N
from tests.compare import connect, same

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(data):
    fine = []
    for k, (i, v, label) in enumerate(data):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label
        fine.append((k, i, [math.floor(256 * x) for x in v], label))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for k, i, v, label in fine:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m == label) for q, j, w, m in fine if q != k]
        for p, pid, _ in sorted((t for t in scored if t[2]), key=order)[:5]:
            found = sorted((t for t in scored if not t[2] and 30 * p <= 100 * t[0] <= 90 * p), key=order)[:10]
            out += [(i, pid, r, nid, p, s) for r, (s, nid, _) in enumerate(found, 1)]
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def vectors(n, dim, seed, labels=10, step=None):
    r = random.Random(seed)
    draw = (lambda: r.choice(step)) if step else (lambda: r.gauss(0, 0.2))
    return [(i, [draw() for _ in range(dim)], r.randrange(labels)) for i in range(n)]


CASES = {
    "plain": vectors(450, 8, 1),
    "ties and zero scores": vectors(300, 3, 2, 3, [0.0, 0.25, -0.25]),
    "one label": vectors(120, 4, 3, 1),
    "no other label": [(i, [0.5, 0.5], 3) for i in range(0, 300, 3) if i % 7],
    "awkward": vectors(210, 4, 4, 2)
    + [(400, None, 1), (500, [0.1, None, 0.2, 0.3], 1), (600, [math.nan, 0.0, 0.0, 0.0], 0), (601, [math.inf, 0.0, 0.0, 0.0], 0), (700, [0.1] * 4, None)]
    + [(None, [0.4, 0.3, 0.2, 0.1], 0), (None, [0.1, 0.2, 0.3, 0.4], 1), (800, [], 0), (801, [0.3, 0.2], 0), (900, [0.4] * 6, 1)]
    + [(100, [0.3, 0.1, -0.2, 0.2], 0)] * 3
    + [(1000, [9e3, -7e4, 8e5, 1.0], 1), (1001, [3e4, -2e4, 9e5, 0.5], 1), (1002, [2e4, -1e4, 5e5, 0.5], 0)],
}


@pytest.mark.parametrize("case", CASES)
def test_against_a_plain_search(spark, case):
    df = spark.createDataFrame(CASES[case], SCHEMA).withColumns({c: F.lit(7) for c in ("anchor", "score", "rank", "chunk", "id")})
    assert found(N.hard_negatives(df.repartition(3))) == plain(CASES[case])


def test_many_blocks_and_chunks(spark):
    data = vectors(420, 4, 5, 3)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert found(N.hard_negatives(df, block=16, chunk=2)) == plain(data)
    assert found(N.hard_negatives(df, block=16, chunk=2, broadcast=0)) == plain(data)


def test_empty(spark):
    assert found(N.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    assert found(N.hard_negatives(spark.createDataFrame([(1, [0.5], 1)], SCHEMA))) == []


def test_scores_are_exact():
    import numpy as np

    big = np.array([[2.0**40, 3.0], [1e30, -1e30]])
    assert N._scores(big[:1], big[:1]).tolist() == [[N._HIGHEST]]
    assert N._scores(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]])).tolist() == [[2**60 + 1]]


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    same(N.op12_hard_negatives(spark, folder), connect(folder), N.SQL)
