import random

import pytest

from eodlake.llm import minhash
from tests.llm.fixtures import SCHEMA, WORD, frame, key, rows


def brute(data, k):
    docs = []
    for d, t, *_ in data:
        ws = WORD.findall((t or "").encode().lower())
        docs.append((d, {tuple(ws[i : i + k]) for i in range(max(len(ws) - k + 1, 1))} if ws else set()))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(docs):
        for j, (_, b) in enumerate(docs[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), (True, 0)), key(d))
    return [(d, len(s), None if least[find(i)][0] else least[find(i)][1], key(d) == least[find(i)]) for i, (d, s) in enumerate(docs)]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=lambda r: (key(r[0]), r[1:2], str(r)))


def want(data, k):
    return sorted(brute(data, k), key=lambda r: (key(r[0]), r[1:2], str(r)))


@pytest.mark.parametrize("k", [2, 5])
def test_fixture(spark, k):
    assert got(minhash.near_dedup(frame(spark), k)) == want(rows(), k)


def test_loose_group(spark, monkeypatch):
    """Copies of one text with so many changes that most pairs lie around the threshold: strays and several cells."""
    monkeypatch.setattr(minhash, "CELL", 16)
    monkeypatch.setattr(minhash, "PER_LEADER", 10)
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    data = []
    for i in range(90):
        ws = list(base)
        for j in r.sample(range(120), r.choice([2, 3, 4, 5, 6])):
            ws[j] = f"x{r.random()}"
        data.append((i, " ".join(ws), "en", "s", 0))
    assert got(minhash.near_dedup(frame(spark, data), 2)) == want(data, 2)


def test_empty(spark):
    assert minhash.near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_filter_keeps_one_of_each_group(spark):
    docs = frame(spark)
    kept = minhash.near_filter(docs, 5).collect()
    # two documents of other groups may share an id, so ids alone don't count the groups
    want = {(d, t) for (d, t, *_), (_, _, _, first) in zip(rows(), brute(rows(), 5)) if first}
    assert len(kept) == len(want) and {(r.doc_id, r.text) for r in kept} == want
    assert kept[0].asDict().keys() == set(docs.columns)
