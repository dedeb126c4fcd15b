import hashlib

import numpy as np
import pyarrow as pa
import pytest

from eodlake.llm import repeats, substrings
from tests.llm.fixtures import SCHEMA, WORD, frame, rows

BIG = 2**63


def brute(data, split, join, win):
    docs = [(BIG if d is None else d, split((t or "").encode())) for d, t, *_ in data]
    least = {}
    for d, s in docs:
        for i in range(len(s) - win + 1):
            k = join(s[i : i + win])
            least[k] = min(d, least.get(k, BIG))
    out = []
    for d, s in docs:
        gone = [False] * len(s)
        for i in range(len(s) - win + 1):
            if least[join(s[i : i + win])] < d:
                gone[i : i + win] = [True] * win
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = join([x for x, g in zip(s, gone) if not g])
        out.append((None if d == BIG else d, len(s), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def order(x):
    return sorted(x, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("small", [False, True])
def test_suffix(spark, monkeypatch, small):
    if small:  # many flushes and pieces
        monkeypatch.setattr(repeats, "FLUSH_RUNS", 100)
        monkeypatch.setattr(repeats, "BLOCK", 200)
        monkeypatch.setattr(repeats, "HEAVY", 3)
        monkeypatch.setattr(repeats, "MOST_HEAVY", 500)
        monkeypatch.setattr(repeats, "LOCALLY", 2)
    got = [tuple(r) for r in substrings.suffix_dedup(frame(spark)).collect()]
    assert order(got) == order(brute(rows(), lambda b: [b[i : i + 1] for i in range(len(b))], b"".join, 50))


def test_words(spark):
    got = [tuple(r) for r in substrings.seed_extend_dedup(frame(spark)).collect()]
    want = [(d, n, k, h) for d, n, k, _, h in brute(rows(), WORD.findall, b" ".join, 50)]
    assert order(got) == order(want)


def test_empty(spark):
    assert substrings.suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    assert substrings.seed_extend_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in substrings.suffix_dedup(docs).collect()]
    assert order(got) == order(brute(data, lambda b: [b[i : i + 1] for i in range(len(b))], b"".join, 50))
    got = [tuple(r) for r in substrings.seed_extend_dedup(docs).collect()]
    assert order(got) == order([(d, n, k, h) for d, n, k, _, h in brute(data, WORD.findall, b" ".join, 50)])


def test_hash_ranges_hold_about_the_same(spark):
    """Anchors are minima of hashes; dealt as they are, the first range held 17 times the mean."""
    r = np.random.default_rng(1)
    texts = [bytes(r.integers(97, 123, 20_000, dtype=np.uint8)).decode() for _ in range(20)]
    sent = pa.RecordBatch.from_pydict({"did": list(range(20)), "tag": pa.array([0] * 20, pa.int32()), "text": texts})
    held = np.zeros(64, int)
    for batch in repeats.mapper(substrings.bytes_of, 50, 64, np.empty(0, np.uint64))([sent]):
        np.add.at(held, batch.column("part").to_numpy(), batch.column("n").to_numpy())
    assert held.sum() > 15_000 and held.max() < 2 * held.mean()
