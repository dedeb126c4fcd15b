import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eodlake.llm import packing
from tests.llm.fixtures import SCHEMA
from tests.llm.test_operators import check_packed


KW = packing.public_tokenizer()


def some_documents(n=300, seed=3):
    r = random.Random(seed)
    return [[r.choice(range(200)) if r.random() < 0.6 else int(r.paretovariate(0.7)) % 5000 for _ in range(r.randint(1, 300))] + [1] for _ in range(n)]


def plain_scores(docs):
    """BM25 of every document for every other one's distinct terms."""
    df = Counter(t for d in docs for t in set(d))
    mean = sum(map(len, docs)) / len(docs)
    idf = {t: math.log1p((len(docs) - k + 0.5) / (k + 0.5)) for t, k in df.items()}
    tf = [Counter(d) for d in docs]
    weight = lambda j, t: idf[t] * tf[j][t] * 2.2 / (tf[j][t] + 1.2 * (0.25 + 0.75 * len(docs[j]) / mean))
    return [[sum(weight(j, t) for t in tf[i] if t in tf[j]) for j in range(len(docs))] for i in range(len(docs))], idf, mean


def plain_pack(n, scores, window):
    """The windows by the rule in ``pack_shard``'s docstring, one document at a time."""
    unused, out, out_now, carried = list(range(len(n))), [], [], None
    while unused or carried:
        seed, start = carried or (unused.pop(0), 0)
        take = min(window, n[seed] - start)
        out_now, room = [(seed, start, take)], window - take
        carried = (seed, start + take) if start + take < n[seed] else None
        while room and not carried and unused:
            ranked = sorted((i for i in unused if scores[seed][i] > 0), key=lambda i: (-scores[seed][i], i))[:48] or unused[:96]
            for i in [i for i in ranked]:
                if n[i] <= room:
                    out_now.append((i, 0, n[i]))
                    room -= n[i]
                    unused.remove(i)
                    if not room:
                        break
            rest = [i for i in ranked if i in unused]
            if room and rest:
                unused.remove(rest[0])
                out_now.append((rest[0], 0, room))
                carried, room = (rest[0], room), 0
        if not room:
            out.append(out_now)
            out_now = []
    return out, out_now


def shard_of(docs):
    scores, idf, mean = plain_scores(docs)
    dense = np.zeros(5001, np.float32)
    dense[list(idf)] = list(idf.values())
    return scores, dense, mean


def test_a_seed_looks_up_all_its_terms():
    docs = some_documents()
    scores, idf, mean = shard_of(docs)
    shard = packing.Shard([np.array(d, np.uint16) for d in docs], idf, mean)
    assert 0 < shard.common.sum() < len(np.unique(np.concatenate(docs)))  # both kinds of postings
    for i in (0, 17, 299):
        assert shard.scores(i) == pytest.approx(np.array(scores[i]), rel=1e-4, abs=1e-4)
    shard.used[[0, 5]] = True
    best = shard.neighbours(17)
    assert not {0, 5} & set(best.tolist()) and best[0] == 17
    kth = sorted((s for i, s in enumerate(scores[17]) if i not in (0, 5)), reverse=True)[packing.RANKED - 1]
    assert len(best) == packing.RANKED and min(scores[17][i] for i in best.tolist()) >= kth - 1e-3


def test_windows_as_by_the_plain_rule():
    docs = some_documents()
    scores, idf, mean = shard_of(docs)
    want, left = plain_pack([len(d) for d in docs], scores, 512)
    got = list(packing.pack_shard([np.array(d, np.uint16) for d in docs], idf, mean, 512))
    assert got[: len(want)] == want
    assert sum(k for w in got[len(want) :] for _, _, k in w) == sum(k for _, _, k in left)


def topics(n=600):
    """Documents of six topics, dealt in turn, with 30 words each that no other topic has."""
    r = random.Random(1)
    words = [["".join(r.choices("abcdefghijklmnop", k=7)) for _ in range(30)] for _ in range(6)]
    common = ["the", "of", "and", "to", "in", "is"]
    return [(i, " ".join(r.choice(words[i % 6] if r.random() < 0.5 else common) for _ in range(80)), "en", "s", 0) for i in range(n)]


@pytest.mark.parametrize("shard", [1 << 22, 30_000])
def test_windows_hold_neighbours(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard)  # one shard, or several which the cells must fill with alike documents
    data = topics()
    got = packing.pack(spark.createDataFrame(data, SCHEMA).repartition(3), **packing.public_tokenizer()).collect()
    check_packed(got, {d: t for d, t, *_ in data})
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, Counter())[r.doc_id % 6] += r.length
    assert sum(max(w.values()) for w in windows.values()) / sum(sum(w.values()) for w in windows.values()) > 0.85
    if shard < 1 << 22:
        assert len({s >> 40 for s in windows}) > 2


def test_cells_of_one_and_of_equal_vectors():
    one = packing.Cells([b"\x01" * packing.DIM], 16)
    assert one.of([b"\x01" * packing.DIM, b"\x00" * packing.DIM]).tolist() == [0, 0]
    same = packing.Cells([b"\x05" * packing.DIM] * 40, 16)
    assert len(set(same.of([b"\x05" * packing.DIM] * 3).tolist())) == 1


def test_encoder_keeps_few_pieces_between_batches():
    """A worker waits for its next task with what its encoder has learned, so that is bounded after each batch."""
    enc = packing.Encoder(KW["tokenizer"], KW["ranks"], most=50)
    texts = [" ".join(f"w{i}x{k}" for k in range(300)) for i in range(4)]
    for _ in range(2):
        assert enc.encode_batch(texts) == [enc.ids(t) for t in texts]
        assert len(enc.pieces) <= 50 and len(enc.start) <= 50


def test_tokenising_takes_few_bytes_at_a_time(monkeypatch):
    """Long texts are encoded a few at a time, and rows keep their order, nulls and empty texts with them."""
    taken, enc = [], packing.encoder(KW["tokenizer"], KW["ranks"])
    whole = enc.encode_batch
    monkeypatch.setattr(enc, "encode_batch", lambda texts: taken.append(sum(len(t.encode()) for t in texts)) or whole(texts))
    texts = [None, "", *["word é " * 40_000] * 5, "", None, "end"] + ["short text"] * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts) + 1)), pa.array(["left out", *texts])], names=["doc_id", "text"]).slice(1)
    out = list(packing.tokenised(KW["tokenizer"], KW["ranks"], 1)([batch]))
    ids = [(d, x) for b in out for d, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()) if x is not None]
    assert [d for d, _ in ids] == list(range(1, len(texts) + 1))
    assert ids[0][1] == ids[1][1] == ids[7][1] == ids[8][1] == np.array([1], enc.width).tobytes() and ids[2][1] == ids[6][1]
    longest = len(texts[2].encode())
    assert max(taken) < packing.STEP_BYTES + longest < 5 * longest and sum(taken) == sum(len((t or "").encode()) for t in texts)
