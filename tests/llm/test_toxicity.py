"""The toxicity classifier: exactness of its parts, unseen misspellings, accuracy on held-out rows, awkward tables."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from eodlake.llm import toxicity as T
from tests.llm.fixtures import SCHEMA, frame, rows

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed, bad=("blarghish", "snorfle", "grumphet")):
    r = random.Random(seed)
    vocab = ["".join(r.choices("aeioulmnrst", k=r.randint(2, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        words = r.choices(vocab, k=r.choice([5, 30, 200]))
        y = int(i % 4 == 0)
        if y:
            for _ in range(1 + len(words) // 60):
                words.insert(r.randrange(len(words)), r.choice(bad))
        out.append((" ".join(words), y))
    return out


def model():
    data = corpus(600, 1)
    return T.SubwordBags(rounds=60, least=10).fit([t.encode() for t, _ in data], np.array([y for _, y in data], float))


def test_subwords_are_the_marked_word_and_its_grams():
    ids, at = T.subwords(["abc", "é", "abcd"], 1 << 18)
    assert np.diff(at).tolist() == [1 + 3 + 2 + 1, 1 + 1, 1 + 4 + 3 + 2]  # <abc>: 3, 2 and 1 grams; <é>: 1; <abcd>: 4, 3 and 2
    assert set(ids[at[0] : at[1]]) & set(ids[at[2] : at[3]])  # <ab, <abc, abc are shared
    assert ids[at[1] : at[2]].tolist() == T.subwords(["é"], 1 << 18)[0].tolist()


def test_scores_are_the_plain_softmax():
    m = model()
    texts = [b"snorfle and lemon", "Snorfle x  é".encode(), b"", b" \n", b"a" * 5000]
    for t, got in zip(texts, m.score(texts)):
        odds = 0.0
        for w in {w for w in t.decode().lower().replace("\n", " ").split(" ") if w}:
            ids, _ = T.subwords([w], m.buckets)
            odds += np.exp(m.table[ids].mean() + m.bias)
        want = odds / (1 + odds) if odds else 1 / (1 + np.exp(-m.none))
        assert abs(got - want) < 1e-9


def test_unseen_texts_and_misspellings():
    m = model()
    data = corpus(300, 2)
    p = m.score([t.encode() for t, _ in data]) >= 0.5
    y = np.array([y for _, y in data], bool)
    assert p[y].mean() > 0.9 and p[~y].mean() < 0.1
    good, bad = m.score([b"lemon snorfling rat", b"lemon storing rat"])
    assert good > bad


def test_slices_change_nothing(monkeypatch):
    m = model()
    texts = [t.encode() for t, _ in corpus(20, 3)]
    whole = m.score(texts)
    monkeypatch.setattr(T, "SLICE", 7)
    assert np.allclose(whole, m.score(texts))


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in T.op11_toxicity(spark, folder).collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(y, got[i].predicted) for i, y in labels if got[i].held_out]
    clean = [p for y, p in held if not y]
    assert sum(clean) / len(clean) < 0.1
    assert sum(y == p for y, p in held) / len(held) > 0.9


def test_labels_of_held_out_rows_are_not_read(spark):
    data = [(i, t, "en", "s", 1) for i, (t, _) in enumerate(corpus(80, 4))]
    labels = [(i, 1, y) for i, (_, y) in enumerate(corpus(80, 4))]
    other = [(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in labels]
    a, b = ({r.doc_id: r.score for r in T.toxicity_scores(frame(spark, data), spark.createDataFrame(x, LABELS)).collect()} for x in (labels, other))
    assert a == b


def test_awkward_tables(spark):
    labels = spark.createDataFrame([(i * 3 + 1, 1, i % 2) for i in range(60)] + [(None, 1, 1), (4, 1, None), (7, 0, 1)], LABELS)
    got = T.toxicity_scores(frame(spark), labels.withColumn("text", F.lit("x"))).collect()
    assert len(got) == len(rows())
    for r in got:
        assert 0 <= r.score <= 1
    nothing = {round(r.score, 9) for r in got if r.doc_id in (500, 501, 502)}
    assert len(nothing) == 1
    assert {r.score for r in T.toxicity_scores(frame(spark), spark.createDataFrame([], LABELS)).collect()} == {0.5}
    assert T.toxicity_scores(spark.createDataFrame([], SCHEMA), labels).count() == 0
