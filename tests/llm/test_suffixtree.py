import random
import zlib
from collections import Counter, defaultdict
from functools import cache
from math import isclose, log, log10

import numpy as np
import pandas as pd

from eodlake.llm import common, suffixtree
from tests.llm.fixtures import SCHEMA, WORD, frame, key, rows


VOCABULARY = [f"common{k}" for k in range(40)]


def base(data):
    docs = [(d, [*WORD.findall((t or "").encode().lower()), None]) for d, t, *_ in data]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in docs]
    c = Counter(w for (_, ws), h in zip(docs, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(log10((c[w] + 1) / (n + v + 1)) for w in ws)) for (d, ws), h in zip(docs, held)]


def test_base(spark):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in suffixtree.lm_scores(frame(spark)).collect()), key=lambda r: (key(r[0]), r[2:]))
    want = sorted(base(rows()), key=lambda r: (key(r[0]), r[2:]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(isclose(g[5], w[5], rel_tol=1e-9) for g, w in zip(got, want))


def test_empty(spark):
    assert suffixtree.lm_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def plain(data, order=suffixtree.ORDER, letters=suffixtree.LETTERS):
    """The model by its definition: (doc_id, log10 probability) of each text."""

    def states(ws, i):
        return [(), *[w[-suffixtree.ENDING :] for w in ws[max(i - 1, 0) : i]], *[tuple(ws[i - k : i]) for k in range(1, min(i, order) + 1)]]

    docs = [(d, [*WORD.findall((t or "").encode().lower()), None], zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2) for d, t, *_ in data]
    train = [ws for _, ws, held in docs if not held]
    follow = defaultdict(Counter)
    for ws in train:
        for i, w in enumerate(ws):
            for context in states(ws, i):
                follow[context][w] += 1
    root = follow[()]
    n, v = sum(root.values()), len(root)
    spell = defaultdict(Counter)
    for w in root:
        if w is not None:
            s = [None, *w, 32]
            for i in range(1, len(s)):
                for k in range(min(i, letters) + 1):
                    spell[tuple(s[i - k : i])][s[i]] += 1

    def spelled(w):
        s, out = [None, *w, 32], 0.0
        for i in range(1, len(s)):
            p = 1 / 257
            for k in range(min(i, letters) + 1):
                c = spell.get(tuple(s[i - k : i]))
                if not c:
                    break
                total = sum(c.values())
                if k:
                    below = spell[tuple(s[i - k + 1 : i])]
                    gain = sum(x * (log(x / total) - log(below[y] / sum(below.values()))) for y, x in c.items())
                    if total < suffixtree.FEWEST or gain < suffixtree.GAIN * len(c):
                        continue
                p = (c[s[i]] + len(c) * p) / (total + len(c))
            out += log10(p)
        return out

    @cache
    def kept(contexts):
        c = follow[contexts[-1]]
        total, kinds = sum(c.values()), len(c)
        if total < suffixtree.FEWEST:
            return False
        gain = -total * log(total - 1 + kinds) + sum(log(kinds) if x == 1 else x * (log(x - 1) - log(chance(contexts[:-1], y))) for y, x in c.items())
        return gain >= suffixtree.GAIN

    @cache
    def chance(contexts, w):
        if len(contexts) == 1:
            return (root[w] or max(v, 1)) / max(n + v, 1)
        p = chance(contexts[:-1], w)
        if contexts[-1] in follow and kept(contexts):
            c = follow[contexts[-1]]
            p = (c[w] + len(c) * p) / (sum(c.values()) + len(c))
        return p

    return [(d, sum(log10(chance(tuple(states(ws, i)), w)) + (spelled(w) if w is not None and not root[w] else 0) for i, w in enumerate(ws))) for d, ws, _ in docs]


def test_score(spark):
    data = rows() + [(600 + k, "some phrase of the same words again and again. " * (k % 3 + 1), "en", "s", 1) for k in range(6)]
    got = sorted(((r.doc_id, r.score) for r in suffixtree.lm_scores(frame(spark, data)).collect()), key=lambda r: (key(r[0]), r[1]))
    want = sorted(plain(data), key=lambda r: (key(r[0]), r[1]))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(isclose(g[1], w[1], rel_tol=1e-5) for g, w in zip(got, want))


def test_spellings_sum_to_one():
    words = [b"that", b"this", b"the", b"on", "für".encode(), b"thousands"]
    lengths = np.array([len(w) for w in words])
    gram = suffixtree.grams_of(np.frombuffer(b"".join(words), np.uint8), lengths)[0]
    entries = Counter((d, int(g) & (1 << 8 * d + 8) - 1) for g in gram for d in range(suffixtree.LETTERS + 1) if int(g) >> 8 * d & 255 != suffixtree.NONE)
    tree = suffixtree.Tree(*(np.array(x) for x in zip(*[(*k, c) for k, c in entries.items()])))
    for context in (b"\t\t\t\t ", b"\t\t\t t", b"\t tho", b"zzzzz"):
        grams = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256) if x != suffixtree.NONE], np.uint64)
        assert 0.99 < (10 ** tree.log10(grams)).sum() <= 1 + 1e-9


def test_the_tree_of_letters_in_slices(spark, monkeypatch):
    whole = {(r.doc_id, r.n_tokens): r.score for r in suffixtree.lm_scores(frame(spark)).collect()}
    monkeypatch.setattr(suffixtree, "MOST_STATES", 50)
    for r in suffixtree.lm_scores(frame(spark)).collect():
        assert isclose(r.score, whole[r.doc_id, r.n_tokens], rel_tol=1e-9)


def test_noise_and_shuffled_words_are_unlikely(spark):
    """Random letters are the least likely of all texts; a text with phrases is likelier than the same words in another order."""
    r = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    fold = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    ids = [d for d in range(10**7, 10**7 + 100) if fold(d)]
    prose = docs.where("lang = 'en' and length(text) > 3000").orderBy("doc_id").first().text if "lang" in docs.columns else docs.where("length(text) > 3000").orderBy("doc_id").first().text
    words = prose.split()
    r.shuffle(words)
    noise = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(4, 9))) for _ in range(300))
    extra = spark.createDataFrame([(ids[0], noise), (ids[1], prose), (ids[2], " ".join(words))], "doc_id long, text string")
    got = suffixtree.lm_scores(docs.unionByName(extra)).toPandas()
    got = got[got.n_tokens >= 50]
    each = (got.score / got.n_tokens).set_axis(got.doc_id)
    assert each[ids[0]] < each.drop(ids[0]).quantile(0.01)
    assert each[ids[1]] > each[ids[2]]
    assert each[got[~got.held_out].doc_id].median() > each[got[got.held_out & (got.doc_id < 10**7)].doc_id].median()


def test_held_out_texts_are_likelier_than_by_frequency(spark):
    got = suffixtree.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (got.score < 0).all()


def test_order_of_words_counts(spark):
    fold = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    train = [d for d in range(400) if not fold(d)][:40]
    a, b = [d for d in range(400) if fold(d)][:2]
    phrase = [f"word{k}" for k in range(30)]
    shuffled = phrase[::3] + phrase[2::3] + phrase[1::3]
    data = [(d, " ".join(phrase), "en", "s", 1) for d in train] + [(a, " ".join(phrase), "en", "s", 1), (b, " ".join(shuffled), "en", "s", 1)]
    got = {r.doc_id: r for r in suffixtree.lm_scores(spark.createDataFrame(data, SCHEMA)).collect()}
    assert isclose(got[a].base_score, got[b].base_score)
    assert got[a].score > got[b].score + 10


def test_a_word_is_scored_by_its_longest_context(spark):
    """After "x c" comes y, after "z c" comes w: the word before last decides, however few of all words these are."""
    fold = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    train, (a, b) = [d for d in range(400) if not fold(d)][:20], [d for d in range(400) if fold(d)][:2]
    data = [(d, "x c y" if k % 2 else "z c w", "en", "s", 1) for k, d in enumerate(train)]
    got = {r.doc_id: r for r in suffixtree.lm_scores(spark.createDataFrame([*data, (a, "x c y", "en", "s", 1), (b, "x c w", "en", "s", 1)], SCHEMA)).collect()}
    assert got[a].score > got[b].score + 0.5


def test_rare_contexts_stay_in_a_large_corpus(spark):
    """After "x c" comes y, after "z c" comes w, 10 times each among 200,000 other words."""
    fold = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    train, (a, b) = [d for d in range(400) if not fold(d)][:2], [d for d in range(400) if fold(d)][:2]
    data = [(train[0], "x c y z c w " * 10, "en", "s", 1), (train[1], " ".join(random.Random(1).choices(VOCABULARY, k=200_000)), "en", "s", 1), (a, "x c y common1", "en", "s", 1), (b, "x c w common1", "en", "s", 1)]
    got = {r.doc_id: r for r in suffixtree.lm_scores(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[a].score > got[b].score + 0.5


def test_buckets_leave_no_name_in_the_catalog(spark):
    before = spark.catalog.listTables()
    dealt = common.bucketed(spark.range(200).selectExpr("id % 20 AS k", "id"), "k", 4, "test")
    assert spark.catalog.listTables() == before
    assert {(r.k, r["count"]) for r in dealt.groupBy("k").count().collect()} == {(k, 10) for k in range(20)}
    plan = dealt.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_walk_sums_up_only_what_it_sends():
    """A round goes over the answered ones again; what those sent was summed up once more each time."""
    words = [b"one", b"two", b"three"]
    n = np.array([4, 3], np.int64)
    row = {"block": 0, "doc_id": np.array([1, 2], np.int64).tobytes(), "held": np.zeros(2, bool).tobytes(), "n_words": n.tobytes(), "word": suffixtree.NUMBERS.pack(x=np.array([0, 1, 0, 1, 0, 1, 2], np.uint32)), "letters": b"".join(words), "lengths": np.array([len(w) for w in words], np.uint32).tobytes(), "answers": []}
    kinds = tokens = 0
    for k in range(suffixtree.ROUNDS):
        for i, (form, key, sums) in enumerate(suffixtree.walked(suffixtree.Block(row), k, tokens, kinds)):
            assert callable(sums)
            found = sums()
            assert {len(x) for x in found.values()} == {len(key)}
            sent = pd.DataFrame([(0, 2 * k + i, 0, len(key), suffixtree.squeezed(form, {"key": key} | found))], columns=["block", "question", "part", "n", "sent"])
            back = suffixtree.reply(sent).iloc[0]
            if 2 * k + i == 0:
                kinds, tokens = int(back.kinds), int(back.tokens)
            row["answers"] = [*row["answers"], {"question": 2 * k + i, "part": 0, "n": len(key), "reply": back.reply}]
    total, chance = suffixtree.walked(suffixtree.Block(row), suffixtree.ROUNDS, tokens, kinds)
    assert (tokens, kinds, len(chance)) == (9, 4, 9) and total.tolist() == [3, 3, 1, 2] and (0 < chance).all() and (chance < 1).all()
