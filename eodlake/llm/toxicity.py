"""Toxicity classifier: character n-gram embeddings, averaged by word, under a linear softmax learnt jointly with them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.llm.common import chunks, crc_mod, grams, joined, mix, saved, table, words

#: Labelled documents that the model is fitted on at most (the first in hash order), and bytes of their texts; the fit runs on the driver.
MOST_LABELLED, MOST_BYTES = 4_000, 12 << 20
THRESHOLD = 0.5
#: Lengths of the n-grams of a word between its boundary marks; the whole word counts as one more.
LENGTHS = (3, 4, 5)
#: Code points of spellings whose n-grams are held at once.
SLICE = 1 << 17
_SEED = np.uint64(0x51ED270B)


def word_bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Distinct words of each whole text in lower case: (text, spelling) pairs in order of the text, and all spellings."""
    b, at = joined([t.decode("utf-8", "replace").lower().encode() for t in texts])
    h, start, end = words(b)
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0])) if len(h) else np.empty(0, np.int64)
    which = np.empty(len(h), np.int64)
    which[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(h))))
    raw = b.tobytes()
    spellings = [raw[start[i] : end[i]].decode("utf-8", "replace") for i in order[new]]
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, at)))
    pair = np.sort(text * len(spellings) + which)
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(pair) else pair
    return pair // max(len(spellings), 1), pair % max(len(spellings), 1), spellings


def subwords(spellings: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each feature of each spelling and where each spelling's features begin: the marked word itself and its n-grams."""
    marked = [f"<{w}>" for w in spellings]
    n = np.array([len(w) for w in marked], np.int64)
    cp = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(n)), n)
    h = mix(cp, np.full(len(cp), _SEED))
    place = np.arange(len(cp)) - np.repeat(np.cumsum(n) - n, n)
    ids, owners = [], []
    whole = np.zeros(len(n), np.uint64)
    if len(n):
        whole = np.add.reduceat(mix(h, place.astype(np.uint64)), np.cumsum(n) - n)
    ids.append(whole)
    owners.append(np.arange(len(n)))
    for k in LENGTHS:
        if len(cp) >= k:
            inside = owner[k - 1 :] == owner[: len(cp) - k + 1]
            ids.append(mix(grams(h, k)[inside], np.full(int(inside.sum()), np.uint64(k))))
            owners.append(owner[: len(cp) - k + 1][inside])
    ids, owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ((ids[order] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), np.searchsorted(owners[order], np.arange(len(n) + 1))


def _odds(margin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of the odds of each run of words."""
    top = np.maximum.reduceat(margin, at)
    each = np.exp(margin - np.repeat(top, np.diff(np.append(at, len(margin)))))
    return top + np.log(np.add.reduceat(each, at))


class SubwordBags:
    """Embeddings of subwords, averaged to one vector a word, and a linear softmax of two classes over that vector.

    A bag is one word, so a misspelt word is judged by the subwords that it shares with known ones. A text's odds are the sum of the odds of
    its distinct words, so a few words count in a long text as in a short one. Subwords of fewer than
    ``least`` training texts have no embedding and count as zeros. All parameters are learnt together on whole-batch gradients of the
    texts' log loss (Adam, its steps falling to zero). A softmax of sums is a sum over subwords, so scoring keeps one number a bucket:
    its embedding times the difference of the classes' weights.
    """

    def __init__(self, buckets: int = 1 << 18, dim: int = 4, rounds: int = 80, rate: float = 0.05, decay: float = 0.003, least: int = 30, seed: int = 7):
        self.buckets, self.dim, self.rounds, self.rate, self.decay, self.least, self.seed = buckets, dim, rounds, rate, decay, least, seed

    def fit(self, texts: list[bytes], y: np.ndarray) -> SubwordBags:
        rng = np.random.default_rng(self.seed)
        share = (y.sum() + 1) / (len(y) + 2)
        self.bias, self.none, self.table, self.learnt = 0.0, float(np.log(share / (1 - share))), np.zeros(self.buckets), False
        text, word, spellings = word_bags(texts)
        if not len(word) or not 0 < y.sum() < len(y):
            return self
        texts_of = np.bincount(word, minlength=len(spellings))
        known, n = np.zeros(self.buckets), np.empty(len(spellings), np.int64)
        for part, sub, owner in self._sliced(spellings):
            n[part] = np.bincount(owner, minlength=len(part))
            known += np.bincount(sub, texts_of[part][owner], self.buckets)  # a text counts once for each of its words
        names = np.flatnonzero(known >= self.least)
        if not len(names):
            return self
        place = np.full(self.buckets, -1, np.int32)
        place[names] = np.arange(len(names))
        kept = [(place[sub][hit], (owner[hit] + part[0]).astype(np.int32)) for part, sub, owner in self._sliced(spellings) if (hit := place[sub] >= 0) is not None]
        sub, owner = (np.concatenate(x) for x in zip(*kept))
        del kept
        by_sub = np.argsort(sub, kind="stable").astype(np.int32)
        sub_at, owner_by_sub = np.searchsorted(sub[by_sub], np.arange(len(names))), owner[by_sub]
        word_at = np.flatnonzero(np.diff(owner, prepend=-1))
        has = owner[word_at]
        text_at = np.flatnonzero(np.diff(text, prepend=-1))
        some, per = text[text_at], np.diff(np.append(text_at, len(text)))
        scale = (1 / n).astype(np.float32)
        e = rng.normal(0, 0.1, (self.dim, len(names))).astype(np.float32)
        w, bias = rng.normal(0, 1, (2, self.dim)).astype(np.float32), np.array([0.0, -np.log(per.mean())], np.float32)
        params = [e, w, bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))[some]
        weight /= weight.sum()
        runs = lambda x, at: np.add.reduceat(x, at, axis=1)
        for k in range(1, self.rounds + 1):
            slower = np.float32(1 - (k - 1) / self.rounds)
            vec = np.zeros((self.dim, len(spellings)), np.float32)
            vec[:, has] = runs(np.take(e, sub, 1), word_at) * scale[has]
            logit = w @ vec + bias[:, None]
            margin = (logit[1] - logit[0]).astype(float)[word]
            odds = _odds(margin, text_at)
            slope = (1 / (1 + np.exp(-odds)) - y[some]) * weight
            slope = np.repeat(slope, per) * np.exp(margin - np.repeat(odds, per))
            slope = np.bincount(word, slope, len(spellings)).astype(np.float32)
            g_logit = np.stack([-slope, slope])
            g_e = runs(np.take((w.T @ g_logit) * scale, owner_by_sub, 1), sub_at) + np.float32(self.decay / len(names)) * e
            for i, (g, rate) in enumerate(((g_e, self.rate), (g_logit @ vec.T, self.rate), (g_logit.sum(1), 4 * self.rate))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                params[i] -= slower * rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
        self.table[names] = (w[1] - w[0]) @ e  # the classes differ by this much
        self.bias, self.learnt = float(bias[1] - bias[0]), True
        return self

    def _sliced(self, spellings: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Slices of the spellings, the buckets of their subwords and which of the slice each belongs to."""
        size = np.cumsum([len(x) + 2 for x in spellings]) // SLICE
        for part in np.split(np.arange(len(spellings)), np.flatnonzero(np.diff(size)) + 1):
            sub, begin = subwords(spellings[part[0] : part[-1] + 1], self.buckets)
            yield part, sub, np.repeat(np.arange(len(part)), np.diff(begin))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of whole texts; a text without words gets the share of label 1 in training."""
        text, word, spellings = word_bags(texts)
        out = np.full(len(texts), self.none)
        if len(word) and self.learnt:
            margin = np.empty(len(spellings))
            for part, sub, owner in self._sliced(spellings):
                n = np.bincount(owner, minlength=len(part))
                margin[part] = np.bincount(owner, self.table[sub], len(part)) / n + self.bias
            text_at = np.flatnonzero(np.diff(text, prepend=-1))
            out[text[text_at]] = _odds(margin[word], text_at)
        return 1 / (1 + np.exp(-out))


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 5, most: int = MOST_LABELLED, most_bytes: int = MOST_BYTES) -> SubwordBags:
    """The model of at most ``most`` labelled documents of at most ``most_bytes`` together whose crc32(doc_id) mod ``folds`` isn't 0.

    The sample is chosen by the labels' ids alone and written with its texts; the bytes before a document are summed over
    that bounded table.
    """
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    y = labels.select("doc_id", F.col("toxic").cast("double").alias("y")).where("doc_id is not null and y is not null").where(crc_mod("doc_id", folds) != 0)
    y = y.where(share < most / max(y.count(), 1)).orderBy(share, "doc_id", "y").limit(most)
    sample = saved(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(y), "doc_id"), "toxic")  # at most ``most`` narrow rows
    before = F.sum(F.octet_length("text")).over(W.orderBy(share, "doc_id", "y", F.xxhash64("text")))
    narrow = sample.select("doc_id", "y", F.xxhash64("text").alias("t"), (before <= most_bytes).alias("fits")).where("fits").drop("fits")
    rows = sample.withColumn("t", F.xxhash64("text")).join(narrow.distinct(), ["doc_id", "y", "t"], "left_semi").orderBy("doc_id", "t", "y").limit(2 * most).select("text", "y").toPandas()
    return SubwordBags().fit([t.encode() for t in rows["text"]], rows["y"].to_numpy())


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Inputs of a score are the subwords of the whole text only. The model is one number a bucket, a megabyte whatever the data. Null, empty and blank
    texts get the share of label 1 in training; without labels of both kinds every score is that share (1/2 without any); rows with
    equal ids are scored each; a label of a null id is ignored; an empty table gives no rows; other columns are ignored.
    """
    model = fitted(docs, labels)
    model.table = model.table.astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, texts in chunks(batches, ["doc_id", "text"], "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(model.score(texts), pa.float64())], names=["doc_id", "score"])

    s = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return s.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
