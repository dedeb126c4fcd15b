"""Quality classifier: a generalised additive model with pairwise interactions, learnt by cyclic boosting of shallow trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import chunks, crc_mod, frugal, joined, saved, steps, table, words

#: Labelled rows that the model is fitted on at most (the first in hash order); the fit runs on the driver.
MOST_LABELLED = 20_000
THRESHOLD = 0.3
NAMES = ["words", "word_length", "length_spread", "upper", "symbols", "digits", "bangs", "bars", "marks", "stops", "distinct", "doubled", "top_word", "plain", "short", "lines", "line_words", "other_bytes", "longest", "capitals"]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CHARS = np.stack(
    [
        _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _class(bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())),
        _class(b"0123456789"),
        _class(b"!?"),
        _class(b"|\\/<>{}[]_~^="),
        _class(b"#$%&*@+"),
        _class(b".,;:"),
        _class(b"\n"),
        _class(bytes(range(0x80, 0x100))),
        _class(b"abcdefghijklmnopqrstuvwxyz"),
    ],
    axis=1,
)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``NAMES`` per whole text; zeros for a text without words."""
    b, at = joined(texts)
    h, start, end = words(b)
    first = np.searchsorted(start, at)
    n_words, n_bytes = np.diff(first), np.maximum(np.diff(at) - 1, 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    chars = np.bincount(doc * 256 + b, minlength=256 * len(texts)).reshape(-1, 256) @ _CHARS
    upper, symbols, digits, bangs, bars, marks, stops, lines, other, lower = chars.T
    w = np.maximum(n_words, 1)
    word_doc = np.repeat(np.arange(len(texts)), n_words)
    length = (end - start).astype(float)
    add = lambda x: np.bincount(word_doc, x, len(texts))
    mean = add(length) / w
    spread = np.sqrt(np.maximum(add(length**2) / w - mean**2, 0))
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (word_doc[1:] == word_doc[:-1])
    letter = (_CHARS[:, 0] + _CHARS[:, 8] + _CHARS[:, 9]).astype(bool)
    ends = letter[b[end - 1]] if len(end) else np.zeros(0, bool)
    capital = (_CHARS[:, 0].astype(bool)[b[start]] if len(start) else np.zeros(0, bool)).astype(float)
    distinct, top, longest = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
    for i, (p, q) in enumerate(zip(first[:-1], first[1:])):
        if q > p:
            x = np.sort(h[p:q])
            edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]]))
            distinct[i], top[i], longest[i] = len(edge) - 1, np.diff(edge).max(), length[p:q].max()
    out = np.column_stack(
        [np.log1p(n_words), mean, spread, upper / np.maximum(upper + lower, 1), symbols / n_bytes, digits / n_bytes, bangs / n_bytes, bars / n_bytes, marks / n_bytes, stops / n_bytes, distinct / w, add(same) / w, top / w, add(ends.astype(float)) / w, add((length <= 3).astype(float)) / w, np.log1p(lines), n_words / (lines + 1), other / n_bytes, np.log1p(longest), add(capital) / w]
    )
    out[n_words == 0] = 0
    return out


class Additive:
    """Lookup tables: one of bins for each feature, one of bin pairs for each chosen pair of features.

    Cyclic boosting visits the features in turn and adds a tree of at most three cuts of that feature alone to its table,
    scaled by a small rate, so correlated features share the credit. When these are learnt, the pairs whose residuals
    a single cut on both features explains best get tables of their own, boosted the same way.
    """

    def __init__(self, rounds: int = 150, rate: float = 0.15, bins: int = 48, pairs: int = 8, pair_bins: int = 12, l2: float = 2.0):
        self.rounds, self.rate, self.bins, self.n_pairs, self.pair_bins, self.l2 = rounds, rate, bins, pairs, pair_bins, l2

    def _cuts(self, x: np.ndarray, bins: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]

    @staticmethod
    def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)])

    def _leaf(self, g, h):
        return g / (h + self.l2)

    def _tree(self, g: np.ndarray, h: np.ndarray, cuts: int = 3) -> np.ndarray:
        """Step values by bin: cut the bins where the gain is largest, a few times."""
        edges = [0, len(g)]
        cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
        worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + self.l2)
        for _ in range(cuts):
            best = (1e-9, None)
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > 1:
                    c = np.arange(a + 1, b)
                    gain = worth(a, c) + worth(c, b) - worth(a, b)
                    k = int(gain.argmax())
                    best = max(best, (float(gain[k]), int(c[k])), key=lambda t: t[0])
            if best[1] is None:
                break
            edges = sorted([*edges, best[1]])
        out = np.zeros(len(g))
        for a, b in zip(edges[:-1], edges[1:]):
            out[a:b] = self._leaf(cg[b] - cg[a], ch[b] - ch[a])
        return out

    def _quarters(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """The best cut of a table of bin pairs into four, its gain and its values."""
        cum = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        cg, ch = cum(g), cum(h)
        n, m = g.shape
        if n < 2 or m < 2:
            return 0.0, np.zeros_like(g)
        i, j = slice(1, n), slice(1, m)

        def parts(c):
            a = c[i, j]
            b, d = c[i, m : m + 1] - a, c[n : n + 1, j] - a
            return a, b, d, c[n, m] - a - b - d

        gs, hs = parts(cg), parts(ch)
        gain = sum(x**2 / (y + self.l2) for x, y in zip(gs, hs)) - cg[n, m] ** 2 / (ch[n, m] + self.l2)
        p, q = np.unravel_index(int(gain.argmax()), gain.shape)
        values = [self._leaf(x[p, q], y[p, q]) for x, y in zip(gs, hs)]
        out = np.empty_like(g)
        out[: p + 1, : q + 1], out[: p + 1, q + 1 :], out[p + 1 :, : q + 1], out[p + 1 :, q + 1 :] = values
        return float(gain[p, q]), out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        share = (y.sum() + 1) / (len(y) + 2)
        self.base, self.tables, self.pairs = float(np.log(share / (1 - share))), [], []
        self.cuts, self.pair_cuts = [np.empty(0)] * x.shape[1], [np.empty(0)] * x.shape[1]
        if len(y):
            self.cuts, self.pair_cuts = self._cuts(x, self.bins), self._cuts(x, self.pair_bins)
        b, pb = self._binned(x, self.cuts), self._binned(x, self.pair_cuts)
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        score = np.full(len(y), self.base)

        def slopes():
            p = 1 / (1 + np.exp(-score))
            return y - p, p * (1 - p)

        for _ in range(self.rounds if len(y) else 0):
            for f, t in enumerate(self.tables):
                g, h = slopes()
                step = self.rate * self._tree(np.bincount(b[:, f], g, len(t)), np.bincount(b[:, f], h, len(t)))
                t += step
                score += step[b[:, f]]
        g, h = slopes()
        found = []
        for f in range(x.shape[1]):
            for k in range(f + 1, x.shape[1]):
                shape = (len(self.pair_cuts[f]) + 1, len(self.pair_cuts[k]) + 1)
                at = pb[:, f] * shape[1] + pb[:, k]
                gain, _ = self._quarters(*(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
                found.append((gain, f, k, shape))
        chosen = [p for p in sorted(found, reverse=True)[: self.n_pairs] if p[0] > 0]
        self.pairs = [(f, k, np.zeros(shape)) for _, f, k, shape in chosen]
        for _ in range(self.rounds // 2 if len(y) else 0):
            for f, k, t in self.pairs:
                g, h = slopes()
                at = pb[:, f] * t.shape[1] + pb[:, k]
                step = self.rate * self._quarters(*(np.bincount(at, v, t.size).reshape(t.shape) for v in (g, h)))[1]
                t += step
                score += step.ravel()[at]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: the sum of the bins' values."""
        total = np.full(len(x), self.base)
        b, pb = self._binned(x, self.cuts), self._binned(x, self.pair_cuts)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for f, k, t in self.pairs:
            total += t[pb[:, f], pb[:, k]]
        return 1 / (1 + np.exp(-total))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_id, texts in chunks(batches, ["doc_id", "text"], "text", 1 << 20):
        x = features(texts)
        yield pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(frugal(_measure), "doc_id long, x array<double>")


def fitted(feature_rows: DataFrame, labels: DataFrame, folds: int = 5, most: int = MOST_LABELLED) -> Additive:
    """The model of at most ``most`` labelled rows whose crc32(doc_id) mod ``folds`` isn't 0."""
    y = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("doc_id is not null and y is not null").where(crc_mod("doc_id", folds) != 0)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    fraction = most / max(y.count(), 1)  # each task then sends its share of the bound only
    rows = feature_rows.join(y.where(share < fraction), "doc_id").orderBy(share, "doc_id", "y").limit(most).select("x", "y").toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, len(NAMES))
    return Additive().fit(x, rows["y"].to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Inputs of a score are shape measures of the whole text only (``NAMES``). Texts are measured once and the measures
    written; the model is a few tables of bins, far below a megabyte whatever the data. Null and empty texts
    measure as zeros and are scored like any other; without labels every score is 1/2; rows with equal ids are scored each;
    a label of a null id is ignored; an empty table gives no rows.
    """
    x = saved(measured(docs), "features")
    model = fitted(x, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(np.array(b.column("x").to_pylist())))], names=["doc_id", "score"])

    s = x.mapInArrow(score, "doc_id long, score double")
    return s.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that the classifier accepts. Their texts are measured as they pass; nothing is joined."""
    model = fitted(measured(docs), labels)
    return docs.mapInArrow(accepting(model, threshold), docs.schema)


def accepting(model: Additive, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in steps(whole, 256):
                texts = [(t or "").encode() for t in b.column("text").to_pylist()]
                yield b.filter(pa.array(model.score(features(texts)) >= threshold))

    return frugal(run)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
