"""Which windows of ``win`` symbols also start in a document with a smaller id: the core of both substring dedups.

Symbols are bytes or words. Every window is dealt by its *anchor*, the smallest hash of ``GRAM`` consecutive symbols
inside it (winnowing), so equal windows always meet, and neighbouring windows that share an anchor travel together as
one *run* of starts. A run's *class* hashes all symbols that its windows cover.

0. Anchors that very many different runs share (those at the edges of a common passage) are counted first. Their windows are
   dealt singly, by their own hash, as in step 3, so no range gets a share of all documents.
1. Map: each task finds the runs of its documents. Runs of a class that a smaller document of the same task has are
   repeats already; of the others one packed row for each range of anchors goes out.
2. Reduce, by anchor range: sort (anchor, class, id). A run whose class a smaller document has is a repeat as a whole;
   the smallest document of an anchor has none; others stay open if another document also has one half of what the
   anchor has around it.
3. Open runs go back to their texts, take along the hash of each single window, are sorted by (window, id), and each
   window's smallest document decides.
4. The starts found join their documents for whatever the operator wants to make of them.

Ids that repeat are told apart by a tag of the text; equal rows have equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import U64, chunks, give_back, grams, identified, let_go, mix, parts_for, saved

GRAM = 16
#: Runs that a task sorts at once, documents among them, and bytes of text hashed at once.
FLUSH_RUNS, FLUSH_DOCS, BLOCK = 250_000, 60_000, 1 << 18
#: An anchor is heavy from this many runs on, or from this share of all runs; and is reported by a task from this many on.
HEAVY, MOST_HEAVY, LOCALLY = 20_000, 100_000, 32
#: Places in a block, at least 2 * BLOCK: they fill the low bits of an anchor.
SPOT = 1 << 20
#: An odd factor that spreads anchors: they are minima, so most are small, and ranges of them as they are hold up to 17 times the mean.
SPREAD = U64(0x9E3779B97F4A7C15)
#: Kinds of open runs: another document has the half before the anchor, or the one after it (or both).
BEFORE, AFTER = 1, 2
FOUND = "did long, tag int, kind int, runs binary"
Symbols = Callable[[list], tuple[np.ndarray, np.ndarray]]


def hashes(sym: np.ndarray, win: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all grams, of grams with half of what a window has besides on one side, and of windows."""
    if sym.dtype == np.uint8:
        h = sym.astype(np.uint64)
        for s in (1, 2, 4):
            h = h[:-s] | (h[s:] << U64(8 * s))
        h = mix(h[:-8], h[8:])
    else:
        h = grams(sym, GRAM)
    gram, size = h, GRAM
    half = longer(gram, GRAM, GRAM + (win - GRAM) // 2)
    return gram, half, longer(gram, GRAM, win)


def longer(h: np.ndarray, size: int, n: int) -> np.ndarray:
    """Hashes of runs of ``n`` symbols from those of ``size``."""
    while size * 2 <= n:
        h, size = mix(h[:-size], h[size:]), size * 2
    return h if size == n else mix(h[: size - n], h[n - size :])


def lows(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours."""
    size = 1
    while size * 2 <= w:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return x if size == w else np.minimum(x[: size - w], x[w - size :])


NO_RUNS = {"doc": int, "lo": int, "n": int, "anchor": np.uint64, "cls": np.uint64, "left": np.uint32, "right": np.uint32, "w_doc": int, "w_lo": int, "w_hash": np.uint64}


def find_runs(sym: np.ndarray, at: np.ndarray, end: np.ndarray, win: int, heavy: np.ndarray) -> dict[str, np.ndarray]:
    """All runs of the documents sym[at:end]: doc, lo (first start in it), n (starts), anchor, cls, left, right.

    Of the anchors in ``heavy`` all windows instead: w_doc, w_lo, w_hash.

    left and right hash the anchor with half of a window's other symbols before or after it (0: not there). A window
    has one of these halves, so runs that share an anchor but neither half share no window.
    """
    long = np.flatnonzero(end - at >= win)
    if not len(long):
        return {k: np.empty(0, t) for k, t in NO_RUNS.items()}
    first, stop = at[long], end[long] - win + 1
    gram, half, window = hashes(sym, win)
    spot = U64(SPOT - 1)
    low = lows(gram & ~spot | np.arange(len(gram), dtype=np.uint64), win - GRAM + 1)  # value and place; the leftmost of equals
    change = np.empty(len(low), bool)
    change[0] = True
    np.not_equal(low[1:], low[:-1], out=change[1:])
    change[first] = True
    change[stop[stop < len(low)]] = True
    lo = np.flatnonzero(change)
    n = np.diff(lo, append=len(low))
    doc = np.searchsorted(first, lo, "right") - 1
    ok = (doc >= 0) & (lo < stop[doc])
    lo, n, doc = lo[ok], n[ok], doc[ok]
    some = np.isin(low[lo] & ~spot, heavy) if len(heavy) else np.zeros(len(lo), bool)
    w_lo = np.repeat(lo[some], n[some]) + np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
    w_doc = np.repeat(doc[some], n[some])
    lo, n, doc = lo[~some], n[~some], doc[~some]
    place = (low[lo] & spot).astype(np.int64)
    span = (win - GRAM) // 2
    one, two = place - span, np.minimum(place, len(half) - 1)
    left = np.where((one >= first[doc]) & (lo <= one), half[np.maximum(one, 0)] >> U64(40) | U64(1), U64(0))
    right = np.where((place + GRAM + span <= end[long][doc]) & (lo + n - 1 >= one), half[two] >> U64(40) | U64(1), U64(0))
    cls = mix(window[lo], window[lo + n - 1] + n.astype(np.uint64))
    return {"doc": long[doc], "lo": lo - first[doc], "n": n, "anchor": low[lo] & ~spot, "cls": cls, "left": left.astype(np.uint32), "right": right.astype(np.uint32), "w_doc": long[w_doc], "w_lo": w_lo - first[w_doc], "w_hash": window[w_lo]}


def planes(x: np.ndarray, skip: int, most: int) -> bytes:
    """Bytes skip..most of each number, one place after the other, which packs well for sorted or small numbers."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize)[:, skip:most].T).tobytes()


def unplanes(raw: memoryview, n: int, dtype: type, skip: int, most: int) -> np.ndarray:
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, skip:most] = np.frombuffer(raw, np.uint8, n * (most - skip)).reshape(most - skip, n).T
    return out.reshape(-1).view(dtype)


class Packed:
    """Packs arrays field by field: (name, dtype, first byte, last byte)."""

    def __init__(self, *fields: tuple[str, type, int, int]):
        self.fields = fields

    def pack(self, **arrays: np.ndarray) -> bytes:
        return b"".join(planes(np.ascontiguousarray(arrays[k].astype(t, copy=False)), a, b) for k, t, a, b in self.fields)

    def unpack(self, raw: bytes, n: int) -> dict[str, np.ndarray]:
        out, at, view = {}, 0, memoryview(raw)
        for k, t, a, b in self.fields:
            out[k] = unplanes(view[at:], n, t, a, b)
            at += n * (b - a)
        return out


RUNS = Packed(("anchor", np.uint64, 2, 8), ("cls", np.uint64, 0, 6), ("doc", np.uint16, 0, 2), ("lo", np.uint32, 0, 4), ("n", np.uint8, 0, 1), ("left", np.uint32, 0, 3), ("right", np.uint32, 0, 3))
DOCS = Packed(("did", np.int64, 0, 8), ("tag", np.int32, 0, 4))
OPEN = Packed(("doc", np.uint16, 0, 2), ("lo", np.uint32, 0, 4), ("window", np.uint64, 0, 8))
SENT = pa.schema([("part", pa.int32()), ("did", pa.int64()), ("tag", pa.int32()), ("n", pa.int32()), ("n_docs", pa.int32()), ("docs", pa.binary()), ("runs", pa.binary())])
SENT_SQL = "part int, did long, tag int, n int, n_docs int, docs binary, runs binary"


def part_of(x: np.ndarray, parts: int) -> np.ndarray:
    return ((x >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def slices(sorted_ids: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(sorted_ids)) + 1
    edges = [0, *cut.tolist(), len(sorted_ids)]
    return zip(edges[:-1], edges[1:])


def used_docs(doc: np.ndarray, did: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, bytes, int]:
    """Documents renumbered to those in use, and their packed table."""
    use, doc = np.unique(doc, return_inverse=True)
    return doc, DOCS.pack(did=did[use], tag=tag[use]), len(use)


def by_doc(did: np.ndarray, tag: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(did, tag, its pairs of first start and number of starts as int32) of each document."""
    if not len(did):
        return
    o = np.lexsort((lo, tag, did))
    did, tag = did[o], tag[o]
    raw = np.column_stack([lo[o], n[o]]).astype(np.int32).tobytes()
    cut = np.flatnonzero((did[1:] != did[:-1]) | (tag[1:] != tag[:-1])) + 1
    edges = [0, *cut.tolist(), len(o)]
    firsts = edges[:-1]
    for a, b, d, t in zip(firsts, edges[1:], did[firsts].tolist(), tag[firsts].tolist()):
        yield d, t, raw[a * 8 : b * 8]


def own_repeats(did: np.ndarray, tag: np.ndarray, lo: np.ndarray, n: np.ndarray, parts: int) -> list[tuple]:
    """Repeats found within a task, as rows to be passed through by a part chosen by the document."""
    return [(hash(d) % parts, d, t, 0, 0, None, raw) for d, t, raw in by_doc(did, tag, lo, n)]


def window_rows(did: np.ndarray, tag: np.ndarray, doc: np.ndarray, lo: np.ndarray, window: np.ndarray, parts: int) -> list[tuple]:
    """Packed windows by range of their hash (with a negative count), and repeats within the task.

    Of equal windows in one task only the smallest document's goes out; the others are repeats.
    """
    if not len(doc):
        return []
    o = np.lexsort((did[doc], window))
    first = np.flatnonzero(np.diff(window[o], prepend=~window[o[:1]]))
    again = did[doc[o]] > np.repeat(did[doc[o[first]]], np.diff(first, append=len(o)))
    dup, o = o[again], o[~again]
    rows = own_repeats(did[doc[dup]], tag[doc[dup]], lo[dup], np.ones(len(dup), np.int64), parts)
    for a, b in slices(part_of(window[o], parts)):
        i = o[a:b]
        nr, table, n_docs = used_docs(doc[i], did, tag)
        rows.append((int(part_of(window[i[:1]], parts)[0]), 0, 0, a - b, n_docs, table, OPEN.pack(doc=nr, lo=lo[i], window=window[i])))
    return rows


def pieces(symbols: Symbols, win: int, texts: list[bytes]) -> Iterator[tuple]:
    """Documents of a block; very long ones in overlapping pieces, as each window belongs to one piece."""
    sym, at = symbols(texts)
    first, end = at[:-1], at[1:]
    if sym.dtype == np.uint8:
        end = end - 1  # the space after each text
    if len(sym) <= 2 * BLOCK:
        yield np.arange(len(texts)), sym, first, end, 0
        return
    for i in range(len(texts)):
        for a in range(int(first[i]), max(int(first[i]) + 1, int(end[i]) - win + 1), BLOCK):
            b = min(int(end[i]), a + BLOCK + win - 1)
            yield np.array([i]), sym[a:b], np.zeros(1, np.int64), np.array([b - a]), a - int(first[i])


def heavy_anchors(d: DataFrame, symbols: Symbols, win: int) -> np.ndarray:
    """Anchors with so many different runs that one range should not get them all, sorted.

    Each has at least 1 / MOST_HEAVY of all runs of the tasks that report it, so there are at most MOST_HEAVY of them.
    An anchor that is below LOCALLY in each task's share isn't heavy.
    """
    none = np.empty(0, np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            cls, first = np.unique(np.concatenate([c for c, _ in held]), return_index=True)
            anchor, n = np.unique(np.concatenate([a for _, a in held])[first], return_counts=True)
            some = n >= LOCALLY
            return pa.RecordBatch.from_arrays([pa.array([0, *anchor[some].view(np.int64).tolist()], pa.int64()), pa.array([len(cls), *n[some].tolist()], pa.int64())], names=["anchor", "n"])

        for (texts,) in chunks(batches, ["text"], "text", BLOCK):
            for _, sym, at, end, _ in pieces(symbols, win, texts):
                x = find_runs(sym, at, end, win, none)
                held.append((x["cls"], x["anchor"]))
                size += len(x["cls"])
            if size >= FLUSH_RUNS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
        held.clear()
        give_back()

    counts = saved(d.select("text").mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")), "anchors")
    total = counts.where("anchor = 0").agg(F.sum("n")).first()[0] or 0  # no anchor is 0: the row of totals
    found = counts.where(F.col("n") >= max(HEAVY, total / MOST_HEAVY)).where("anchor <> 0").collect()
    return np.sort(np.array([r.anchor for r in found], np.int64).view(np.uint64))


def mapper(symbols: Symbols, win: int, parts: int, heavy: np.ndarray) -> Callable:
    """Arrow batches of (did, tag, text) to packed runs by anchor range, and repeats within the task (part -1)."""

    def flush(did: list, tag: list, found: list) -> Iterator[pa.RecordBatch]:
        did, tag = np.array(did, np.int64), np.array(tag, np.int32)
        doc, lo, n, anchor, cls, left, right, w_doc, w_lo, w_hash = (np.concatenate([x[k] for x in found]) for k in NO_RUNS)
        yield from batches_of(window_rows(did, tag, w_doc, w_lo, w_hash, parts))
        if not len(doc):
            return
        o = np.lexsort((did[doc], cls))
        first = np.flatnonzero(np.diff(cls[o], prepend=~cls[o[:1]]))
        least = np.repeat(did[doc[o[first]]], np.diff(first, append=len(o)))
        again = did[doc[o]] > least
        dup, o = o[again], o[~again]
        rows = own_repeats(did[doc[dup]], tag[doc[dup]], lo[dup], n[dup], parts)
        anchor *= SPREAD
        o = o[np.argsort(anchor[o], kind="stable")]
        for a, b in slices(part_of(anchor[o], parts)):
            i = o[a:b]
            nr, table, n_docs = used_docs(doc[i], did, tag)
            rows.append((int(part_of(anchor[i[:1]], parts)[0]), 0, 0, b - a, n_docs, table, RUNS.pack(anchor=anchor[i], cls=cls[i], doc=nr, lo=lo[i], n=n[i], left=left[i], right=right[i])))
        yield from batches_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        did, tag, found, runs = [], [], [], 0
        for d, t, texts in chunks(batches, ["did", "tag", "text"], "text", BLOCK):
            for i, sym, at, end, base in pieces(symbols, win, texts):
                x = find_runs(sym, at, end, win, heavy)
                found.append(x | {"doc": i[x["doc"]] + len(did), "lo": x["lo"] + base, "w_doc": i[x["w_doc"]] + len(did), "w_lo": x["w_lo"] + base})
                runs += len(x["doc"]) + len(x["w_doc"])
            did += d
            tag += t
            if runs >= FLUSH_RUNS or len(did) >= FLUSH_DOCS:
                yield from flush(did, tag, found)
                did, tag, found, runs = [], [], [], 0
        if runs:
            yield from flush(did, tag, found)
        del found
        give_back()

    return run


def batches_of(rows: list[tuple], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few megabytes."""
    at, size = 0, 0
    for k, r in enumerate(rows):
        size += len(r[-1])
        if size >= most or k == len(rows) - 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[at : k + 1]), SENT)], schema=SENT)
            at, size = k + 1, 0


def unpack(pdf: pd.DataFrame, packed: Packed) -> dict[str, np.ndarray]:
    """All runs of a part, with the id and tag of each."""
    found = []
    for n, n_docs, docs, runs in zip(pdf["n"].abs(), pdf["n_docs"], pdf["docs"], pdf["runs"]):
        x, d = packed.unpack(runs, n), DOCS.unpack(docs, n_docs)
        doc = x.pop("doc")
        found.append(x | {"did": d["did"][doc], "tag": d["tag"][doc]})
    return {k: np.concatenate([x.pop(k) for x in found]) for k in list(found[0])}


def reduce_runs(pdf: pd.DataFrame) -> list[tuple]:
    """Of one anchor range: starts that are repeats (kind 0) and runs that stay open on some side of their anchor."""
    x = unpack(pdf, RUNS)
    o = np.lexsort((x["did"], x["cls"], x["anchor"]))
    for k in x:
        x[k] = x[k][o]
    new_anchor = np.ones(len(o), bool)
    new_anchor[1:] = x["anchor"][1:] != x["anchor"][:-1]
    new_class = new_anchor.copy()
    new_class[1:] |= x["cls"][1:] != x["cls"][:-1]
    a, c = np.flatnonzero(new_anchor), np.flatnonzero(new_class)
    in_a, in_c = np.cumsum(new_anchor) - 1, np.cumsum(new_class) - 1
    again = x["did"] > x["did"][c][in_c]
    least = np.minimum.reduceat(x["did"], a)
    is_open = (np.maximum.reduceat(np.where(again, least[in_a], x["did"]), a) > least)[in_a] & ~again
    i = np.flatnonzero(is_open)
    before, after = (shared(x["anchor"][i], x[k][i], x["did"][i]) for k in ("left", "right"))
    return [(d, t, kind, raw) for kind, i in ((0, again), (BEFORE, i[before & ~after]), (AFTER, i[after & ~before]), (BEFORE + AFTER, i[before & after])) for d, t, raw in by_doc(x["did"][i], x["tag"][i], x["lo"][i], x["n"][i])]


def shared(anchor: np.ndarray, half: np.ndarray, did: np.ndarray) -> np.ndarray:
    """Whether another document has the same anchor and half."""
    out = np.zeros(len(did), bool)
    i = np.flatnonzero(half)
    i = i[np.lexsort((did[i], half[i], anchor[i]))]
    if len(i):
        new = np.ones(len(i), bool)
        new[1:] = (anchor[i][1:] != anchor[i][:-1]) | (half[i][1:] != half[i][:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(i)) - 1
        out[i] = (did[i[last]] > did[i[first]])[np.cumsum(new) - 1]
    return out


def opener(symbols: Symbols, win: int, parts: int) -> Callable:
    """Open runs with their texts to packed window hashes, dealt by the hash."""

    def flush(did: list, tag: list, found: list) -> Iterator[pa.RecordBatch]:
        did, tag = np.array(did, np.int64), np.array(tag, np.int32)
        yield from batches_of(window_rows(did, tag, *(np.concatenate(x) for x in zip(*found)), parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        did, tag, found, size = [], [], [], 0
        for d, t, texts, runs in chunks(batches, ["did", "tag", "text", "runs"], "text", BLOCK):
            for i, (text, rs) in enumerate(zip(texts, runs)):
                sym, _ = symbols([text])
                r = np.concatenate([np.column_stack([x := np.frombuffer(y["runs"], np.int32).reshape(-1, 2), np.full(len(x), y["kind"])]) for y in rs]).astype(np.int64)
                for at in range(0, len(r), 5000):  # contexts side by side; hashes across their borders are dropped
                    lo, n, kind = r[at : at + 5000].T
                    span = n + win - 1
                    edge = np.cumsum(span) - span
                    spot = np.arange(span.sum()) - np.repeat(edge - lo, span)
                    gram, _, window = hashes(sym[spot], win)
                    # the anchor again: the leftmost smallest gram of a run's first window
                    place = gram[edge[:, None] + np.arange(win - GRAM + 1)] & ~U64(SPOT - 1)
                    middle = place.argmin(axis=1) - (win - GRAM) // 2
                    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    sided = np.repeat(middle, n)
                    want = ((np.repeat(kind, n) & BEFORE) > 0) & (start <= sided) | ((np.repeat(kind, n) & AFTER) > 0) & (start >= sided)
                    found.append((np.full(int(want.sum()), len(did) + i), (np.repeat(lo, n) + start)[want], window[np.repeat(edge, n) + start][want]))
                    size += int(want.sum())
            did += d
            tag += t
            if size >= FLUSH_RUNS or len(did) >= FLUSH_DOCS:
                yield from flush(did, tag, found)
                did, tag, found, size = [], [], [], 0
        if size:
            yield from flush(did, tag, found)
        del found
        give_back()

    return run


def reduce_windows(pdf: pd.DataFrame) -> list[tuple]:
    x = unpack(pdf, OPEN)
    o = np.lexsort((x["did"], x["window"]))
    first = np.flatnonzero(np.diff(x["window"][o], prepend=~x["window"][o[:1]]))
    again = o[x["did"][o] > np.repeat(x["did"][o[first]], np.diff(first, append=len(o)))]
    return [(d, t, 0, raw) for d, t, raw in by_doc(x["did"][again], x["tag"][again], x["lo"][again].astype(np.int64), np.ones(len(again), np.int64))]


def with_tag(docs: DataFrame) -> DataFrame:
    """(did, tag, text); where no id repeats, no tag is needed."""
    d = identified(docs)
    some = d.groupBy("did").count().where("count > 1").limit(1).count()
    return d.select("did", (F.col("th").bitwiseAND(2**31 - 1).cast("int") if some else F.lit(0)).alias("tag"), "text")


def repeated_starts(d: DataFrame, symbols: Symbols, win: int, n_symbols: float) -> DataFrame:
    """(did, tag, runs) of rows (did, tag, text): for each document with repeats, its lists of (first start, number of starts), int32 pairs."""
    spark = d.sparkSession
    parts = parts_for(spark, n_symbols, 4 << 20)
    sent = d.mapInArrow(mapper(symbols, win, parts, heavy_anchors(d, symbols, win)), SENT_SQL)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["n"] == 0
        rows = list(zip(pdf["did"][own], pdf["tag"][own], [0] * int(own.sum()), pdf["runs"][own]))
        for which, reducer in ((pdf["n"] > 0, reduce_runs), (pdf["n"] < 0, reduce_windows)):
            if which.any():
                rows += reducer(pdf[which])
        give_back()
        return pd.DataFrame(rows, columns=["did", "tag", "kind", "runs"])

    resolve = lambda df: df.groupBy("part").applyInPandas(part, FOUND)
    found = saved(resolve(sent), "runs")
    opened = found.where("kind > 0").groupBy("did", "tag").agg(F.collect_list(F.struct("kind", "runs")).alias("runs"))
    texts = d.join(opened, ["did", "tag"]).select("did", "tag", "text", "runs")
    more = saved(resolve(texts.mapInArrow(opener(symbols, win, parts), SENT_SQL)), "windows")
    let_go(spark)
    return found.where("kind = 0").select("did", "tag", "runs").unionByName(more.select("did", "tag", "runs")).groupBy("did", "tag").agg(F.collect_list("runs").alias("runs"))


def covered(runs: list[bytes] | None, n: int, win: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a repeated window."""
    step = np.zeros(n + 1, np.int32)
    if runs:
        lo, k = np.frombuffer(b"".join(runs), np.int32).reshape(-1, 2).astype(np.int64).T
        np.add.at(step, lo, 1)
        np.add.at(step, lo + k + win - 1, -1)
    return np.cumsum(step[:-1]) > 0
