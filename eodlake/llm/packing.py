"""Packing of tokenised documents into windows by lexical retrieval (sharded BM25)."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import frugal, saved, steps, table

WINDOW, END_ID = 2048, 1
#: A shard, the unit that is indexed at once: tokens and documents at most (one document may exceed it alone).
SHARD_TOKENS, SHARD_DOCS = 4 << 20, 4096
#: Neighbours ranked at a time; terms that one of SPARSE documents of a shard has are scored for all pairs of a shard at once.
RANKED, SPARSE = 48, 8
#: Numbers of a document's projection, documents on which the cells are fitted (on average), cells a shard, cells at most.
DIM, FITTED, CELLS, MOST_CELLS = 64, 4096, 16, 1024
K1, B = 1.2, 0.75
#: Documents encoded at a time, and bytes of their texts.
STEP, STEP_BYTES = 768, 1 << 19
#: Pieces whose ids an encoder keeps: a worker waits for its next task with these in memory.
MOST_PIECES = 200_000


#: What a text of single spaces and newlines doesn't hold: two in a row, or another white space of the Latin blocks.
BREAKS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")


class Numbers(dict):
    """Numbers pieces as they are first asked for, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Ids of whole texts under a byte-level BPE of ``tokenizers``, by a table of the pieces seen before.

    The pre-tokeniser never joins characters across a single space or a single newline, so pieces between them can be
    encoded apart. Texts with other white space, with characters beyond the Latin blocks or with the name of a special
    token are encoded as a whole.
    """

    def __init__(self, path: str, ranks: str | None = None, most: int = MOST_PIECES):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.vocab = self.whole.get_vocab_size()
        self.width = np.uint16 if self.vocab <= 1 << 16 else np.uint32
        self.ranked = None
        if ranks:  # the same vocabulary, faster for pieces
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
            self.begins = {"\n": np.arange(self.vocab) == merges[b"\n"], " ": np.zeros(self.vocab, bool)}
            self.begins[" "][[i for t, i in merges.items() if t[:1] == b" "]] = True
        self.most = most
        self._forget()

    def ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def plain(self, text: str) -> bool:
        """Single spaces and newlines only (as many as there are gaps, none at either end, no two together)."""
        if not text or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in BREAKS):
            return False
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                if max(text) >= "ɐ":
                    return False
        return not any(s in text for s in self.specials)

    def _forget(self) -> None:
        self.pieces = Numbers()
        self.flat, self.start, self.length = np.empty(0, self.width), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Encode the pieces that are new, side by side; each begins with its white space, and nothing else does."""
        new, self.pieces.new = self.pieces.new, []
        start, length = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        is_line = np.array([p[0] == "\n" for p in new], bool)
        for lead, which in (("\n", np.flatnonzero(is_line)), (" ", np.flatnonzero(~is_line))):
            if not len(which):
                continue
            some = [new[i] for i in which.tolist()]
            x = self.ranked.encode_to_numpy("".join(some) if lead == "\n" else " " + " ".join(some))
            at = np.flatnonzero(self.begins[lead][x])
            if len(at) != len(some):
                raise AssertionError("pieces and encoded pieces differ in number")
            start[which], length[which] = at + len(self.flat), np.diff(at, append=len(x))
            self.flat = np.concatenate([self.flat, x.astype(self.width)])
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            return [np.array(x.ids, self.width).tobytes() for x in self.whole.encode_batch(texts, add_special_tokens=False)]
        plain = [self.plain(t) for t in texts]
        out = [b"" if p or not t else self.ids(t) for p, t in zip(plain, texts)]
        # every piece with the white space before it; a first one gets a newline, whose id is dropped again
        pieces = [f"\n{t}".replace("\n", " \n").split(" ")[1:] for p, t in zip(plain, texts) if p]
        total = sum(map(len, pieces))
        if not total:
            return out
        w = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(pieces)), np.int64, total)
        if self.pieces.new:
            self._learn()
        n = self.length[w]
        end = np.cumsum(n)
        raw = self.flat[np.arange(end[-1]) + np.repeat(self.start[w] - (end - n), n)].tobytes()
        step = np.dtype(self.width).itemsize
        ends = (end[np.cumsum([len(p) for p in pieces]) - 1] * step).tolist()
        spans = iter(zip([0, *ends[:-1]], ends))
        if len(self.pieces) > self.most:
            self._forget()
        return [raw[(s := next(spans))[0] + step : s[1]] if p else o for p, o in zip(plain, out)]


@functools.lru_cache(1)
def encoder(path: str, ranks: str | None) -> Encoder:
    """The encoder of a worker, which keeps what it learned for its next tasks."""
    return Encoder(path, ranks)


def _spread(x: np.ndarray, seed: int) -> np.ndarray:
    y = (x.astype(np.uint32) + np.uint32(seed)) * np.uint32(0x9E3779B1)
    y ^= y >> np.uint32(15)
    y *= np.uint32(0x85EBCA77)
    return y ^ (y >> np.uint32(13))


def projection(vocab: int) -> np.ndarray:
    """A row of random signs for each token; later ids, which a vocabulary gives to rarer tokens, weigh more."""
    rng, weight, out = np.random.default_rng(64), np.log1p(np.arange(vocab) / 100)[:, None], np.empty((vocab, DIM), np.float32)
    for at in range(0, vocab, 4096):
        out[at : at + 4096] = (rng.integers(0, 2, out[at : at + 4096].shape) * 2 - 1) * weight[at : at + 4096]
    return out


def tokenised(path: str, ranks: str | None, end_id: int) -> Callable:
    """Arrow batches of (doc_id, text) to token rows, and one row of document frequencies a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("near", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("vec", pa.binary()), ("df", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, ranks)
        width, vocab = enc.width, max(enc.vocab, end_id + 1)
        end = np.array([end_id], width).tobytes()
        df = np.zeros(vocab, np.int32)
        every, mark = np.arange(vocab), np.zeros(vocab, bool)
        a, b = (_spread(every, s) for s in (1, 77_777))
        axes, ones = projection(vocab), np.ones(vocab, np.float32)
        empty = True
        for batch in batches:
            for some in steps(batch, STEP, STEP_BYTES):
                docs = some.column("doc_id")
                ids = [x + end for x in enc.encode_batch([t or "" for t in some.column("text").to_pylist()])]
                near, vec = [], []
                for x in ids:
                    mark[:] = False
                    mark[np.frombuffer(x, width)] = True
                    seen = np.flatnonzero(mark)
                    df[seen] += 1
                    near.append(int(a[seen].min()) << 31 | int(b[seen].min()) >> 1)
                    v = ones[: len(seen)] @ axes.take(seen, axis=0)
                    vec.append(np.rint(v * (127 / max(float(np.abs(v).max()), 1e-9))).astype(np.int8).tobytes())
                n = [len(x) // enc.width().itemsize for x in ids]
                yield pa.RecordBatch.from_arrays([docs.cast(pa.int64()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(vec, pa.binary()), pa.nulls(len(n), pa.binary())], schema=schema)
                empty = False
        if not empty:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([df.tobytes()])], schema=schema)

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column("df").to_pylist():
            one = np.frombuffer(x, np.int32).astype(np.int64)
            total = one if total is None else total + one
    if total is not None:
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(total[t])], names=["token", "df"])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def vectors(raw: list[bytes]) -> np.ndarray:
    return unit(np.frombuffer(b"".join(raw), np.int8).reshape(-1, DIM).astype(np.float32))


class Cells:
    """Cells of alike documents: the nearest of a few centroids (spherical k-means over a sample's projections).

    Cells are numbered so that neighbouring numbers are alike: the centroids are halved along their main axis again and again.
    """

    def __init__(self, sample: list[bytes], cells: int, rounds: int = 12):
        x = vectors(sorted(sample))
        self.middle = x.mean(axis=0)
        x = unit(x - self.middle)
        c = x[np.random.default_rng(7).permutation(len(x))[:cells]]
        for _ in range(rounds):
            near = (x @ c.T).argmax(axis=1)
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            some = np.bincount(near, minlength=len(c)) > 0
            c[some] = unit(total[some])
        self.centroids = c[self._order(c, np.arange(len(c)))]

    def _order(self, c: np.ndarray, some: np.ndarray) -> np.ndarray:
        if len(some) <= 2:
            return some
        y = c[some] - c[some].mean(axis=0)
        some = some[np.argsort(y @ np.linalg.svd(y, full_matrices=False)[2][0], kind="stable")]
        half = len(some) // 2
        return np.concatenate([self._order(c, some[:half]), self._order(c, some[half:])])

    def of(self, raw: list[bytes]) -> np.ndarray:
        return (unit(vectors(raw) - self.middle) @ self.centroids.T).argmax(axis=1)

    def column(self, vec: str) -> Column:
        @F.pandas_udf("int")
        def cell(v: pd.Series) -> pd.Series:
            return pd.Series(self.of(v.tolist()) if len(v) else [], dtype="int32")

        return cell(vec)


class Shard:
    """An inverted index with BM25 weights over the documents of one shard, which are handed out once each."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        n = np.array([len(x) for x in ids])
        keys = np.repeat(np.arange(len(ids), dtype=np.uint64) << np.uint64(32), n)
        keys |= np.concatenate(ids)
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        tf = np.diff(first, append=len(keys)).astype(np.float32)
        keys = keys[first]
        del first
        doc, term = (keys >> np.uint64(32)).astype(np.int32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int32)
        weight = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n[doc] / mean))).astype(np.float32)
        del keys, tf
        self.at = np.searchsorted(doc, np.arange(len(ids) + 1))
        self.term = term
        o = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[o], weight[o]
        self.posting = np.searchsorted(term[o], np.arange(len(idf) + 1))
        del doc, o
        self.n, self.used = len(ids), np.zeros(len(ids), bool)
        # common terms: a row of weights each (SPARSE times the postings at most), and their part of the scores of all pairs
        common = np.flatnonzero(np.diff(self.posting) * SPARSE >= self.n)
        rows = np.zeros((len(common), self.n), np.float32)
        for row, t in zip(rows, common.tolist()):
            some = slice(self.posting[t], self.posting[t + 1])
            row[self.doc[some]] = self.weight[some]
        self.common = np.zeros(len(idf), bool)
        self.common[common] = True
        self.base = (rows.T > 0).astype(np.float32) @ rows

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents of the shard for all distinct terms of the seed."""
        term = self.term[self.at[seed] : self.at[seed + 1]]
        lists = [slice(self.posting[t], self.posting[t + 1]) for t in term[~self.common[term]].tolist()]
        if not lists:
            return self.base[seed].copy()
        return self.base[seed] + np.bincount(np.concatenate([self.doc[s] for s in lists]), np.concatenate([self.weight[s] for s in lists]), self.n)

    def neighbours(self, seed: int) -> np.ndarray:
        """The RANKED best unused documents that share a term with the seed, best first."""
        score = self.scores(seed)
        score[self.used] = 0
        if np.count_nonzero(score) > RANKED:
            best = np.argpartition(score, -RANKED)[-RANKED:]
        else:
            best = np.flatnonzero(score)
        return best[np.lexsort((best, -score[best]))]


def pack_shard(ids: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length).

    A window begins with what is left of the document cut last, or the next unused one, and takes its unused
    neighbours, best first, as long as they fit whole; the best that doesn't fit is cut to fill the window.
    The end of a shard goes into windows of power-of-two lengths, which need no padding.
    """
    shard, n = Shard(ids, idf, mean), [len(x) for x in ids]
    used, following = shard.used, 0
    seed, start, out = None, 0, []
    while True:
        if seed is None:
            while following < len(n) and used[following]:
                following += 1
            if following == len(n):
                break
            seed, start = following, 0
            used[seed] = True
        room = window
        take = min(room, n[seed] - start)
        out.append((seed, start, take))
        room -= take
        origin, seed, start = seed, (seed if start + take < n[seed] else None), start + take
        while room and seed is None:
            ranked = shard.neighbours(origin).tolist()
            if not ranked:  # nothing alike is left: the next ones in order, which is by likeness too
                while following < len(n) and used[following]:
                    following += 1
                ranked = [i for i in range(following, min(len(n), following + 2 * RANKED)) if not used[i]]
                if not ranked:
                    break
            rest = []
            for i in ranked:
                if n[i] <= room:
                    used[i] = True
                    out.append((i, 0, n[i]))
                    room -= n[i]
                    if not room:
                        break
                else:
                    rest.append(i)
            if room and rest:
                seed, start = rest[0], room
                used[seed] = True
                out.append((seed, 0, room))
                room = 0
        if not room:
            yield out
            out = []
    left = sum(x[2] for x in out)
    while out:  # the end: largest powers of two first
        room, part = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc, start, k = out.pop(0)
            part.append((doc, start, min(k, room)))
            if k > room:
                out.insert(0, (doc, start + room, k - room))
            room -= part[-1][2]
        yield part


def packer(idf: np.ndarray, mean: float, window: int, width: type, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        docs: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for pieces in pack_shard([x for _, x in docs], idf, mean, window):
                offset = 0
                for doc, start, k in pieces:
                    d, x = docs[doc]
                    part = x[start : start + k].astype("<u4")
                    rows.append((d, start, k, zlib.crc32(part.tobytes()), len(x), number, offset, *[part.tolist()] * with_ids))
                    offset += k
                number += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:7]]
            if with_ids:
                names, columns = [*names, "ids"], [*columns, pa.array([r[-1] for r in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for d, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                x = np.frombuffer(x, width)
                if docs and (held + len(x) > SHARD_TOKENS or len(docs) >= SHARD_DOCS):
                    yield from flush()
                    docs, held = [], 0
                docs.append((d, x))
                held += len(x)
        if docs:
            yield from flush()

    return run


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = END_ID, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and its ids if asked for).

    1. Whole texts are tokenised once and written, with a random projection and two min-hashes of their distinct tokens and, one
       row a task, how many documents have each token. These counts cover all documents and have one number for each id
       of the vocabulary, so they fit in any task.
    2. Every document goes to the nearest of a few cells, which are fitted on the projections of about FITTED documents (picked by
       hash). Cells, then min-hashes, range-partition the documents, so that likely neighbours meet; ties spread by id. There are as
       many ranges as the tokens need, whatever the cluster, and a task cuts its range into shards of bounded size.
    3. Each shard is a BM25 inverted index over token ids, with document frequencies of the whole table. Each seed document looks up
       all its terms and its unused neighbours greedily fill the window; see ``pack_shard``.

    A null text is empty and has the end id only; repeated rows are packed each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    from tokenizers import Tokenizer

    vocab = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    width = np.uint16 if vocab <= 1 << 16 else np.uint32
    tokens = saved(docs.select("doc_id", "text").mapInArrow(frugal(tokenised(tokenizer, ranks, end_id)), "doc_id long, near long, n long, ids binary, vec binary, df binary"), "tokens")
    total, count = tokens.where("n is not null").agg(F.sum("n"), F.count("n")).first()
    seen = tokens.where("df is not null").select("df").mapInArrow(frugal(_counts), "token long, df long").groupBy("token").agg(F.sum("df").alias("df")).collect()  # at most one row an id
    df = np.zeros(vocab)
    for r in seen:
        df[r.token] = r.df
    idf = np.log1p(((count or 0) - df + 0.5) / (df + 0.5)).astype(np.float32)
    rows = tokens.where("n is not null")
    parts = max(1, -(-(total or 0) * 5 // (SHARD_TOKENS * 4)))  # ranges are of sampled sizes: a fifth of a shard is left free
    cell = F.lit(0)
    if parts > 1:
        picked = F.pmod(F.xxhash64("doc_id", "near", "vec"), F.lit(count)) < FITTED
        sample = [bytes(r.vec) for r in rows.where(picked).select("vec").distinct().collect()]  # FITTED vectors of DIM bytes on average
        if sample:
            cell = Cells(sample, min(MOST_CELLS, CELLS * parts)).column("vec")
    order = [F.col("cell"), F.col("near"), F.col("doc_id"), F.xxhash64("ids")]
    dealt = rows.select("doc_id", "near", "ids", cell.alias("cell")).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return dealt.mapInArrow(frugal(packer(idf, (total or 0) / max(count or 0, 1), window, width, with_ids)), schema)


def public_tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken")}


def op8_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), **public_tokenizer())
