"""I-Match fingerprints: terms within a band of inverse document frequency, hashed under fixed randomised lexicons."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.llm.common import NO_ID, U64, chunks, mix, parts_for, saved, table, text_bytes, words_of

#: Band of inverse document frequencies (natural log of documents per document that has the term).
LOW, HIGH = 1.6, 8.0
#: Randomised lexicons a density: lexicon i of density k holds a fixed share 4**-k of all terms.
LEXICONS, DENSITIES = 48, 8
_DIGITS = np.frombuffer(b"-0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_.", np.uint8)
_seeds = np.random.default_rng(31).integers(0, 2**32, (2, LEXICONS, 1), dtype=np.uint32)
_XOR, _ODD = _seeds[0], _seeds[1] | np.uint32(1)
#: Bytes of text in one range of ids; terms in one block.
RANGE, BLOCK = 16 << 20, 1 << 14
#: A document costs its lexicons besides its text.
DOC_BYTES = 512


def lexicon_codes(h: np.ndarray, at: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each document's terms (0 without terms), and the code of each of its lexicons (0 where it holds none).

    ``h`` are the word hashes of all documents, ``at`` the offsets of each. A document's terms are its sorted distinct
    words within the (sorted) band, or all of them if none is. Which of them a lexicon holds follows from the lexicon and the
    term alone; lexicons of one number are nested from density to density. Terms go through in blocks of bounded size.
    """
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    if len(band) and len(h):
        found = np.searchsorted(band, h)
        found[found == len(band)] = 0
        kept = band[found] == h
        kept |= (np.bincount(doc[kept], minlength=n) == 0)[doc]
        h, doc = h[kept], doc[kept]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    whole = np.zeros(n, np.uint64)
    total, some = np.zeros((DENSITIES, LEXICONS * n), np.uint64), np.zeros((DENSITIES, LEXICONS * n), bool)
    for a in range(0, len(h), BLOCK):
        terms, of = h[a : a + BLOCK], doc[a : a + BLOCK]
        value = mix(terms, terms) | U64(1)
        np.add.at(whole, of, value)
        x = (terms >> U64(32)).astype(np.uint32)
        chance = (x[None, :] ^ _XOR) * _ODD
        chance ^= chance >> np.uint32(15)
        chance *= np.uint32(0x2C1B3C6D)
        chance ^= chance >> np.uint32(13)
        chance = chance.ravel()
        held = np.flatnonzero(chance < np.uint32(1 << 30))
        chance = chance[held]
        lexicon, term = np.divmod(held, len(terms))
        key, value = lexicon * n + of[term], value[term]
        for k in range(DENSITIES):
            inside = chance < np.uint32(1 << (30 - 2 * k))
            key, value, chance = key[inside], value[inside], chance[inside]
            if not len(key):
                break
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            total[k, key[begin]] += np.add.reduceat(value, begin)
            some[k, key[begin]] = True
    codes = np.where(some, (mix(total.ravel(), total.ravel()).reshape(total.shape) >> U64(52)) + U64(1), U64(0)).astype(np.uint16)
    sizes = np.bincount(doc, minlength=n).astype(np.uint64)
    whole = np.where(sizes > 0, mix(whole, sizes) | U64(1), U64(0))
    return whole, np.ascontiguousarray(codes.reshape(DENSITIES, LEXICONS, n).transpose(2, 0, 1))


def written(whole: np.ndarray, codes: np.ndarray) -> list[str]:
    """Fingerprints (empty without words): the hash of all terms, then, from dense to sparse, two digits for each lexicon.

    ``--`` stands where a lexicon holds no term; densities at which no lexicon holds one are left out.
    """
    digits = np.stack([(codes - 1) >> 6, (codes - 1) & 63], axis=-1) + 1
    digits = _DIGITS[np.where(codes[..., None] > 0, digits, 0)]
    levels = (codes > 0).any(axis=2).sum(axis=1)  # lexicons are nested, so these are the dense ones
    return ["|".join([f"{w:016x}", *(d[k].tobytes().decode() for k in range(m))]) if w else "" for w, d, m in zip(whole.tolist(), digits, levels.tolist())]


def likeness(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Share of equal lexicons among those that hold a term of either document, row by row of two results of ``lexicon_codes``.

    Read at the sparsest density at which at least half of the lexicons hold such a term (short documents: at the
    densest); 1 for equal fingerprints, 0 where only one document has terms.
    """
    (w, x), (v, y) = one, two
    either = (x > 0) | (y > 0)
    enough = 2 * either.sum(axis=2) >= LEXICONS
    k = np.where(enough.any(axis=1), DENSITIES - 1 - enough[:, ::-1].argmax(axis=1), 0)
    row = np.arange(len(w))
    either, same = either[row, k], (x[row, k] == y[row, k])
    share = (same & either).sum(axis=1) / np.maximum(either.sum(axis=1), 1)
    return np.where((w == v) & (x == y).all(axis=(1, 2)), 1.0, np.where((w == 0) | (v == 0), 0.0, share))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a block have each term."""
    for (texts,) in chunks(batches, ["text"], "text", 8 << 20):
        h, at = words_of(texts, lower=True)
        doc = np.repeat(np.arange(len(texts)), np.diff(at))
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        term, n = np.unique(h[first], return_counts=True)
        for i in range(0, len(term), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(term[i : i + (1 << 16)].view(np.int64)), pa.array(n[i : i + (1 << 16)])], names=["term", "n"])


def band_of(docs: DataFrame) -> np.ndarray:
    """The sorted terms whose inverse document frequency over all documents is within the band.

    Document frequencies are exact: blocks count their documents first, then counts are added by term. A document of d
    distinct terms adds to d counts, and a term of the band has a share of e**-HIGH of all documents at least, so there are at
    most e**HIGH times the mean of d of them (8 bytes each), however many documents and terms there are.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    n = docs.count()
    counts = texts.mapInArrow(_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))
    least, most = n * math.exp(-HIGH), n * math.exp(-LOW)
    found = saved(counts.where((F.col("df") >= least) & (F.col("df") <= most)).select("term"), "band").toArrow()
    return np.sort(found.column("term").to_numpy().view(np.uint64))


#: One row a document (part 2), and the first (0) and the last (1) document of each range with its text.
_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = f"range long, part int, did long, text string, {_ROW}"


def imatch(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of the code points replaced by the first as many of the next document. Document
    frequencies come from a pass over all documents; fingerprints depend on the text alone, so equal texts have equal ones.
    A null text is empty; texts without words have the empty fingerprint; texts without a term in the band use all
    their terms. A null id comes last, equal ids go by text. A single document is its own next; an empty table gives no
    rows. Extra columns are ignored.

    Sampled splitters range-partition the documents by id, so texts are shuffled once. Within a range a document meets the one
    after it in the stream; the first and the last of each range are written beside the results and joined by range.
    """
    spark = docs.sparkSession
    band = spark.sparkContext.broadcast(band_of(docs))  # bounded, see there

    def prints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return lexicon_codes(*words_of([t.encode() for t in texts], lower=True), band.value)

    def results(rows: list[tuple]) -> list[pa.Array]:
        """Result columns of (id, text, next text) rows."""
        did, texts, following = zip(*rows)
        n = [len(t) for t in texts]
        edited = [t[: k - k // 4] + f[: k // 4] for t, f, k in zip(texts, following, n)]
        own, changed = prints(texts), prints(edited)
        alone = [i for i, f in enumerate(following) if i + 1 == len(rows) or texts[i + 1] != f]  # whose next is not the next row
        after = tuple(np.roll(x, -1, axis=0) for x in own)
        for x, p in zip(after, prints([following[i] for i in alone])):
            x[alone] = p
        return [
            pa.array([None if d == NO_ID else d for d in did], pa.int64()),
            pa.array(n, pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(written(*own), pa.string()),
            pa.array(written(*changed), pa.string()),
            pa.array(likeness(own, changed), pa.float64()),
            pa.array(likeness(own, after), pa.float64()),
        ]

    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]

    def edge(rng: int, part: int, did: int, text: str) -> pa.RecordBatch:
        values = [rng, part, did, text, *[None] * 7]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    def done(rng: int, rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows)
        before = [pa.array([rng] * n, pa.int64()), pa.array([2] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
        return pa.RecordBatch.from_arrays([*before, *results(rows)], names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ready, size, rng = None, [], 0, 0
        for b in batches:
            for s in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                for rng, did, text in zip(*(c.to_pylist() for c in s.columns)):
                    if held is None:
                        yield edge(rng, 0, did, text)
                    else:
                        ready.append((*held, text))
                        size += len(text) + DOC_BYTES
                    held = (did, text)
                    if size >= 1 << 20:
                        yield done(rng, ready)
                        ready, size = [], 0
        if ready:
            yield done(rng, ready)
        if held is not None:
            yield edge(rng, 1, *held)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                yield pa.RecordBatch.from_arrays(results([row]), names=names[4:])

    d = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    parts = parts_for(spark, text_bytes(docs), RANGE)
    dealt = d.repartitionByRange(parts, "did").sortWithinPartitions("did", "text").select(F.spark_partition_id().cast("long").alias("range"), "did", "text")
    rows = saved(dealt.mapInArrow(stream, _SCHEMA), "imatch")
    first = rows.where("part = 0").select("range", F.col("text").alias("following"))
    ranges = rows.where("part = 0").select("range")  # a number a range
    ranges = ranges.select("range", F.coalesce(F.lead("range").over(W.orderBy("range")), F.min("range").over(W.partitionBy())).alias("next"))
    last = rows.where("part = 1").select("range", "did", "text").join(ranges, "range")
    last = last.join(first.withColumnRenamed("range", "next"), "next").select("did", "text", "following")
    return rows.where("part = 2").select(names[4:]).unionByName(last.mapInArrow(ends, _ROW))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch(table(spark, sf_dir, "documents"))
