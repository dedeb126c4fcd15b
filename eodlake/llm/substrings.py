"""Byte-level and word-level removal of repeated passages (suffix sort, seed and extend)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from eodlake.llm.common import NO_ID, chunks, joined, table, text_bytes, words_of
from eodlake.llm.repeats import BLOCK, covered, repeated_starts, with_tag


def bytes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return joined(texts)


def _removed(d: DataFrame, starts: DataFrame, finish, schema: str) -> DataFrame:
    """Each document with its repeats, cut by ``finish``. Rows with equal id and text have equal results."""
    return d.join(starts, ["did", "tag"], "left").select("did", "text", "runs").mapInArrow(finish, schema)


def _id(did: list[int]) -> pa.Array:
    return pa.array([None if x == NO_ID else x for x in did], pa.int64())


def suffix_dedup(docs: DataFrame, win: int = 50, with_text: bool = False) -> DataFrame:
    """Remove each byte covered by a ``win``-byte string that also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept_text (bytes) if asked for. Suffixes that start
    at content-chosen sample positions are sorted externally with the class of what follows; the order of the
    suffixes between two samples follows from their sample (induction), and only where classes differ are single
    suffixes sorted, down to ``win`` common bytes. See ``repeats``. Null texts are empty; texts shorter than ``win`` are kept
    whole; rows with equal ids never count against each other; a null id is larger than any other; an empty table
    gives no rows.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for did, texts, runs in chunks(batches, ["did", "text", "runs"], "text", 4 * BLOCK):
            rows = []
            for t, r in zip(texts, runs):
                if not r:
                    rows.append((len(t), 0, 0, hashlib.sha256(t).hexdigest(), *[t] * with_text))
                    continue
                gone = covered(r, len(t), win)
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_text]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text]
            yield pa.RecordBatch.from_arrays([_id(did), *(pa.array(c, k) for c, k in zip(zip(*rows), types))], names=names)

    d = with_tag(docs)
    starts = repeated_starts(d, bytes_of, win, text_bytes(docs))
    return _removed(d, starts, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text binary" * with_text)


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return words_of(texts)


def seed_extend_dedup(docs: DataFrame, win: int = 50, with_text: bool = False) -> DataFrame:
    """Remove each word covered by ``win`` consecutive words that also start in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space), and kept_text if asked for.
    Documents meet on winnowed anchors of word grams; a match is extended both ways over the windows that share the
    anchor, as a whole where its context is the same and window by window where it ends; maximal repeats are the
    unions of these. Null texts have no words; edge cases as for ``suffix_dedup``.
    """

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for did, texts, runs in chunks(batches, ["did", "text", "runs"], "text", 4 * BLOCK):
            rows = []
            for t, r in zip(texts, runs):
                ws = t.split()
                kept = ws
                if r:
                    gone = covered(r, len(ws), win)
                    kept = [w for w, g in zip(ws, gone.tolist()) if not g]
                text = b" ".join(kept)
                rows.append((len(ws), len(ws) - len(kept), hashlib.sha256(text).hexdigest(), *[text] * with_text))
            types = [pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_text]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text]
            yield pa.RecordBatch.from_arrays([_id(did), *(pa.array(c, k) for c, k in zip(zip(*rows), types))], names=names)

    d = with_tag(docs)
    starts = repeated_starts(d, word_symbols, win, text_bytes(docs) / 5)
    return _removed(d, starts, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text binary" * with_text)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend_dedup(table(spark, sf_dir, "documents"))


# bytes as pairs of hex digits; pages only keep DuckDB from scanning a whole text for each of its windows
BYTES_SQL = r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS b FROM documents),
pages AS (SELECT doc_id, p, array_slice(b, 2 * p + 1, 2 * p + 1122) AS b FROM (SELECT doc_id, b, unnest(range(0, length(b) // 2, 512)) AS p FROM b)),
windows AS (SELECT doc_id, p + i AS i, md5(array_slice(b, 2 * i - 1, 2 * i + 98)) AS h FROM (SELECT doc_id, p, b, unnest(range(1, least(512, length(b) // 2 - 49) + 1)) AS i FROM pages)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM windows) WHERE least < doc_id),
placed AS (SELECT doc_id, unnest(regexp_extract_all(b, '..')) AS byte, unnest(range(1, length(b) // 2 + 1)) AS i FROM b),
marked AS (SELECT p.doc_id, p.i, byte, count(s.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
           FROM placed p LEFT JOIN starts s ON p.doc_id = s.doc_id AND p.i = s.i),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM marked),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS b FROM runs GROUP BY doc_id)
SELECT b.doc_id, length(b.b) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.b, ''))) AS kept_sha256
FROM b LEFT JOIN kept ON b.doc_id = kept.doc_id
"""

WORDS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM windows) WHERE least < doc_id),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
marked AS (SELECT p.doc_id, p.i, word, count(s.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
           FROM placed p LEFT JOIN starts s ON p.doc_id = s.doc_id AND p.i = s.i),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text FROM marked GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
