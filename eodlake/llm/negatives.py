"""Hard negatives of anchor vectors: pair scores in a secondary sort, windows opened by an anchor's positives."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import NO_ID, saved, table

POSITIVES, NEGATIVES = 5, 10
#: A negative's score times 100 lies between these multiples of the positive's.
LEAST, MOST = 30, 90
#: Rows of one block at most, and anchors of one chunk on average; scores are held for SLICE anchors and a block at once.
BLOCK, CHUNK, SLICE = 4096, 2048, 128
#: Anchors travel as a broadcast up to this many bytes, beyond it both sides are dealt by (block, chunk).
BROADCAST = 8 << 20
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_HIGHEST = 2**63 - 1


def _vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 * x) of each row's components, missing ones of shorter rows 0, and whether a row has finite components only."""
    n = len(column)
    length = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(n), length)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    out = np.zeros((n, int(length.max(initial=0))))
    with np.errstate(over="ignore", invalid="ignore"):
        out[row, at] = np.floor(256 * flat)
    return out, column.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(out).all(1)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where they fit, else as doubles; the kind comes first."""
    small = not x.size or np.abs(x).max() < 2**15
    return (b"h" if small else b"d") + np.ascontiguousarray(x, np.int16 if small else np.float64).tobytes()


def _unpacked(b: bytes, n: int) -> np.ndarray:
    kind = np.int16 if b[:1] == b"h" else np.float64
    return np.frombuffer(b, kind, offset=1).reshape(n, -1)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``size`` rows."""
    held, n = [], 0
    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


BLOCKS = "block long, n int, ids binary, labels binary, vectors binary"


def _blocks(size: int) -> Callable:
    """Rows that take part, ``size`` of an input partition at a time; a block's number is its partition's and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 24
        for whole in _gathered(batches, size):
            for b in (whole.slice(i, size) for i in range(0, whole.num_rows, size)):
                x, fine = _vectors(b.column("embedding"))
                label = b.column("label")
                fine &= label.is_valid().to_numpy(zero_copy_only=False)
                if fine.any():
                    ids = b.column("vec_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)[fine]
                    labels = label.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[fine]
                    labels = np.where((ids % 7 == 0) & (ids != NO_ID), np.fmod(labels + 1, 10), labels)
                    yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "n": pa.array([int(fine.sum())], pa.int32()), "ids": [ids.tobytes()], "labels": [labels.tobytes()], "vectors": [_packed(x[fine])]})
                    number += 1

    return run


def _anchors(size: int) -> Callable:
    """The anchors of blocks, a row each; ``anchor`` is the place of its row among all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, n, ids, labels, vectors in zip(*(b.column(c).to_pylist() for c in ("block", "n", "ids", "labels", "vectors"))):
                ids, labels, x = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), _unpacked(vectors, n)
                at = np.flatnonzero((ids % 100 == 0) & (ids != NO_ID))
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(block * size + at, pa.int64()), "id": ids[at], "label": labels[at], "vector": pa.array([_packed(x[i : i + 1]) for i in at], pa.binary())})

    return run


def _chunked(anchors: DataFrame, n_chunks: int) -> DataFrame:
    """Anchors (and the scores of their positives, if there are any yet) in rows of about CHUNK."""
    a = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(n_chunks)).cast("int"))
    names = [c for c in a.columns if c != "chunk"]  # the anchor's number first
    whole = a.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("all"))
    return whole.select("chunk", *[F.col("all")[c].alias(f"all_{c}") for c in names])


def _paired(blocks: DataFrame, chunks: DataFrame, n_chunks: int, small: bool) -> DataFrame:
    """Every block beside every chunk: the stated query set against all rows, block by block. A pair is one row of one task."""
    n = blocks.sparkSession.sparkContext.defaultParallelism * 4
    tiled = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    if small:
        return tiled.repartition(n, "block", "chunk").join(F.broadcast(chunks), "chunk")
    salts = 1 + blocks.count() // 16  # a chunk goes once to some 16 blocks
    tiled = tiled.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    return tiled.join(chunks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["chunk", "salt"]).drop("salt")


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly; the narrower side counts as padded by zeros, and what no long holds stops at its ends."""
    k = min(a.shape[1], x.shape[1])
    a, x = a[:, :k], x[:, :k]
    most = k * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0))
    if most < 2**53:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ x.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip((whole(a) @ whole(x).T) if k else np.zeros((len(a), len(x)), object), -_HIGHEST, _HIGHEST).astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, fine: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of the rows that are ``fine``, by descending score and then id."""
    at = np.flatnonzero(fine)
    if len(at) > most:
        least = -np.partition(-score[at], most - 1)[most - 1]
        at = at[score[at] >= least]
    return at[np.lexsort((ids[at], -score[at]))[:most]]


PAIRS = "anchor long, anchor_id long, score long, kind int, id long, row long"


def _score_blocks(pick: Callable, size: int, slice_: int = SLICE) -> Callable:
    """Of each block and chunk the pairs that ``pick`` keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 1) for i in range(whole.num_rows)):
                r = b.to_pylist()[0]
                ids, labels, x = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), _unpacked(r["vectors"], r["n"])
                rows = r["block"] * size + np.arange(r["n"])
                width = max(((len(v) - 1) // (2 if v[:1] == b"h" else 8) for v in r["all_vector"]), default=0)
                a = np.zeros((len(r["all_vector"]), width))
                for i, v in enumerate(r["all_vector"]):
                    v = _unpacked(v, 1)[0]
                    a[i, : len(v)] = v
                out: list[tuple] = []
                for at in range(0, len(a), slice_):
                    s = _scores(a[at : at + slice_], x)
                    for i, score in enumerate(s, at):
                        anchor, same = r["all_anchor"][i], labels == r["all_label"][i]
                        same_other = same & (rows != anchor)
                        found = pick(r, i, score, ids, same, same_other)
                        out += [(anchor, r["all_id"][i], int(score[j]), kind, int(ids[j]), int(rows[j])) for kind, places in found for j in places]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 3 else pa.int64()) for k, c in enumerate(zip(*out))], names=[c.split()[0] for c in PAIRS.split(", ")])

    return run


def _pick_positives(r: dict, i: int, score: np.ndarray, ids: np.ndarray, same: np.ndarray, same_other: np.ndarray) -> list:
    return [(0, _first(score, ids, same_other, POSITIVES))]


def _pick_negatives(r: dict, i: int, score: np.ndarray, ids: np.ndarray, same: np.ndarray, same_other: np.ndarray) -> list:
    """The block's first rows of each window; what is not among a block's first is not among the first of all."""
    keep: set[int] = set()
    for p in r["all_scores"][i] or []:
        # bounds as whole numbers: 30 p <= 100 s <= 90 p
        low, high = -(-LEAST * p // 100), MOST * p // 100
        keep.update(_first(score, ids, ~same & (score >= low) & (score <= high), NEGATIVES).tolist())
    return [(1, sorted(keep))]


def _key(r) -> tuple[bytes, tuple]:
    """(anchor, descending score, positives first, ascending id, row) as bytes that sort in this order."""
    parts = (r[0], _HIGHEST - r[2], r[3], r[4] + 2**63, r[5])
    return b"".join(p.to_bytes(9, "big") for p in parts), (r[0], r[1], r[2], r[3], r[4])


def _sorted(pairs: DataFrame, n: int) -> RDD:
    """Pairs dealt by anchor and sorted by key within each partition, as a stream of (key, pair)."""
    return pairs.rdd.map(_key).repartitionAndSortWithinPartitions(n, lambda key: int.from_bytes(key[:9], "big") * 0x9E3779B1 >> 12 & 0x7FFFFFFF)


def _positives(stream: Iterator) -> Iterator[tuple]:
    anchor, n = None, 0
    for _, (a, _, score, _, id_) in stream:
        anchor, n = a, n + 1 if a == anchor else 1
        if n <= POSITIVES:
            yield a, n, id_, score


def _windows(stream: Iterator) -> Iterator[tuple]:
    """Negatives of the windows that an anchor's positives open, as the scores fall.

    A window waits in a heap until scores have fallen to its upper edge, takes the next NEGATIVES rows and closes then or at its lower
    edge. Only the windows of one anchor are held, none of its rows.
    """
    anchor, waiting, live = None, [], []
    for _, (a, anchor_id, score, kind, id_) in stream:
        if a != anchor:
            anchor, waiting, live = a, [], []
        if kind == 0:
            heapq.heappush(waiting, (-score, len(waiting) + len(live), id_, 0))
            continue
        while waiting and 100 * score <= -MOST * waiting[0][0]:
            p, _, pid, _ = heapq.heappop(waiting)
            live.append([-p, pid, 0])
        live = [w for w in live if w[2] < NEGATIVES and LEAST * w[0] <= 100 * score]
        for w in live:
            w[2] += 1
            yield anchor_id, w[1], w[2], id_, w[0], score


def hard_negatives(rows: DataFrame, block: int = BLOCK, chunk: int = CHUNK, broadcast: int = BROADCAST) -> DataFrame:
    """For each anchor and each of its positives the first negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` (vec_id, embedding, label) are packed into blocks and the anchors into chunks; every block meets every chunk in a task of its own,
    which hands on only pairs that can count: first the block's best rows of the anchor's label, then, with the positives of all blocks
    known, its best rows in each window. Both go through a secondary sort by (anchor, descending score, id), and an iterator opens
    windows at positives and emits negatives; it holds no anchor's pairs. A block passes on at most 5 and then 50 rows an anchor and loses
    none, however the labels are spread.

    Rows with a null label or vector, or a null or non-finite component take no part. A null id is no anchor, sorts last and comes back
    null. Rows with equal ids are rows of their own (equal anchors give equal results twice); ties go to the smaller id. Shorter vectors count as padded
    by zeros; scores beyond a long stop at its ends. Without rows there are none.
    """
    spark = rows.sparkSession
    blocks = saved(rows.select("vec_id", "embedding", "label").mapInArrow(_blocks(block), BLOCKS), "blocks")
    anchors = saved(blocks.mapInArrow(_anchors(block), "anchor long, id long, label long, vector binary"), "anchors")
    size = anchors.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("vector") + 64), F.lit(0)).alias("b")).first()
    if not size.n:
        return spark.createDataFrame([], SCHEMA)
    n_chunks = -(-size.n // chunk)
    n = spark.sparkContext.defaultParallelism
    best = saved(_paired(blocks, _chunked(anchors, n_chunks), n_chunks, size.b <= broadcast).mapInArrow(_score_blocks(_pick_positives, block), PAIRS), "near")
    positives = spark.createDataFrame(_sorted(best, n).mapPartitions(_positives), "anchor long, place int, id long, score long")
    positives = saved(positives, "positives")
    scores = positives.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    known = anchors.join(scores, "anchor")  # an anchor without positives has no windows
    pairs = saved(_paired(blocks, _chunked(known, n_chunks), n_chunks, size.b * 2 <= broadcast).mapInArrow(_score_blocks(_pick_negatives, block), PAIRS), "windows")
    opened = positives.join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor").select("anchor", "anchor_id", "score", F.lit(0).alias("kind"), "id", F.col("place").cast("long").alias("row"))
    out = spark.createDataFrame(_sorted(opened.unionByName(pairs), n).mapPartitions(_windows), SCHEMA)
    given: Callable[[str], Column] = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return out.select("anchor_id", given("positive_id"), "rank", given("negative_id"), "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH fine AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_sum([x[1] * x[2] for x in list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM fine a JOIN fine b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN pairs n USING (anchor_id) WHERE NOT n.same AND {LEAST} * positive_score <= 100 * n.score AND 100 * n.score <= {MOST} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
