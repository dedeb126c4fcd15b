"""Exact dedup by content sort."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import NO_ID, frugal, keep_rows, parts_for, saved, table, text_bytes

SPACES = r"[\x20\x09-\x0D]+"
#: Characters of a text that the sampled splitters see, and bytes of text in a range.
HEAD, PART_BYTES = 32, 64 << 20


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted partition: each row with the number, the first id and the size of its run of equal texts.

    Neighbours are compared in full. Only ids and digests of the run at hand are kept; its text is kept once, and goes along
    with the first row of the partition's first and last run.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int64()), ("first", pa.bool_()), ("run_keep", pa.int64()), ("run_size", pa.int64()), ("edge_text", pa.large_string())])
    last, ids, digest, run = None, [], None, 0

    def out(edge: bool) -> pa.RecordBatch:
        n = len(ids)
        text = [last if edge else None] + [None] * (n - 1)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([digest] * n), pa.array([part] * n, pa.int32()), pa.array([run] * n, pa.int64()), pa.array([True] + [False] * (n - 1)), pa.array([ids[0]] * n, pa.int64()), pa.array([n] * n, pa.int64()), pa.array(text, pa.large_string())], schema=schema)

    for b in batches:
        norm, doc, sha = b.column("norm"), b.column("doc_id").to_pylist(), b.column("text_sha256").to_pylist()
        if not len(doc):
            continue
        ready: list[pa.RecordBatch] = []
        same = [last is not None and norm[0].as_py() == last, *pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)).to_pylist()]
        for i, (d, s, eq) in enumerate(zip(doc, sha, same)):
            if not eq:
                if ids:
                    ready.append(out(run == 0))
                    run, ids = run + 1, []
                if run == 0:
                    last = norm[i].as_py()
            ids.append(d)
            digest = s
        last = norm[len(norm) - 1].as_py()
        if ready:
            yield from pa.Table.from_batches(ready, schema).combine_chunks().to_batches()
    if ids:
        yield out(True)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Sampled splitters range-partition the rows by (first characters of the normalised text, digest, doc_id), so even one large group of copies,
    or many texts with one beginning, spread over partitions; each is sorted externally, which puts equals side by side, and neighbours are
    compared in full. The texts of runs that touch the edge of a partition (two a partition) are then compared in full, too.
    A digest only orders texts with the same beginning; no two texts count as equal for it.
    A null text counts as empty; of rows with equal text and id one is kept; a null id sorts last.
    Extra columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    d = docs.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " ").alias("norm"))
    # the sampled keys reach the driver, so they are a prefix and a digest; the texts themselves follow in the sort
    d = d.select("doc_id", F.substring("norm", 1, HEAD).alias("head"), F.sha2("norm", 256).alias("text_sha256"), "norm")
    last = F.col("doc_id").asc_nulls_last()
    parts = parts_for(docs.sparkSession, text_bytes(docs), PART_BYTES)
    ordered = d.repartitionByRange(parts, "head", "text_sha256", last).sortWithinPartitions("head", "text_sha256", "norm", last).select("doc_id", "text_sha256", "norm")
    rows = saved(ordered.mapInArrow(frugal(_runs), "doc_id long, text_sha256 string, part int, run long, first boolean, run_keep long, run_size long, edge_text string"), "exact")
    merged = (
        rows.where("edge_text is not null")
        .groupBy("edge_text")
        .agg(F.min_by("run_keep", "part").alias("all_keep"), F.sum("run_size").alias("all_size"), F.min("part").alias("head"), F.collect_list(F.struct("part", "run")).alias("at"))
        .select("all_keep", "all_size", "head", F.inline("at"))
    )
    # at most two rows a partition, without their texts
    return rows.drop("edge_text").join(F.broadcast(merged), ["part", "run"], "left").select(
        "doc_id",
        F.when(F.col("head").isNull(), F.col("run_keep")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("first") & (F.coalesce("head", "part") == F.col("part"))).alias("kept"),
        "text_sha256",
    )


def exact_filter(docs: DataFrame) -> DataFrame:
    """The documents, all columns, less all but the first of equal ones."""
    stay = exact_dedup(docs).where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_did"), F.col("text_sha256").alias("_th"))
    return keep_rows(docs, F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " "), 256), stay)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
