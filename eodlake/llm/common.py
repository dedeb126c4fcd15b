"""Shared pieces of the training-data operators: inputs, written intermediate tables, vectorised words and hashes."""

from __future__ import annotations

import contextlib
import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents without an id sort after all others and count as larger than any id.
NO_ID = 2**63 - 1
U64 = np.uint64
_C1, _C2, _C3 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)


#: Rows of one Arrow batch at most: texts are long, and a batch is held twice on either side of the pipe to a worker.
BATCH_ROWS = 1000
#: What a row takes besides its text.
ROW_BYTES = 64


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of texts to a few megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the path goes to Spark's reader only, so any store that Spark knows will do."""
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset, a temporary one on this machine if the executors are here too."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def let_go(spark: SparkSession) -> None:
    """Have Spark remove shuffle files to which nothing refers any longer."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a table that is written inside go as soon as it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage.

    A lost executor then costs a re-read instead of a recomputation. The table goes when the driver's JVM ends. Before
    the write, shuffle files of earlier tables, to which nothing refers any longer, are let go.
    """
    spark = small_batches(df.sparkSession)
    path = f"{shared_dir(spark)}/eodlake-{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    let_go(spark)
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, n: int, tag: str) -> DataFrame:
    """``saved``, dealt by ``key`` into ``n`` buckets, so that joins on the key need not shuffle it again.

    Spark writes buckets to named tables only; the name leaves the catalog at once, the files when the driver's JVM ends.
    """
    spark = small_batches(df.sparkSession)
    name = f"eodlake_{tag}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    let_go(spark)
    with tidy(spark):
        df.repartition(n, key).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    found = spark.table(name)  # holds the files and their buckets
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
    return found


def dropped(df: DataFrame) -> None:
    """Remove a table that ``saved`` wrote and that nothing will read again."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def parts_for(spark: SparkSession, n_bytes: float, each: int) -> int:
    """How many hash ranges hold ``n_bytes`` with about ``each`` bytes in one."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(n_bytes / each))


def identified(docs: DataFrame) -> DataFrame:
    """(did, th, text): a sortable id and a hash of the text, which tell rows apart even when ids repeat or are null.

    Rows with equal (did, th) are equal documents, so a result found for one holds for the other.
    """
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts; one narrow scan, used to size hash ranges."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for later stages, next to others and the executor's heap."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def frugal(run: Callable) -> Callable:
    """A task's function over batches that gives freed memory back when its rows are done, so that a worker that waits for its next task is small."""

    def rows(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return rows


def keep_freed(most: int = 256 << 20) -> None:
    """Have this process use freed memory again, up to ``most`` bytes, until ``give_back``: arrays of megabytes otherwise come as new pages each time."""
    import ctypes

    with contextlib.suppress(OSError, AttributeError):  # glibc only
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, most)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, most)  # M_TRIM_THRESHOLD


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit numbers."""
    x = a * _C1
    x += b
    x ^= x >> U64(29)
    x *= _C2
    x ^= x >> U64(32)
    x *= _C3
    return x


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` symbols; ``h`` hashes single symbols. Two overlapping halves fix a run."""
    size = 1
    while size * 2 <= n:
        h, size = mix(h[: len(h) - size], h[size:]), size * 2
    return h if size == n else mix(h[: len(h) - (n - size)], h[n - size :])


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(range(256)).lower()
_BYTE = np.random.default_rng(20240).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x2545F4914F6CDD1D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, U64(base))
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _some_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = np.empty(len(b) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = SPACE[b]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h, (end - start).astype(np.uint64)), start, end


def words(b: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word ``[^\\x20\\x09-\\x0D]+`` of a byte array, ``most`` bytes at a time."""
    out, at = [], 0
    while at < len(b):
        end = min(len(b), at + most)
        while end < len(b) and not SPACE[b[end]]:  # cut at white space only
            more = np.flatnonzero(SPACE[b[end : end + most]])
            end = end + int(more[0]) if len(more) else min(len(b), end + most)
        h, s, e = _some_words(b[at:end])
        out.append((h, s + at, e + at))
        at = end
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a space after each, and where each begins (with the end as last entry)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return np.frombuffer(b" ".join([*texts, b""]), np.uint8), at


def words_of(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after the other, and offsets of each text's words (one more than texts)."""
    b, at = joined([t.translate(_LOWER) for t in texts] if lower else texts)
    h, start, _ = words(b)
    return h, np.searchsorted(start, at)


def chunks(batches: Iterable, columns: list[str], text: str, most: int) -> Iterator[tuple[list, ...]]:
    """Lists of the columns of Arrow batches, cut into pieces of about ``most`` bytes of text (encoded); a row counts as ROW_BYTES more."""
    out, size = [[] for _ in columns], 0
    k = columns.index(text)
    for whole in batches:
        for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
            for row in zip(*(batch.column(c).to_pylist() if c != text else _utf8(batch.column(c)) for c in columns)):
                for o, v in zip(out, row):
                    o.append(v)
                size += len(row[k]) + ROW_BYTES
                if size >= most:
                    yield tuple(out)
                    out, size = [[] for _ in columns], 0
    if out[0]:
        yield tuple(out)


def steps(batch, rows: int, most: int = 1 << 20) -> Iterator:
    """Slices of an Arrow batch, of ``rows`` rows at most and, but for a longer text, about ``most`` bytes of text."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        full = int(np.searchsorted(size, (size[at - 1] if at else 0) + most)) + 1
        end = min(full, at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _utf8(column) -> list[bytes]:
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def crc_mod(doc_id: str, k: int) -> Column:
    """crc32 of the id written as text, modulo ``k``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % k


def keep_rows(docs: DataFrame, th: Column, stay: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (id, ``th``) is in ``stay`` (_did, _th); one of equal rows. Columns of ``docs`` may have any names."""
    key = f"_{uuid.uuid4().hex}"
    keyed = docs.withColumn(key, F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), th.alias("th")))
    stay = stay.select(F.struct(F.col("_did").alias("did"), F.col("_th").alias("th")).alias(key)).distinct()
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(docs.columns)
