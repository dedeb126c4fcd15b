"""Near-dedup: MinHash bands, sequential Bayesian pruning of candidates, exact check of what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eodlake.llm.common import NO_ID, U64, chunks, frugal, grams, identified, keep_rows, mix, saved, table, words_of
from eodlake.llm.components import components

#: Bands and hashes a band: a pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^28 = 4e-7.
BANDS, ROWS = 28, 4
#: Signature bytes compared at a time, and the chance of being similar below which a candidate is given up.
BATCH, MISS = 16, 1e-7
#: Leaders of a bucket differ by so many orders, so that a group whose members are alike only through some of them holds together.
ORDERS = 3
#: Nodes of a block when strays meet a whole component.
CELL = 512
#: Members checked against one copy of a leader's text.
PER_LEADER = 400


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of ``k`` consecutive words; of fewer words the whole sequence is one; none without words."""
    if not len(h):
        return h
    n = min(k, len(h))
    return np.unique(mix(grams(h, n), np.full(1, n, np.uint64)))


_seeds = np.random.default_rng(77).integers(0, 2**32, (2, BANDS * ROWS, 1), dtype=np.uint32)
_XOR, _ODD = _seeds[0], _seeds[1] | np.uint32(1)


def minima(s: np.ndarray) -> np.ndarray:
    """Smallest value of a set under each hash."""
    x, best = (s >> U64(32)).astype(np.uint32), None
    for at in range(0, len(x), 1024):
        y = (x[None, at : at + 1024] ^ _XOR) * _ODD
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        low = y.min(axis=1)
        best = low if best is None else np.minimum(best, low)
    return best


def signer(k: int) -> Callable:
    names = ["did", "th", "n", "node", "sig", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(BANDS, dtype=np.uint64)
        for did, th, texts in chunks(batches, ["did", "th", "text"], "text", 1 << 20):
            h, at = words_of(texts, lower=True)
            n, node, sig, bands = [], [], [], []
            for a, b in zip(at[:-1], at[1:]):
                s = shingles(h[a:b], k)
                n.append(len(s))
                if not len(s):
                    node.append(None), sig.append(None), bands.append(None)
                    continue
                total = mix(s, s[:1] * 0).sum(dtype=np.uint64)
                node.append(int(mix(np.array([total]), np.array([len(s)], np.uint64)).view(np.int64)[0]))
                low = minima(s)
                sig.append((low & np.uint32(255)).astype(np.uint8).tobytes())
                two = low.reshape(BANDS, ROWS).astype(np.uint64)
                bands.append(mix(mix(two[:, 0] << U64(32) | two[:, 1], two[:, 2] << U64(32) | two[:, 3]), salt).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(did, pa.int64()), pa.array(th, pa.int64()), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=names)

    return run


def least_matches(threshold: float, n: int, miss: float = MISS, prior: np.ndarray | None = None) -> int:
    """Fewest equal bytes among ``n`` that leave a chance of ``miss`` or more for a similarity over ``threshold``.

    The posterior is over a grid of similarities with a flat prior; different minima agree in a byte once in 256.
    """
    s = (np.arange(2000) + 0.5) / 2000
    p = s + (1 - s) / 256
    for m in range(n + 1):
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        w = np.exp(log - log.max()) * (1 if prior is None else prior)
        if w[s >= threshold].sum() / w.sum() >= miss:
            return m
    return n


def pruner(threshold: float) -> Callable:
    steps = [(n, least_matches(threshold, n)) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for c in ("sig_a", "sig_b"))
            left, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
            for n, fewest in steps:  # each batch of bytes only for the pairs that are left
                equal[left] += (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
                left = left[equal[left] >= fewest]
            yield batch.select([c for c in batch.schema.names if not c.startswith("sig_")]).take(pa.array(left))

    return run


def checker(k: int, percent: int) -> Callable:
    """Streams of a leader's text followed by its candidates' texts, to the links that hold on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, mine = None, None
        for a, b, texts in chunks(batches, ["a", "b", "text"], "text", 1 << 20):
            h, at = words_of(texts, lower=True)
            out = []
            for i in range(len(a)):
                s = shingles(h[at[i] : at[i + 1]], k)
                if b[i] is None:
                    leader, mine = a[i], s
                    continue
                if leader != a[i]:
                    raise AssertionError("a leader's text precedes its candidates")
                both = len(np.intersect1d(mine, s, assume_unique=True))
                if 100 * both >= percent * (len(mine) + len(s) - both):
                    out.append((a[i], b[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return run


def verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose classes are similar: pruned by signature, then checked on their full sets."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("did").alias(f"did_{x}"), F.col("th").alias(f"th_{x}"), F.col("sig").alias(f"sig_{x}"))
    signed = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "did_a", "th_a", "did_b", "th_b", "sig_a", "sig_b")
    schema = "a long, b long, did_a long, th_a long, did_b long, th_b long"
    left = saved(signed.mapInArrow(frugal(pruner(percent / 100)), schema), "candidates")
    salts = left.groupBy("a").agg(F.ceil(F.count("*") / PER_LEADER).alias("salts"))
    left = left.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), "salts"))
    need = left.select(F.col("did_b").alias("did"), F.col("th_b").alias("th"), "a", "b", "salt").unionByName(
        left.select(F.col("did_a").alias("did"), F.col("th_a").alias("th"), "a", F.lit(None).cast("long").alias("b"), "salt").distinct()
    )
    streams = texts.join(need, ["did", "th"]).select("a", "b", "salt", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return streams.select("a", "b", "text").mapInArrow(frugal(checker(k, percent)), "a long, b long")


def cell_checker(k: int, percent: int) -> Callable:
    """Cells of strays (role 1) and the nodes that each is compared with (role 0), to a forest of the links that hold.

    Comparison goes as for single pairs: signature bytes in batches for all nodes at once, then full sets. Links that
    only join what is joined already are left out, so a cell gives fewer links than it has nodes.
    """
    steps = [(n, least_matches(percent / 100, n)) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]

    def links(cell: list[tuple]) -> Iterator[tuple[int, int]]:
        h, at = words_of([r[4] for r in cell], lower=True)
        sets = [shingles(h[a:b], k) for a, b in zip(at[:-1], at[1:])]
        strays = [i for i, r in enumerate(cell) if r[1] == 1]
        nodes = np.array([i for i, r in enumerate(cell) if r[1] == 0], np.int64)
        if not len(nodes):
            return
        signs = np.frombuffer(b"".join(r[3] for r in cell), np.uint8).reshape(-1, BANDS * ROWS)
        size = np.array([len(x) for x in sets])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        for i in strays:
            left = nodes[100 * np.minimum(size[nodes], size[i]) >= percent * np.maximum(size[nodes], size[i])]
            equal = np.zeros(len(cell), np.int64)
            for n, fewest in steps:
                equal[left] += (signs[left, n - BATCH : n] == signs[i, n - BATCH : n]).sum(axis=1)
                left = left[equal[left] >= fewest]
            for j in left.tolist():
                a, b = find(cell[i][2]), find(cell[j][0])
                if a == b:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    root[a] = b
                    yield cell[i][2], cell[j][2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, name = [], None
        columns = ["g", "i", "j", "role", "node", "component", "sig", "text"]
        for rows in chunks(batches, columns, "text", 1 << 20):
            out = []
            for g, i, j, role, node, component, sig, text in zip(*rows):
                if (g, i, j) != name:
                    out += links(cell) if cell else []
                    cell, name = [], (g, i, j)
                cell.append((component, role, node, sig, text) if role == 0 else (None, role, node, sig, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
        out = list(links(cell)) if cell else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return run


def stray_links(texts: DataFrame, classes: DataFrame, strays: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between each stray and all that its group holds; strays (g, node), members (g, node).

    A group is cut into blocks, each block of strays meets each block of nodes in one cell, and pairs are only formed
    inside a cell, so a group of any size is neither one task nor a table of its pairs.
    """
    every = members.unionByName(strays).distinct()
    n = every.groupBy("g").agg(F.ceil(F.count("*") / CELL).alias("rows")).join(strays.groupBy("g").agg(F.ceil(F.count("*") / CELL).alias("columns")), "g")
    block = lambda size: F.pmod(F.xxhash64("node"), F.col(size))
    spread = lambda size: F.explode(F.sequence(F.lit(0).cast("long"), F.col(size) - 1))
    a = every.join(n, "g").select("g", "node", block("rows").alias("i"), spread("columns").alias("j"), F.lit(0).alias("role"))
    b = strays.join(n, "g").select("g", "node", spread("rows").alias("i"), block("columns").alias("j"), F.lit(1).alias("role"))
    cells = a.unionByName(b).join(classes.select("node", "did", "th", "sig"), "node")
    known = members.select("g", "node", F.col("g").alias("component"))
    cells = cells.join(known, ["g", "node"], "left").withColumn("component", F.coalesce("component", "node"))
    rows = texts.join(cells, ["did", "th"]).select("g", "i", "j", "role", "node", "component", "sig", "text")
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "role", "node").mapInArrow(frugal(cell_checker(k, percent)), "a long, b long")


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, th (a hash of its text), stays (first of its group).

    1. A document's signature comes from its distinct ``k``-word shingles. Documents with equal sets are one class from here
       on, so any number of exact copies costs one row.
    2. Classes that share a band are a bucket. Each member is a candidate with its bucket's leader, one of three orders
       by band, so a large group gives a few pairs a member, not all pairs.
    3. Candidates are pruned in batches of signature bytes by the posterior chance of a similarity over the threshold, and
       the survivors are checked on their full sets. Links become components.
    4. In buckets whose members still lie in several components, those outside the bucket's main component are strays. Each is
       compared with all of that component and with the bucket's other strays, block by block, so no link is lost.

    Documents without words link with nothing. Rows with equal ids are nodes of their own. A null id is larger than
    any other and shows as null. An empty table gives no rows.
    """
    texts = identified(docs)
    signs = saved(texts.mapInArrow(frugal(signer(k)), "did long, th long, n long, node long, sig binary, bands array<long>"), "signatures")
    classes = saved(
        signs.where("node is not null").groupBy("node").agg(F.min(F.struct("did", "th")).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")).select("node", "rep.*", "n", "sig", "bands"),
        "classes",
    )
    members = classes.select("node", "n", F.explode("bands").alias("key"))
    ranked = F.struct(F.xxhash64("node", F.pmod("key", F.lit(ORDERS))).alias("rank"), F.col("node").alias("a"), F.col("n").alias("n_a"))
    leaders = members.groupBy("key").agg(F.min(ranked).alias("leader"), F.count("*").alias("size")).where("size > 1").select("key", "leader.a", "leader.n_a")
    close = f"100 * least(n, n_a) >= {percent} * greatest(n, n_a)"
    tried = saved(members.join(leaders, "key").where("node != a").where(close).select("a", F.col("node").alias("b")).distinct(), "tried")
    links = saved(verified(texts, classes, tried, k, percent), "similar")
    found = components(links)

    named = saved(members.join(found, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component")), "named")
    split = named.groupBy("key", "component").agg(F.count("*").alias("size")).groupBy("key").agg(F.max_by("component", "size").alias("main"), F.count("*").alias("parts"), F.sum("size").alias("all")).where("parts > 1 and all > 2").select("key", "main")
    strays = saved(named.join(split, "key").where("component != main").select(F.col("main").alias("g"), "node").distinct(), "strays")
    if strays.limit(1).count():
        whole = classes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("g"))
        members = whole.join(strays.select("g").distinct(), "g", "left_semi").select("g", "node")
        more = saved(stray_links(texts, classes, strays, members, k, percent), "similar")
        found = components(links.unionByName(more))

    groups = found.join(classes.select("node", F.struct("did", "th").alias("rep")), "node")
    least = groups.groupBy("component").agg(F.min("rep").alias("least"))
    groups = groups.select("node", "component").join(least, "component").select("node", "least")
    alone = classes.select("node", F.struct("did", "th").alias("own")).join(groups, "node", "left").select("node", F.coalesce("least", "own").alias("first"))
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return (
        signs.select("did", "th", "n", "node")
        .join(alone, "node", "left")
        .withColumn("component_id", F.coalesce("first.did", "did"))
        .select(
            back("did").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            back("component_id").alias("component_id"),
            (F.col("did") == F.col("component_id")).alias("kept"),
            "th",
            (F.col("first").isNull() | ((F.col("did") == F.col("first.did")) & F.col("th").eqNullSafe(F.col("first.th")))).alias("stays"),
        )
    )


def near_filter(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, less all but the first of each near-duplicate group (and of equal rows)."""
    stay = near_dedup(docs, k, percent).where("stays").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_did"), F.coalesce("th", F.lit(0)).alias("_th"))
    return keep_rows(docs, F.coalesce(F.xxhash64("text"), F.lit(0)), stay)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), k=2).drop("th", "stays")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS shingle FROM s),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
e AS (SELECT a, b FROM met WHERE 100 * k >= 80 * (na + nb - k)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, l.b FROM r JOIN l ON r.c = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM s JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) m ON m.d = s.doc_id
"""
