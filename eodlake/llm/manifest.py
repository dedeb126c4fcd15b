"""Merkle manifest of a dataset: digests of rows, content-addressed nodes, and proofs found by descending from the root."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.llm.common import saved, shared_dir, table

ARITY = 16
#: Tables of ranges and sources are broadcast up to this many rows.
FEW = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(**changed: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""

    def part(name: str) -> Column:
        c = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def ranked(rows: DataFrame, tree: str, order: list[Column], tag: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the place of each in its tree (``rank``, from 0) by ``order``, and (tree, n) of the trees.

    Sampled splitters range-partition the rows by (tree, order), so a tree with any share of the rows is dealt over many tasks; a row's
    place is its number in its sorted partition plus the rows of its tree in earlier ones, of which there is one count a
    partition and tree.
    """
    keys = [F.col(tree).asc_nulls_first(), *order]
    placed = rows.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism * 4, *keys).sortWithinPartitions(*keys)
    placed = saved(placed.withColumn("_at", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = W.partitionBy("_tree")
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = saved(counts.select("_tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("n")), f"{tag}-counts")
    few = counts.limit(FEW + 1).count() <= FEW
    shift = counts.select("_tree", "_part", "_shift")
    on = F.col(tree).eqNullSafe(F.col("_tree")) & (part == F.col("_part"))
    out = placed.join(F.broadcast(shift) if few else shift, on).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_tree", "_part", "_shift")
    return out, counts.groupBy(F.col("_tree").alias(tree)).agg(F.max("n").alias("n"))


class Trees:
    """Trees of ``ARITY`` children a node over ranked leaves (tree, rank, digest), stored as digest-to-children records.

    ``store`` has a folder for each level above the leaves, with one record for each distinct digest: what a node holds is found by its
    digest alone. ``tops`` has (tree, digest, height, n): a tree of one leaf is that leaf, height 0.
    """

    def __init__(self, leaves: DataFrame, sizes: DataFrame, tree: str):
        spark = leaves.sparkSession
        self.spark, self.tree, self.store = spark, tree, f"{shared_dir(spark)}/eodlake-nodes-{uuid.uuid4().hex}"
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.store)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
        most = sizes.agg(F.max("n")).first()[0] or 0
        nodes, tops, self.height = leaves.select(tree, F.col("rank").alias("at"), "digest", F.col("n").alias("left")), [], 0
        while True:
            tops.append(nodes.where("left = 1").select(tree, "digest", F.lit(self.height).alias("height")))
            if most <= 1:
                break
            most, self.height = -(-most // ARITY), self.height + 1
            runs = nodes.where("left > 1").groupBy(tree, F.floor(F.col("at") / ARITY).alias("at"), F.ceil(F.col("left") / ARITY).alias("left"))
            nodes = runs.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]).alias("children"))
            nodes = saved(nodes.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), f"level{self.height}")
            nodes.select("digest", "children").dropDuplicates(["digest"]).write.parquet(f"{self.store}/level={self.height}")
        self.tops = saved(reduce(DataFrame.unionByName, tops), "tops")

    def records(self, level: int) -> DataFrame:
        return self.spark.read.schema("digest string, children array<string>").parquet(f"{self.store}/level={level}")

    def descend(self, requests: DataFrame, tops: DataFrame) -> DataFrame:
        """``requests`` (tree, rank, ...) with ``found``, the digest of that leaf, and ``path``: the siblings before and after it, level by level from the leaf up.

        ``tops`` has (tree, digest, height, above), where ``above`` is the path from a tree's top to the root, from the root down. Requests go down together as
        long as their ranks' digits agree: at each level a node's record is looked up by its digest, the next digit picks a child,
        and what is not picked is collected. Paths are reversed at the end. A node has at most ``ARITY`` digits below it, so no key is hot in the
        joins by place; below a node that several trees share, Spark splits large partitions of the join by digest.
        """
        t, shift = self.tree, lambda k: F.shiftright(F.col("rank"), 4 * k).alias("at")
        wanted = {self.height: None}
        for level in range(1, self.height + 1):  # the distinct prefixes of the ranks, from those of the level below
            below = requests.select(t, "rank") if level == 1 else wanted[level - 1].select(t, F.col("at").alias("rank"))
            wanted[level] = saved(below.select(t, shift(1)).distinct(), f"wanted{level}") if level < self.height else None
        here = tops.where(F.col("height") == self.height).select(t, F.lit(0).cast("bigint").alias("at"), "digest", F.col("above").alias("path"))
        for level in range(self.height, 1, -1):
            down = wanted[level - 1].withColumnsRenamed({t: "_t", "at": "_at"})
            open_nodes = here.join(self.records(level), "digest")
            next_nodes = open_nodes.join(down, F.col(t).eqNullSafe(F.col("_t")) & (F.col("at") == F.shiftright("_at", 4)))
            here = next_nodes.select(t, F.col("_at").alias("at"), *_picked(F.col("_at")))
            entering = tops.where(F.col("height") == level - 1).select(t, F.lit(0).cast("bigint").alias("at"), "digest", F.col("above").alias("path"))
            here = saved(here.unionByName(entering), f"descent{level}")
        lone = tops.where("height = 0").select(F.col(t).alias("_t"), F.lit(0).cast("bigint").alias("_up"), F.col("digest").alias("_lone"), F.lit(None).cast("array<string>").alias("children"), F.col("above").alias("path"))
        if self.height:
            bottom = here.join(self.records(1), "digest").select(F.col(t).alias("_t"), F.col("at").alias("_up"), F.lit(None).cast("string").alias("_lone"), "children", "path")
            lone = lone.unionByName(bottom)
        r = requests.join(lone, F.col(t).eqNullSafe(F.col("_t")) & (F.shiftright("rank", 4) == F.col("_up")))
        digest, path = _picked(F.col("rank"))
        found = F.coalesce("_lone", digest).alias("found")
        return r.select(*requests.columns, found, F.reverse(F.when(F.col("children").isNull(), F.col("path")).otherwise(path)).alias("path"))


def _picked(at: Column) -> tuple[Column, Column]:
    """The child of ``children`` that the last digit of ``at`` names, and ``path`` with the others before and after it."""
    digit = F.pmod(at, F.lit(ARITY)).cast("int")
    others = F.struct(F.array_join(F.slice("children", F.lit(1), digit), "").alias("before"), F.array_join(F.slice("children", digit + 2, F.lit(ARITY)), "").alias("after"))
    return F.element_at("children", digit + 1).alias("digest"), F.concat(F.col("path"), F.array(others)).alias("path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; and source, rank and the path itself.

    Leaves are digests of the rows; each source has a tree over its leaves by doc_id, and one more tree stands over the sources' tops. Each
    leaf's proof is found by descending from the root through the stored records. ``tampered`` replaces the text for the fold only (by
    default where 5 divides the CRC of doc_id, whose text is lower-cased). Texts are read once and never shuffled.

    Nulls are written as ``-``; a null source is a source of its own and comes first; a null id comes last in its source and is not
    tampered with; rows with equal ids go by their digest, and equal rows are leaves of their own. A lone leaf is its source's top, a lone source's
    top is the root. An empty table gives no rows; other columns are ignored.
    """
    if tampered is None:
        hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
        tampered = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    changed = ~tampered.eqNullSafe(F.col("text"))
    rows = docs.select("doc_id", "source", row_digest().alias("digest"), F.when(changed, row_digest(text=tampered)).alias("changed"))
    rows = saved(rows, "digests")  # the splitters' sample reads this and not the texts again
    leaves, sizes = ranked(rows, "source", [F.col("doc_id").asc_nulls_last(), F.col("digest")], "leaves")
    few = sizes.limit(FEW + 1).count() <= FEW
    n = sizes.withColumnRenamed("source", "_source")
    leaves = saved(leaves.join(F.broadcast(n) if few else n, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), "ranked")
    trees = Trees(leaves, sizes, "source")
    tops, top_sizes = ranked(trees.tops.withColumn("dataset", F.lit(0)), "dataset", [F.col("source").asc_nulls_first()], "sources")
    above = Trees(saved(tops.join(F.broadcast(top_sizes), "dataset"), "tops"), top_sizes, "dataset")  # one row
    root = above.tops.select("dataset", F.col("digest").alias("root"))
    start = above.tops.withColumn("above", F.array().cast("array<struct<before:string,after:string>>"))
    entry = above.descend(tops.select("dataset", "source", "height", "rank"), start)
    # paths are kept from the root down until the leaf is reached
    entry = saved(entry.select("source", "height", F.col("found").alias("digest"), F.reverse("path").alias("above")), "entries")
    found = trees.descend(leaves.select("doc_id", "source", "rank", F.col("digest").alias("leaf"), "changed"), entry)
    of = entry.select(F.col("source").alias("_source"), F.col("digest").alias("subroot"))
    found = found.join(F.broadcast(of) if few else of, F.col("source").eqNullSafe(F.col("_source"))).crossJoin(F.broadcast(root))  # one row
    out = found.select("doc_id", "source", "rank", "leaf", "found", "subroot", "root", "path", fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    return out.withColumns({"proof_sha256": proof, "verified": F.col("folded_root") == F.col("root")})


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _leaf_sql(text: str) -> str:
    parts = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(CAST(octet_length(encode({p})) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


#: CRC-32 of a decimal number, bit by bit.
_CRC = "xor(list_reduce([CAST(ascii(x) AS BIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')], lambda c, b: list_reduce(range(8), lambda k, i: xor(k >> 1, 3988292384 * (k & 1)), xor(c, b)), 4294967295 :: BIGINT), 4294967295)"
_TAMPERED = f"CASE WHEN ({_CRC}) % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"


def _up_sql(name: str, start: str, by: str) -> str:
    key = f"{by}, " if by else ""
    return f"""{name} AS ({start} UNION ALL
  SELECT {key}l + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM {name} WHERE n > 1 GROUP BY {key}l, i // 16)"""


_SIBLINGS = "coalesce(string_agg(u.d, '' ORDER BY u.i) FILTER (u.i < f.r >> (4 * u.l)), '') || '|' || coalesce(string_agg(u.d, '' ORDER BY u.i) FILTER (u.i > f.r >> (4 * u.l)), '') AS s"
SQL = f"""
WITH RECURSIVE digests AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql(f"({_TAMPERED})")} AS used FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM digests),
{_up_sql("up", "SELECT source, 0 AS l, r AS i, leaf AS d, n FROM leaves", "source")},
tops AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM up WHERE n = 1),
{_up_sql("over_all", "SELECT 0 AS l, r AS i, d, n FROM tops", "")},
levels AS (
  SELECT f.source, f.r, u.l, {_SIBLINGS} FROM leaves f JOIN up u ON u.source IS NOT DISTINCT FROM f.source AND u.n > 1 AND u.i >> 4 = f.r >> (4 * (u.l + 1)) GROUP BY ALL),
top_levels AS (SELECT f.source, 1000 + u.l AS l, {_SIBLINGS} FROM tops f JOIN over_all u ON u.n > 1 AND u.i >> 4 = f.r >> (4 * (u.l + 1)) GROUP BY f.source, f.r, u.l),
paths AS (
  SELECT source, r, list(s ORDER BY l) AS path FROM (
    SELECT * FROM levels UNION ALL SELECT f.source, f.r, t.l, t.s FROM leaves f JOIN top_levels t ON t.source IS NOT DISTINCT FROM f.source) GROUP BY source, r),
folded AS (
  SELECT doc_id, leaf, tops.d AS subroot, (SELECT d FROM over_all WHERE n = 1) AS root, sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
    list_reduce(coalesce(path, [] :: VARCHAR[]), lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2)), used) AS folded_root
  FROM leaves f LEFT JOIN paths p ON p.source IS NOT DISTINCT FROM f.source AND p.r = f.r JOIN tops ON tops.source IS NOT DISTINCT FROM f.source)
SELECT *, folded_root = root AS verified FROM folded
"""
