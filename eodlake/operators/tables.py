"""Upserts and partial updates of stored tables, and the small state tables of the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.operators.actions import latest_wins


def upserted(target: DataFrame, source: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """``target`` with the rows of ``source`` in place of those with the same keys; of source rows the last by ``order`` wins."""
    new = latest_wins(source, keys, order) if order is not None else source.dropDuplicates(keys)
    return target.join(new.select(keys), keys, "left_anti").unionByName(new.select(target.columns))


def updated(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the fields that ``changes`` supplies; a missing field leaves the stored value."""
    fields = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, *[F.col(c).alias(f"_{c}") for c in fields])
    t = target.join(new, keys, "left")
    return t.select(*[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in target.columns])


def replace_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Write ``rows`` over the partitions that they belong to, and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def not_loaded(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows of days and exchanges without a successful load."""
    done = loads.where("upload_status = 'SUCCESS'").select("trade_date", "exchange").distinct()
    return rows.join(done, ["trade_date", "exchange"], "left_anti")


def succeeded(cursor: DataFrame, failures: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cursor moved to each day of ``done`` (indicator_id, trade_date, at), and the failures without that day's."""
    latest = done.select("indicator_id", F.col("trade_date").alias("latest_trade_date"), F.lit("SUCCESS").alias("status"), F.col("at").alias("date_of_run"))
    moved = upserted(cursor, latest, ["indicator_id"], F.col("latest_trade_date"))
    return moved, failures.join(done, ["indicator_id", "trade_date"], "left_anti")


def failed(registry: DataFrame, failures: DataFrame, lost: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The registry with each indicator of ``lost`` (indicator_id, trade_date, error_message, failed_at) switched off, and its failure."""
    ids = lost.select(F.col("indicator_id").alias("_id")).distinct()
    off = registry.join(ids, F.col("indicator_id") == F.col("_id"), "left").withColumn("status", F.when(F.col("_id").isNotNull(), "DEACTIVE").otherwise(F.col("status"))).drop("_id")
    return off, upserted(failures, lost, ["indicator_id", "trade_date"], F.col("failed_at"))


def different(stored: DataFrame, fresh: DataFrame, group: list[str], keys: list[str], fields: list[str]) -> DataFrame:
    """Rows that ``stored`` and ``fresh`` do not share: (keys, each field as was_ and is_), null where a side has no such row.

    Each group's rows are first summed up as hashes on either side, before any row is shuffled and whatever their order; only groups
    whose sums differ are compared row by row.
    """
    of = lambda df: df.groupBy(*group).agg(F.count("*").alias("n"), F.sum(F.xxhash64(*keys, *fields).cast("decimal(20,0)")).alias("h"))
    a, b = (of(x).select(*group, F.struct("n", "h").alias(name)) for x, name in ((stored, "was"), (fresh, "is")))
    odd = a.join(b, group, "full").where(~F.col("was").eqNullSafe(F.col("is"))).select(*group)
    side = lambda df, x: df.join(odd, group, "left_semi").select(*keys, F.struct(*fields).alias(f"_{x}"))
    rows = side(stored, "was").join(side(fresh, "is"), keys, "full").where(~F.col("_was").eqNullSafe(F.col("_is")))
    return rows.select(*keys, *[F.col(f"_{x}")[f].alias(f"{x}_{f}") for x in ("was", "is") for f in fields])
