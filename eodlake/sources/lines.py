"""Landed files as lines: their first ones, and their cells by the names of each file's own header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one landed file at most, which keeps it within one split.
MOST_ROWS = 100_000
#: Columns of a landed line at most.
WIDTH = 64


def landed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, value) of all lines. Lines of a split are numbered as they are read, so (start of the split, number) grows along a file."""
    at = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), at.alias("at"), "value")


def cells(rows: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """``keep`` and a column for each of ``names`` from lines (value, header): parsed by position, then taken by the line's own header in any case.

    The first column of a name counts, as a header may repeat one; a name that the header lacks is null. The cells come out of a generator, which no condition on
    the columns goes through: one that did would have a parser of its own for each of its uses of a column.
    """
    schema = ", ".join(f"_{i} string" for i in range(WIDTH))
    heads = F.transform(F.split(F.regexp_replace("header", '"', ""), ","), lambda n: F.lower(F.trim(n)))
    rows = rows.withColumns({"heads": heads, "cells": F.from_csv("value", F.lit(schema), {"mode": "PERMISSIVE"})})
    rows = rows.withColumn("cells", F.array(*[F.col(f"cells._{i}") for i in range(WIDTH)]))
    at = lambda n: F.array_position("heads", n.lower())
    rows = rows.select(*keep, F.inline(F.array(F.struct("heads", "cells"))))
    return rows.select(*keep, *[F.when(at(n) > 0, F.try_element_at("cells", at(n).cast("int"))).alias(n) for n in names])


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, header, shown): each file's first line and its first one that isn't blank, without a byte order mark.

    Files are read line by line and a task keeps two lines of each, so files may be of any size. Files without a line have no row.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("place"), F.regexp_replace("value", "^\\ufeff", "").alias("value"))
    return lines.groupBy("file").agg(F.min_by("value", "place").alias("header"), F.min_by("value", F.when(F.trim("value") != "", F.col("place"))).alias("shown"))
