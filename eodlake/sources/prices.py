"""Daily price files: three CSV layouts found by their header, columns taken by name, files checked as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.functions.columns import named, parse_date, parse_decimal, parse_int, percent_change
from eodlake.sources.lines import cells, first_lines, landed

# Column names of the three layouts (v1: first exchange before 2024, v3: second before 2024, v2: both since).
V1 = {"symbol": "SYMBOL", "series": "SERIES", "isin": "ISIN", "open": "OPEN", "high": "HIGH", "low": "LOW", "close": "CLOSE", "last": "LAST", "prev_close": "PREVCLOSE", "tot_trd_val": "TOTTRDVAL", "tot_trd_qty": "TOTTRDQTY", "total_trades": "TOTALTRADES", "trade_date": "TIMESTAMP"}
V2 = {"symbol": "TckrSymb", "series": "SctySrs", "isin": "ISIN", "open": "OpnPric", "high": "HghPric", "low": "LwPric", "close": "ClsPric", "last": "LastPric", "prev_close": "PrvsClsgPric", "tot_trd_val": "TtlTrfVal", "tot_trd_qty": "TtlTradgVol", "total_trades": "TtlNbOfTxsExctd", "trade_date": "TradDt"}
LAYOUTS = {"v1": V1, "v2": V2, "v3": V2}
PRICES = ["open", "high", "low", "close", "last", "prev_close", "tot_trd_val"]
COUNTS = ["tot_trd_qty", "total_trades"]
LEGACY_UNTIL = "2024-01-01"


def layout_of(header: Column) -> Column:
    """v1, v2, v3 or null, from the first line of a file: names in any case, a byte order mark in front allowed."""
    names = F.transform(F.split(F.lower(F.regexp_replace(header, "^\\ufeff|\"", "")), ","), F.trim)
    has = lambda n: F.array_contains(names, n.lower())
    return F.when(has("TradDt") & has("Src"), "v2").when(has("TradDt"), "v3").when(has("SYMBOL") & has("TIMESTAMP"), "v1")


def project(rows: DataFrame, layout: Column | str) -> DataFrame:
    """Rows of all layouts, all columns strings, in the common schema; ``layout`` is each row's, or the name of the one that all rows have."""
    layout = F.lit(layout)
    first = layout == "v1"
    exchange = F.when(first, "NSE").when(layout == "v3", "BSE").otherwise(named(rows, "Src"))
    pick = lambda c: F.when(first, named(rows, V1[c])).otherwise(named(rows, V2[c]))
    close, prev = parse_decimal(pick("close")), parse_decimal(pick("prev_close"))
    extra = [c for c in ("file", "line") if c in rows.columns]
    return rows.select(
        pick("symbol").alias("symbol"),
        exchange.alias("exchange"),
        pick("series").alias("series"),
        pick("isin").alias("isin"),
        *[parse_decimal(pick(c)).alias(c) for c in PRICES],
        *[parse_int(pick(c)).alias(c) for c in COUNTS],
        parse_date(pick("trade_date")).alias("trade_date"),
        percent_change(close, prev).cast("decimal(38,13)").alias("ltp_percent_change"),
        *extra,
    )


def file_facts(file: Column) -> tuple[Column, Column]:
    """Exchange and day of a file named like NSE-BC-05-JAN-2024.csv."""
    part = lambda k: F.nullif(F.regexp_extract(file, r"([A-Z]+)-BC-(\d{1,2}-[A-Za-z]{3}-\d{4})\.", k), F.lit(""))
    return part(1), F.try_to_date(F.initcap(part(2)), "d-MMM-yyyy")


def is_legacy(day: Column) -> Column:
    return day < F.lit(LEGACY_UNTIL).cast("date")


def headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, header, layout) of each file with a line; pages of markup have layout null."""
    return first_lines(spark, paths).select("file", "header").withColumn("layout", layout_of(F.col("header")))


def from_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all layouts and the files that are none (file), from lines (file, at, value), also of a stream's batch.

    The first line of each file is found by one aggregation and joined to the others, so a file's lines stay dealt as they were read, however many they are.
    Each line is parsed by position and then taken by the names of its own file's header, so layouts and column orders may be mixed freely, and no name goes
    through the driver. ``line`` grows along a file.
    """
    heads = lines.groupBy(F.col("file").alias("_file")).agg(F.min(F.struct("at", F.regexp_replace("value", "^\\ufeff", "").alias("header"))).alias("head"))
    heads = heads.select("_file", F.col("head.at").alias("_at"), F.col("head.header").alias("header"), layout_of(F.col("head.header")).alias("layout"))
    known = sorted({n for layout in LAYOUTS.values() for n in layout.values()} | {"Src"})
    placed = lines.join(heads.where("layout is not null"), (F.col("file") == F.col("_file")) & (F.col("at") > F.col("_at")) & (F.trim("value") != "")).withColumn("line", F.col("at"))
    return project(cells(placed, known, "file", "line", "layout"), F.col("layout")), heads.where("layout is null").select(F.col("_file").alias("file"))


def scan(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of all price files with their file and line, and the files that are none (file)."""
    return from_lines(landed(spark, paths))


def first_in_file(rows: DataFrame) -> DataFrame:
    """The first row of each isin, symbol and series within a file."""
    keys = [F.coalesce(c, F.lit("")) for c in ("isin", "symbol", "series")]
    w = W.partitionBy("file", *keys).orderBy("line")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def misdated(rows: DataFrame, expected: Column) -> DataFrame:
    """Files with a row whose day isn't the expected one."""
    return rows.groupBy("file").agg(F.bool_or(~F.col("trade_date").eqNullSafe(expected)).alias("bad")).where("bad").select("file")
