"""Landed action files (CSV and JSON) and fundamentals documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.functions.columns import first_nonblank, named, parse_date, zero_to_null
from eodlake.sources.lines import cells, landed

# Column names in the exchanges' action files.
ACTION_COLUMNS = {"NSE": ("SYMBOL", "PURPOSE", "EX-DATE"), "BSE": ("Security Code", "Purpose", "Ex Date")}
ACTION_DATES = ("d-MMM-yyyy", "d MMM yyyy", "d-M-yyyy", "yyyyMMdd")


def action_rows(rows: DataFrame, exchange: str) -> DataFrame:
    """(exchange, code, subject, ex_date) of one exchange's rows, whatever the case of their names."""
    code, subject, day = ACTION_COLUMNS[exchange]
    code_c = named(rows, code)
    return rows.select(F.lit(exchange).alias("exchange"), (F.upper(code_c) if exchange == "NSE" else code_c).alias("code"), named(rows, subject).alias("subject"), parse_date(named(rows, day), ACTION_DATES).alias("ex_date"))


def action_csv(spark: SparkSession, path: str, exchange: str) -> tuple[DataFrame, DataFrame]:
    """Rows of an exchange's action files, and the files that are empty, markup or JSON instead (file).

    A file's lines meet in one task; its header is its first line that isn't blank, and files may differ in the order and number of columns.
    """
    w = W.partitionBy("file")
    told = F.trim(F.regexp_replace("value", "^\\ufeff", "")) != ""
    lines = landed(spark, path).withColumns({"first": F.min("at").over(w), "head": F.min(F.when(told, F.struct("at", F.regexp_replace("value", "^\\ufeff", "").alias("value")))).over(w)})
    bad = F.col("head").isNull() | F.substring(F.ltrim("head.value"), 1, 1).isin("<", "{", "[")
    body = lines.where(~bad & (F.col("at") > F.col("head.at")) & told).select("value", F.col("head.value").alias("header"))
    return action_rows(cells(body, list(ACTION_COLUMNS[exchange])), exchange), lines.where(bad & (F.col("at") == F.col("first"))).select("file")


ACTION_JSON = "isin string, symbol string, subject string, exDate string, scrip_code string, short_name string, Purpose string, Ex_date string"


def action_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON files that hold a list, bare or under Table; what is no JSON, or has none of the fields, gives none."""
    names = [f.split()[0] for f in ACTION_JSON.split(", ")]
    found = spark.read.schema(f"{ACTION_JSON}, Table array<struct<{ACTION_JSON.replace(' string', ': string')}>>").json(path, multiLine=True)
    rows = found.select(F.inline(F.coalesce("Table", F.array(F.struct(*names))))).where(F.coalesce(*names).isNotNull())
    return rows.select(
        F.when(F.col("scrip_code").isNotNull(), "BSE").otherwise("NSE").alias("exchange"),
        "isin",
        first_nonblank(F.col("symbol"), F.col("short_name")).alias("symbol"),
        "scrip_code",
        first_nonblank(F.col("subject"), F.col("Purpose")).alias("subject"),
        parse_date(first_nonblank(F.col("exDate"), F.col("Ex_date")), ACTION_DATES).alias("ex_date"),
    )


def fundamentals(docs: DataFrame, source: str, doc: str = "doc") -> DataFrame:
    """The fields of one source's JSON documents, with excluded instruments left out; other columns are kept.

    Each field is looked up on its own in a variant, so a document of an unforeseen shape costs fields and not the row, and so does a value of another
    type: numbers may come as texts. What is no JSON has no field.
    """
    keep = [c for c in docs.columns if c != doc]
    j = docs.select(*keep, F.try_parse_json(doc).alias("_json"))
    at = lambda path, kind="string": F.try_variant_get("_json", path, kind)
    if source == "NSE":
        info, whole = "$.equityResponse[0].secInfo.", at("$.equityResponse", "array<variant>")
        j = j.where(~F.coalesce(F.lower(at("$.isDelisted")) == "true", F.lit(False)))
        return j.select(
            *keep,
            first_nonblank(at(info + "sector")).alias("sector"),
            first_nonblank(at(info + "industryInfo"), at(info + "basicIndustry")).alias("industry"),
            zero_to_null(at(info + "pdSymbolPe")).alias("price_to_earnings_ratio"),
            at("$.equityResponse[0].tradeInfo.totalMarketCap", "double").alias("market_capitalization"),
            listing_date(at(info + "listingDate")).alias("date_of_listing"),
            at(info + "indexList", "array<string>").alias("index_list"),
            F.coalesce(F.size(whole), F.lit(0)).alias("n"),
        )
    if source == "BSE":
        j = j.where(~F.coalesce(F.trim(at("$.IShow")) == "0", F.lit(False)))
        z = lambda c, a: zero_to_null(at(f"$.{c}")).alias(a)
        return j.select(*keep, first_nonblank(at("$.IndustryNew")).alias("sector"), first_nonblank(at("$.IGroup")).alias("industry"), z("ConPE", "price_to_earnings_ratio"), z("PB", "price_to_book_ratio"), z("ConEPS", "eps"), z("ROE", "return_on_equity"), one_index(at("$.Index")).alias("index_list"))
    j = j.where(F.coalesce(at("$.regularMarketPrice", "double"), at("$.currentPrice", "double")).isNotNull())
    return j.select(
        *keep,
        at("$.sector").alias("sector"),
        at("$.industry").alias("industry"),
        at("$.marketCap", "double").alias("market_capitalization"),
        at("$.trailingPE", "double").alias("price_to_earnings_ratio"),
        (at("$.returnOnEquity", "double") * 100).alias("return_on_equity"),
        F.to_date(F.timestamp_millis(at("$.firstTradeDateMilliseconds", "bigint"))).alias("date_of_listing"),
        F.to_date(F.timestamp_seconds(at("$.earningsTimestamp", "bigint"))).alias("earnings_date"),
    )


def listing_date(c: Column) -> Column:
    """Day of a text like 29-Nov-1995 00:00:00."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("d-MMM-yyyy HH:mm:ss")).cast("date"), parse_date(c))


def one_index(c: Column) -> Column:
    """A single index name as a list; a dash or blank is none."""
    return F.when((F.trim(c) != "") & (F.trim(c) != "-"), F.array(F.trim(c)))
