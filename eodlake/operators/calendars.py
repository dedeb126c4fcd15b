"""Trading calendars and the continuity of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.functions.columns import parse_date


def holidays(rows: DataFrame, text: str = "date") -> DataFrame:
    """Days of rows like ``January 26, 2026``."""
    return rows.select(parse_date(F.col(text), ("MMMM d, yyyy",)).alias("day")).where("day is not null").distinct()


def days(spark: SparkSession, start: Column, end: Column, closed: DataFrame) -> DataFrame:
    """(day, kind) from start to end: WEEKEND, HOLIDAY (on a weekday) or TRADING."""
    every = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("day"))
    return kinds(every, closed)


def kinds(every: DataFrame, closed: DataFrame) -> DataFrame:
    d = every.join(closed.select(F.col("day").alias("_day")).distinct(), F.col("day") == F.col("_day"), "left")
    kind = F.when(F.weekday("day") >= 5, "WEEKEND").when(F.col("_day").isNotNull(), "HOLIDAY").otherwise("TRADING")
    return d.select("day", kind.alias("kind"))


def last_days(spark: SparkSession, end: Column, n: int, closed: DataFrame) -> DataFrame:
    """The last ``n`` trading days up to ``end`` and the closed days between them, numbered back from the end."""
    d = days(spark, F.date_sub(end, 2 * n + 30), end, closed)
    seen = F.count_if(F.col("kind") == "TRADING").over(W.orderBy(F.col("day").desc()).rowsBetween(W.unboundedPreceding, 0))
    return d.withColumn("back", seen).where((F.col("back") < n) | ((F.col("back") == n) & (F.col("kind") == "TRADING")))


def counted(d: DataFrame) -> DataFrame:
    return d.agg(F.count_if(F.col("kind") == "TRADING").alias("trading_days"), F.count_if(F.col("kind") == "WEEKEND").alias("weekend_days"), F.count_if(F.col("kind") == "HOLIDAY").alias("holidays"))


def continuity(loads: DataFrame, trading: DataFrame, ceiling: Column) -> DataFrame:
    """For each exchange: NO_HISTORY, CAUGHT_UP, NO_TRADING_DAY, DUE (exactly one day) or WAITING, with the pending days.

    ``loads`` has rows of every exchange to be judged, ``trading`` the trading days (trade_date).
    """
    last = loads.groupBy("exchange").agg(F.max(F.when(F.col("upload_status") == "SUCCESS", F.col("trade_date"))).alias("latest_success_date")).withColumn("ceiling_date", ceiling)
    t = trading.select(F.col("trade_date").alias("due"))
    p = last.join(t, (F.col("due") > F.col("latest_success_date")) & (F.col("due") <= F.col("ceiling_date")), "left")
    p = p.groupBy("exchange", "latest_success_date", "ceiling_date").agg(F.count("due").alias("pending_trading_days"), F.array_join(F.transform(F.sort_array(F.collect_list("due")), lambda d: F.date_format(d, "dd-MMM-yyyy")), ", ").alias("pending_dates"))
    outcome = F.when(F.col("latest_success_date").isNull(), "NO_HISTORY").when(F.col("latest_success_date") >= F.col("ceiling_date"), "CAUGHT_UP").when(F.col("pending_trading_days") == 0, "NO_TRADING_DAY").when(F.col("pending_trading_days") == 1, "DUE").otherwise("WAITING")
    return p.withColumn("outcome", outcome)


def coverage(prices: DataFrame) -> DataFrame:
    """Days with both exchanges, with one of them, or with neither price."""
    d = prices.groupBy("trade_date").agg(F.bool_or(F.col("exchange") == "NSE").alias("a"), F.bool_or(F.col("exchange") == "BSE").alias("b"))
    return d.agg(F.count_if(F.col("a") & F.col("b")).alias("both_days"), F.count_if(F.col("a") & ~F.col("b")).alias("nse_only"), F.count_if(~F.col("a") & F.col("b")).alias("bse_only"), F.count_if(~F.col("a") & ~F.col("b")).alias("neither"))
