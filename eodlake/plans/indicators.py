"""Registry of indicators: a name, how to compute it, and from which day on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.operators import rsi


@dataclass(frozen=True)
class Indicator:
    compute: Callable[[DataFrame, DataFrame], DataFrame]
    bootstrap: Callable[[DataFrame], DataFrame]


REGISTRY: dict[str, Indicator] = {}


def register(name: str, compute: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """``compute(prices, calendar)``; an indicator begins on the last day that its stored rows reach."""
    REGISTRY[name] = Indicator(compute, lambda stored: stored.agg(F.max("trade_date").alias("latest_trade_date")))


def compute(name: str, prices: DataFrame, calendar: DataFrame) -> DataFrame | None:
    """The indicator's rows; None for an unknown name, which a caller skips."""
    found = REGISTRY.get(name)
    return found.compute(prices, calendar) if found else None


def moving_average(prices: DataFrame, calendar: DataFrame, n: int = 9) -> DataFrame:
    """Mean of the last ``n`` closes of an instrument, null before there are as many."""
    w = W.partitionBy(*rsi.KEYS).orderBy("trade_date").rowsBetween(1 - n, 0)
    return prices.withColumn("value", F.when(F.count("close").over(w) == n, F.avg("close").over(w)))


register("RSI14", rsi.full)
register("MA9", moving_average)
