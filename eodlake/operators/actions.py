"""Corporate actions: extraction, reconciliation between exchanges, and price factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.functions.columns import adjustment_factor, bonus_values, classify_action, ratios_agree, split_values

KEY = ["isin", "action_type", "ex_date"]


def parsed(rows: DataFrame) -> DataFrame:
    """Classified rows with face values; unsupported kinds are dropped, rows without a key are rejected (see ``rejected``)."""
    kind = classify_action(F.col("subject"))
    (b_old, b_new), (s_old, s_new) = bonus_values(F.col("subject")), split_values(F.col("subject"))
    rows = rows.withColumn("action_type", kind)
    pick = lambda b, s: F.when(F.col("action_type") == "BONUS", b).otherwise(s)
    return rows.where("action_type is not null").withColumns({"face_value_old": pick(b_old, s_old), "face_value_new": pick(b_new, s_new)})


def rejected(rows: DataFrame) -> DataFrame:
    """Rows that lack a required field."""
    return rows.where("isin is null or symbol is null or ex_date is null")


def latest_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row a key: the last by ``order``."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order.desc()))).where("_n = 1").drop("_n")


def resolved(rows: DataFrame, codes: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with the isin of ``codes`` (code, isin), and (n_unmatched, n_clashing): rows whose code has no isin, which are dropped, and codes with several, of which the smallest counts.

    Both sides are compared trimmed and in upper case. The master of instruments is small and broadcast only if Spark finds it so.
    """
    plain = lambda c: F.upper(F.trim(c))
    c = codes.where("isin is not null").groupBy(plain(F.col("code")).alias("_code")).agg(F.min("isin").alias("isin"), (F.count_distinct("isin") > 1).alias("_clash"))
    keyed = rows.withColumn("_key", plain(key.cast("string"))).join(c, F.col("_key") == F.col("_code"), "left")
    lost = keyed.agg(F.count_if(F.col("_code").isNull()).alias("n_unmatched"), F.count_distinct(F.when(F.col("_clash"), F.col("_code"))).alias("n_clashing"))
    return keyed.where("_code is not null").drop("_code", "_key", "_clash"), lost


def reconciled(raw: DataFrame) -> DataFrame:
    """One row a key from both exchanges' rows: status, factor, confirmations, symbol.

    Both without a contradiction is MATCHED, with the first exchange's factor if it is known and not zero, else the second's.
    """
    side = lambda x, c: F.max(F.when(F.col("exchange") == x, F.col(c)))
    f = raw.withColumn("factor", adjustment_factor(F.col("face_value_old"), F.col("face_value_new")))
    g = f.groupBy(*KEY).agg(
        F.count_if(F.col("exchange") == "NSE").alias("n_a"), F.count_if(F.col("exchange") == "BSE").alias("n_b"), side("NSE", "factor").alias("f_a"), side("BSE", "factor").alias("f_b"), side("NSE", "symbol").alias("s_a"), side("BSE", "symbol").alias("s_b")
    )
    both = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    agree = ratios_agree(F.col("f_a"), F.col("f_b"))
    status = F.when(both & F.coalesce(~agree, F.lit(False)), "CONFLICT").when(both, "MATCHED").when(F.col("n_a") > 0, "NSE_ONLY").otherwise("BSE_ONLY")
    zero = F.lit(0).cast("decimal(20,6)")
    first = F.coalesce(F.nullif(F.col("f_a"), zero), F.col("f_b"))
    factor = F.when(status == "MATCHED", first).when(status == "NSE_ONLY", F.col("f_a")).when(status == "BSE_ONLY", F.col("f_b"))
    return g.select(*KEY, F.coalesce(F.nullif(F.col("s_a"), F.lit("")), F.col("s_b")).alias("symbol"), factor.alias("adjustment_factor"), (F.col("n_a") > 0).alias("nse_confirmed"), (F.col("n_b") > 0).alias("bse_confirmed"), status.alias("reconciliation_status"))


def newly_matched(now: DataFrame, before: DataFrame, on_factor_change: bool = False) -> DataFrame:
    """Keys that are matched with a factor and weren't matched before (or whose factor changed, if asked for)."""
    b = before.select(*KEY, F.col("reconciliation_status").alias("_was"), F.col("adjustment_factor").alias("_factor"))
    new = ~F.col("_was").eqNullSafe("MATCHED")
    if on_factor_change:
        new = new | ~F.col("_factor").eqNullSafe(F.col("adjustment_factor"))
    return now.where("reconciliation_status = 'MATCHED' and adjustment_factor is not null").join(b, KEY, "left").where(new).drop("_was", "_factor")


def factor_intervals(actions: DataFrame) -> DataFrame:
    """(isin, since, until, factor): prices in [since, until) are multiplied by the product of all later factors."""
    day = actions.where("reconciliation_status = 'MATCHED' and adjustment_factor > 0").groupBy("isin", F.col("ex_date").alias("until")).agg(F.sum(F.log(F.col("adjustment_factor").cast("double"))).alias("log"))
    w = W.partitionBy("isin").orderBy("until")
    return day.select("isin", F.lag("until").over(w).alias("since"), "until", F.exp(F.sum("log").over(w.rowsBetween(0, W.unboundedFollowing))).alias("factor"))


def adjusted(prices: DataFrame, actions: DataFrame) -> DataFrame:
    """Prices with close and prev_close multiplied by the factor of their day (1 without later actions).

    An equality on the isin with the day's interval as residual, at most one match a row, instead of a sum for each row.
    """
    i = factor_intervals(actions).withColumnRenamed("isin", "_isin")
    on = (F.col("isin") == F.col("_isin")) & (F.col("trade_date") < F.col("until")) & (F.col("since").isNull() | (F.col("trade_date") >= F.col("since")))
    p = prices.join(i, on, "left").withColumn("factor", F.coalesce("factor", F.lit(1.0))).drop("_isin", "since", "until")
    return p.withColumns({"close": F.col("close") * F.col("factor"), "prev_close": F.col("prev_close") * F.col("factor")})
