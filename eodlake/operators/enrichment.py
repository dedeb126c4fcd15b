"""Enrichment of the instrument master from prioritised sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.functions.columns import sanitised

# Names that mark funds, precision and scale of the numeric columns, fields that the second exchange's row takes from the first's, and other sources' field names.
EXCLUDED_NAMES = ("%MUTUAL FUND%", "%ETF%", "%SEGREGATED PORTFOLIO%")
LIMITS = {"market_capitalization": (20, 2), "price_to_earnings_ratio": (10, 2), "price_to_book_ratio": (10, 2), "eps": (10, 2), "return_on_equity": (6, 2), "debt_to_equity_ratio": (10, 2), "dividend_yield": (6, 2)}
SHARED_FIELDS = ("market_capitalization", "debt_to_equity_ratio", "dividend_yield", "earnings_date")
SCREENER_FIELDS = {
    "market_cap_basic": "market_capitalization",
    "price_earnings_ttm": "price_to_earnings_ratio",
    "earnings_per_share_diluted_ttm": "eps",
    "debt_to_equity": "debt_to_equity_ratio",
    "dividend_yield_recent": "dividend_yield",
    "return_on_equity_fq": "return_on_equity",
    "price_book_fq": "price_to_book_ratio",
}


def companies(universe: DataFrame) -> DataFrame:
    """Instruments that aren't funds by their name; a row without a name is left out too."""
    out = universe
    for p in EXCLUDED_NAMES:
        out = out.where(~F.col("name_of_company").ilike(p))
    return out


def worklist(universe: DataFrame) -> DataFrame:
    """One row an isin with the symbol and exchange of each side; the main board goes before the SME board unless its symbol is missing."""
    row = lambda x: F.max(F.when((F.col("exchange") == x) & F.col("symbol").isNotNull(), F.struct("symbol", "exchange", "security_code")))
    g = universe.groupBy(F.col("isin_number").alias("isin")).agg(row("NSE").alias("n"), row("NSE SME").alias("ns"), row("BSE").alias("b"), row("BSE SME").alias("bs"))
    a, b = F.coalesce("n", "ns"), F.coalesce("b", "bs")
    return g.select("isin", a["symbol"].alias("nse_symbol"), a["exchange"].alias("nse_exchange"), b["symbol"].alias("bse_symbol"), b["exchange"].alias("bse_exchange"), b["security_code"].alias("bse_code"))


def tiered(sides: DataFrame, tiers: list[DataFrame], keys: list[str], fields: list[str]) -> DataFrame:
    """Fields of each side from the first tier that has them, and which tier each came from."""
    out = sides
    for k, t in enumerate(tiers):
        out = out.join(t.select(*keys, *[F.col(f).alias(f"_{k}_{f}") for f in fields]), keys, "left")
    pick = lambda f: F.coalesce(*[f"_{k}_{f}" for k in range(len(tiers))])
    origin = lambda f: F.coalesce(*[F.when(F.col(f"_{k}_{f}").isNotNull(), F.lit(k + 1)) for k in range(len(tiers))])
    return out.select(*sides.columns, *[pick(f).alias(f) for f in fields], *[origin(f).alias(f"{f}_tier") for f in fields])


def clean(rows: DataFrame, limits: dict[str, tuple[int, int]]) -> DataFrame:
    """Numbers that are not finite or don't fit their column become null."""
    return rows.withColumns({c: sanitised(F.col(c), *limits[c]) for c in limits if c in rows.columns})


def dropped(rows: DataFrame, keys: list[str], limits: dict[str, tuple[int, int]]) -> DataFrame:
    """(keys, field, value, reason) of the numbers that ``clean`` drops."""
    names = [c for c in limits if c in rows.columns]
    long = rows.unpivot(keys, names, "field", "value").where("value is not null")
    bound = F.create_map(*[x for c in names for x in (F.lit(c), F.lit(float(10 ** (limits[c][0] - limits[c][1]))))])
    reason = F.when(F.isnan("value") | (F.abs("value") == float("inf")), "not finite").when(F.abs("value") >= bound[F.col("field")], "out of range")
    return long.withColumn("reason", reason).where("reason is not null")


def shared(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The second exchange's missing fields filled from the first exchange's row of the same isin."""
    first = rows.where("exchange like 'NSE%'").groupBy("isin").agg(*[F.max(f).alias(f"_{f}") for f in fields])
    out = rows.join(first, "isin", "left")
    fill = lambda f: F.when(F.col("exchange").startswith("BSE"), F.coalesce(f, f"_{f}")).otherwise(F.col(f)).alias(f)
    return out.select(*[fill(c) if c in fields else F.col(c) for c in rows.columns])


def sides(work: DataFrame) -> DataFrame:
    """(isin, exchange, symbol): the sides of a worklist that have a symbol."""
    a = work.select("isin", F.col("nse_exchange").alias("exchange"), F.col("nse_symbol").alias("symbol"))
    return a.unionByName(work.select("isin", F.col("bse_exchange").alias("exchange"), F.col("bse_symbol").alias("symbol"))).where("exchange is not null")


def enriched(work: DataFrame, tiers: list[DataFrame], fields: list[str], excluded: DataFrame) -> DataFrame:
    """A row a side of the worklist: its fields by tier, cleaned and then shared, which tier each came from, and the outcome.

    A side in ``excluded`` (isin, exchange) is excluded, one that no tier knows anything of has failed; neither has fields, so neither is written.
    """
    keys = ["isin", "exchange"]
    out = tiered(sides(work), [clean(t, LIMITS) for t in tiers], keys, fields).join(excluded.select(*keys, F.lit(True).alias("_out")).distinct(), keys, "left")
    nothing = F.coalesce(*[F.col(f"{f}_tier") for f in fields]).isNull()
    out = out.withColumn("outcome", F.when(F.col("_out"), "excluded").when(nothing, "failed").otherwise("enriched")).drop("_out")
    out = shared(out, [f for f in SHARED_FIELDS if f in fields])
    return out.withColumns({f: F.when(F.col("outcome") == "enriched", F.col(f)) for f in fields})


def ready(uploads: DataFrame, required: list[str]) -> DataFrame:
    """Whether the latest attempt of every source succeeded and all required ones have one; the largest id."""
    latest = uploads.groupBy("data_source").agg(F.max_by("status", "id").alias("status"), F.max("id").alias("id"))
    return latest.agg((F.every(F.col("status") == "success") & (F.size(F.array_except(F.array(*map(F.lit, required)), F.collect_set("data_source"))) == 0)).alias("is_ready"), F.max("id").alias("max_id"))


def cursor(runs: DataFrame) -> DataFrame:
    """The largest id that the newest SUCCESS or PARTIAL run has seen, 0 without one: not the largest of all, as ids may fall again."""
    return runs.where("status in ('SUCCESS', 'PARTIAL')").agg(F.coalesce(F.max_by("max_id", "id"), F.lit(0)).cast("long").alias("cursor"))


def outcome(audit: DataFrame) -> DataFrame:
    """Counts by outcome, status and success rate (of attempted) of an enrichment run."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    g = audit.agg(n("enriched").alias("enriched"), n("failed").alias("failed"), n("excluded").alias("excluded"))
    status = F.when(F.col("failed") == 0, "SUCCESS").when(F.col("enriched") > 0, "PARTIAL").otherwise("FAILED")
    rate = F.coalesce(F.round(F.try_divide(F.col("enriched") * 100, F.col("enriched") + F.col("failed")), 1), F.lit(0.0))
    return g.select("*", status.alias("status"), rate.alias("success_rate"))
