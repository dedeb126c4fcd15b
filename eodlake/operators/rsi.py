"""Gap-aware Wilder RSI as window expressions: full recompute and one-day step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eodlake.functions.columns import gain, loss, rsi_value

PERIOD, GAP = 14, 5
#: Rows of a chunk summed under one scale: (14/13)^4096 = 1e131 is still far from the largest double.
SPAN = 4096
KEYS = ["isin", "exchange"]


def eligible(prices: DataFrame, rules: DataFrame, liquid: bool = True) -> DataFrame:
    """Rows whose series is like some equity pattern of its exchange that counts for continuity, with any volume.

    The exchange is an equality, so this is a hash semi join with LIKE as residual; the small rule table decides for
    itself whether it is broadcast.
    """
    r = rules.where("category = 'EQUITY' and include_in_price_continuity").select(F.col("exchange").alias("r_exchange"), F.col("series_code_pattern").alias("pattern"))
    kept = prices.where(F.coalesce("tot_trd_qty", F.lit(0)) > 0) if liquid else prices
    return kept.join(r, (F.col("exchange") == F.col("r_exchange")) & F.expr("series like pattern"), "left_semi")


def one_a_day(prices: DataFrame, *ties: str) -> DataFrame:
    """Of several rows of an instrument on a day the one with most volume, then the first series, symbol and ``ties``."""
    w = W.partitionBy(*KEYS, "trade_date").orderBy(F.col("tot_trd_qty").desc_nulls_last(), "series", "symbol", *ties)
    return prices.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def sessions(dates: DataFrame) -> DataFrame:
    """(trade_date, session_no): positions in the ordered calendar, which is small (a row a trading day)."""
    return dates.select("trade_date").distinct().withColumn("session_no", F.row_number().over(W.orderBy("trade_date")).cast("long") - 1)


def common_days(loads: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days on which both exchanges loaded successfully."""
    d = loads.where("upload_status = 'SUCCESS'")
    d = d.where(F.col("trade_date") >= start) if start else d
    d = d.where(F.col("trade_date") <= end) if end else d
    return d.groupBy("trade_date").agg(F.count_distinct("exchange").alias("n")).where("n = 2").select("trade_date")


def numbered(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Session number of each row; null for a day outside the calendar."""
    return prices.join(F.broadcast(calendar), "trade_date", "left")  # a row a trading day


def chunks(rows: DataFrame, gap: int = GAP, *within: str) -> DataFrame:
    """Chunk number: a new one where at least ``gap`` sessions lie between a row and the one before; unknown sessions are no gap.

    Rows that differ in ``within`` do not see each other.
    """
    w = W.partitionBy(*KEYS, *within).orderBy("trade_date")
    missed = F.col("session_no") - F.lag("session_no").over(w) - 1
    return rows.withColumn("chunk", F.sum(F.when(missed >= gap, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))


def _scaled(x: Column) -> Column:
    at = F.col("j") - F.col("span") * SPAN
    return x * F.pow(F.lit(PERIOD / (PERIOD - 1)), F.when(F.col("span") == 0, F.greatest(at, F.lit(PERIOD - 1))).otherwise(at))


def averages(rows: DataFrame, *within: str) -> DataFrame:
    """Wilder's averages and RSI of rows with gain, loss and chunk; null before the 14th row of a chunk.

    The seed is the mean of 14 rows and each later value (13 * previous + x) / 14, which is one running sum of x scaled
    by (14/13)^place. Each span of rows has its own scale; the span before counts with what is left of it, those
    before that are below the precision of a double.
    """
    keys = [*KEYS, *within, "chunk"]
    ordered = W.partitionBy(*keys).orderBy("trade_date")
    inside = W.partitionBy(*keys, "span")
    rows = rows.withColumn("j", F.row_number().over(ordered) - 1).withColumn("span", F.floor(F.col("j") / SPAN))
    at = F.col("j") - F.col("span") * SPAN
    for x in ("gain", "loss"):
        rows = rows.withColumn("span_sum", F.sum(_scaled(F.col(x))).over(inside))
        running = F.sum(_scaled(F.col(x))).over(inside.orderBy("trade_date").rowsBetween(W.unboundedPreceding, 0))
        total = running + F.coalesce(F.lag("span_sum", SPAN).over(ordered), F.lit(0.0)) * ((PERIOD - 1) / PERIOD) ** SPAN
        rows = rows.withColumn(f"avg_{x}", F.when(F.col("j") >= PERIOD - 1, total / PERIOD * F.pow(F.lit((PERIOD - 1) / PERIOD), at))).drop("span_sum")
    return rows.drop("span").withColumn("rsi14", rsi_value(F.col("avg_gain"), F.col("avg_loss")))


def full(prices: DataFrame, calendar: DataFrame, gap: int = GAP) -> DataFrame:
    """RSI of one row a day: all instruments at once, in one shuffle by instrument.

    Rows without a price keep their place in the output but not in the walk: they are a window of their own.
    """
    p = numbered(prices, calendar).withColumns({"gain": gain(F.col("close"), F.col("prev_close")), "loss": loss(F.col("close"), F.col("prev_close"))})
    p = p.withColumn("priced", F.col("gain").isNotNull())
    rows = averages(chunks(p, gap, "priced"), "priced")
    return rows.withColumns({c: F.when(F.col("priced"), F.col(c)) for c in ("chunk", "j", "avg_gain", "avg_loss", "rsi14")}).drop("priced")


def latest(workbook: DataFrame) -> DataFrame:
    """Last row of each instrument."""
    return workbook.groupBy(*KEYS).agg(F.max_by(F.struct("trade_date", "avg_gain", "avg_loss"), "trade_date").alias("last")).select(*KEYS, F.col("last.trade_date").alias("last_date"), F.col("last.avg_gain").alias("last_gain"), F.col("last.avg_loss").alias("last_loss"))


#: What is kept of an instrument: its last priced session, averages, and rows and sums of its chunk; the last rows' changes serve the seed after a gap.
STATE_FIELDS = ["avg_gain", "avg_loss", "n", "sum_gain", "sum_loss", "session", "recent"]
STATE = "isin string, exchange string, avg_gain double, avg_loss double, n long, sum_gain double, sum_loss double, session long, recent array<struct<gain: double, loss: double>>"


def state_of(workbook: DataFrame) -> DataFrame:
    """One row an instrument (``STATE``) of rows as ``full`` gives them: the only pass over history, made once to set the states up."""
    w = W.partitionBy(*KEYS).orderBy(F.col("trade_date").desc())
    rows = workbook.where("gain is not null").withColumn("back", F.row_number().over(w))
    rows = rows.withColumn("last_chunk", F.first("chunk").over(w)).where((F.col("chunk") == F.col("last_chunk")) | (F.col("back") < PERIOD))
    own = F.col("chunk") == F.col("last_chunk")
    last = lambda c: F.min_by(c, "back")
    # sums are only asked for before the seed, so they stop at it
    early = lambda c: F.coalesce(F.sum(F.when(own & (F.col("j") < PERIOD - 1), F.col(c))), F.lit(0.0))
    recent = F.sort_array(F.collect_list(F.when(F.col("back") < PERIOD, F.struct((-F.col("back")).alias("place"), "gain", "loss"))))
    g = rows.groupBy(*KEYS).agg(last("avg_gain").alias("avg_gain"), last("avg_loss").alias("avg_loss"), F.count_if(own).alias("n"), early("gain").alias("sum_gain"), early("loss").alias("sum_loss"), last("session_no").alias("session"), F.transform(recent, lambda r: F.struct(r["gain"], r["loss"])).alias("recent"))
    return g.select(*KEYS, *STATE_FIELDS[:-1], F.col("recent").cast("array<struct<gain: double, loss: double>>").alias("recent"))


def advance(today: DataFrame, state: DataFrame, calendar: DataFrame, gap: int = GAP, reseed: str = "chunk") -> DataFrame:
    """One day for every instrument: its new averages, an outcome, and in ``next`` the state after it.

    A day is one join of its rows with one state row a key; no history is read. Outcomes: updated, seeded, still_pre_seed,
    reseeded_after_gap, skipped_no_workbook, skipped_missing_price, skipped_invariant_violation, skipped_late,
    skipped_reseed_insufficient_history. ``reseed='chunk'`` starts a new chunk after a gap as the full recompute does; ``'lookback'`` seeds at once from
    the last 14 rows, those before the gap included. A row at or before the state's session is late and changes nothing.
    """
    kept = state.select(*KEYS, F.struct(*STATE_FIELDS).alias("s"))
    t = today.join(F.broadcast(calendar), "trade_date", "left")  # a row a trading day
    t = t.withColumns({"gain": gain(F.col("close"), F.col("prev_close")), "loss": loss(F.col("close"), F.col("prev_close"))}).join(kept, KEYS, "left")
    is_gap = F.coalesce(F.col("session_no") - F.col("s.session") - 1 >= gap, F.lit(False))
    known, n = F.col("s").isNotNull(), F.coalesce(F.when(is_gap & (F.lit(reseed) == "chunk"), 0).otherwise(F.col("s.n")), F.lit(0))
    fresh_chunk = is_gap if reseed == "chunk" else F.lit(False)
    seeded = F.col("s.avg_gain").isNotNull() & ~fresh_chunk
    few = F.size("s.recent") < PERIOD - 1
    outcome = (
        F.when(F.col("gain").isNull(), "skipped_missing_price")
        .when(F.col("session_no") <= F.col("s.session"), "skipped_late")
        .when(~known, "skipped_no_workbook")
        .when(seeded & is_gap & few, "skipped_reseed_insufficient_history")
        .when(seeded & is_gap, "reseeded_after_gap")
        .when(seeded, "updated")
        .when(n > PERIOD - 1, "skipped_invariant_violation")
        .when(n == PERIOD - 1, "seeded")
        .otherwise("still_pre_seed")
    )
    t = t.withColumn("outcome", outcome)
    o = F.col("outcome")
    for x in ("gain", "loss"):
        before = F.when(fresh_chunk, 0.0).otherwise(F.coalesce(f"s.sum_{x}", F.lit(0.0)))
        lookback = F.aggregate(F.transform("s.recent", _field(x)), F.lit(0.0), lambda a, v: a + v)
        value = F.when(o == "updated", (F.col(f"s.avg_{x}") * (PERIOD - 1) + F.col(x)) / PERIOD).when(o == "seeded", (before + F.col(x)) / PERIOD).when(o == "reseeded_after_gap", (lookback + F.col(x)) / PERIOD)
        t = t.withColumns({f"avg_{x}": value, f"new_{x}": F.when(n < PERIOD - 1, before + F.col(x)).otherwise(before)})
    moved = o.isin("updated", "seeded", "still_pre_seed", "reseeded_after_gap", "skipped_no_workbook")
    longer = F.concat(F.coalesce(F.col("s.recent"), F.array().cast("array<struct<gain: double, loss: double>>")), F.array(F.struct("gain", "loss")))
    recent = F.slice(longer, F.greatest(F.size(longer) - PERIOD + 2, F.lit(1)), F.lit(PERIOD - 1))
    after = F.struct("avg_gain", "avg_loss", (F.when(o == "reseeded_after_gap", PERIOD).otherwise(n + 1)).cast("long").alias("n"), F.col("new_gain").alias("sum_gain"), F.col("new_loss").alias("sum_loss"), F.col("session_no").alias("session"), recent.alias("recent"))
    t = t.withColumn("next", F.when(moved, after).otherwise(F.col("s")))
    return t.withColumn("rsi14", rsi_value(F.col("avg_gain"), F.col("avg_loss"))).select(*today.columns, "session_no", "gain", "loss", "avg_gain", "avg_loss", "rsi14", "outcome", "next")


def _field(name: str):
    return lambda r: r[name]


def state_after(state: DataFrame, day: DataFrame) -> DataFrame:
    """The state table after a day that ``advance`` gave: its keys' new states, all others as they were."""
    new = day.where("next is not null").select(*KEYS, "next.*")
    return state.join(new.select(*KEYS), KEYS, "left_anti").unionByName(new.select(state.columns))


def seed_points(workbook: DataFrame) -> DataFrame:
    """Rows with an average right after one without."""
    w = W.partitionBy(*KEYS).orderBy("trade_date")
    return workbook.withColumn("before", F.lag("avg_gain").over(w)).where("avg_gain is not null and before is null").drop("before")


def missed_sessions(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions missed between consecutive rows of an instrument."""
    w = W.partitionBy(*KEYS).orderBy("trade_date")
    return numbered(prices, calendar).withColumn("missed", F.col("session_no") - F.lag("session_no").over(w) - 1)


def last_closes(prices: DataFrame, until: str, n: int = PERIOD) -> DataFrame:
    """Last ``n`` rows of each instrument up to a day, numbered from the oldest."""
    w = W.partitionBy(*KEYS).orderBy(F.col("trade_date").desc())
    p = prices.where(F.col("trade_date") <= F.lit(until).cast("date")).withColumn("back", F.row_number().over(w)).where(F.col("back") <= n)
    return p.withColumn("place", F.row_number().over(W.partitionBy(*KEYS).orderBy("trade_date"))).drop("back")
